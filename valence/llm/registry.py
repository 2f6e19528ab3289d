"""All queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

import importlib

_NAMES = ("passages", "toxicity", "line_dedup", "neighbours", "langid", "quality", "decontam", "mixing", "brown", "simhash",
          "credentials", "spelling", "alignment")


def _modules() -> list:
    return [importlib.import_module(f"valence.llm.{n}") for n in _NAMES]


def queries() -> dict:
    return {k: v for m in _modules() for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in _modules() for k, v in m.ORACLE.items()}
