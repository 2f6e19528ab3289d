"""Surface statistics of texts, the inputs of the quality and domain models."""

from __future__ import annotations

import math
import operator
import string
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valence.llm.common import column, record, utf8

STATS = ("log_words", "mean_word", "long_words", "distinct_words", "top_word", "word_runs", "bare_symbols",
         "symbols", "digits", "capitals", "non_ascii", "stops", "commas", "words_per_stop", "lines",
         "repeated_lines", "addresses")

_SYMBOLS = b"#$%&*<>{}[]|\\^~_=+@/"
_DIGITS, _UPPER = (s.encode() for s in (string.digits, string.ascii_uppercase))
_HIGH = bytes(range(128, 256))
_PLAIN = (string.ascii_letters + string.digits).encode()


def stats(text: bytes) -> tuple[float, ...]:
    """Values of ``STATS``; all zero for a text without words."""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return (0.0,) * len(STATS)
    share = lambda chars: (size - len(text.translate(None, chars))) / size
    counts = Counter(words)
    lengths = [len(w) for w in words]
    lines = [x for x in text.split(b"\n") if x.strip()]
    stops = text.count(b".")
    bare = sum(c for w, c in counts.items() if len(w.translate(None, _PLAIN + _HIGH)) == len(w))
    return (math.log1p(n), sum(lengths) / n, sum(x > 20 for x in lengths) / n, len(counts) / n,
            max(counts.values()) / n, sum(map(operator.eq, words, words[1:])) / n, bare / n,
            share(_SYMBOLS), share(_DIGITS), share(_UPPER), share(_HIGH), stops / n, text.count(b",") / n,
            n / (stops + 1), len(lines) / n, 1 - len(set(lines)) / len(lines), text.count(b"://") / n)


def text_stats(docs: DataFrame, extra: dict | None = None) -> DataFrame:
    """``(doc_id, words, *STATS)`` for each row; ``extra`` maps further column
    names to functions of the text's bytes."""
    extra = extra or {}
    names = (*STATS, *extra)
    schema = pa.schema([("doc_id", pa.int64()), ("words", pa.int64()), *((n, pa.float64()) for n in names)])

    def run(batches):
        for b in batches:
            rows = []
            for t in utf8(b, "text"):
                s = stats(t)
                rows.append((round(math.expm1(s[0])), *s, *(float(f(t)) for f in extra.values())))
            yield record(schema, [column(b, "doc_id"), *(zip(*rows) if rows else [[]] * (len(names) + 1))])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, words long, " + ", ".join(f"{n} double" for n in names))
