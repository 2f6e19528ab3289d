"""Size checks in front of broadcasts, and class lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes a broadcast table may take, and the row width assumed for the narrow
# tables (a few ids, counts and a short word) broadcast here.
BROADCAST_BYTES = 64 << 20
NARROW_ROW_BYTES = 32
DEFAULT_BROADCAST_ROWS = BROADCAST_BYTES // NARROW_ROW_BYTES


def broadcast_if_small(df: DataFrame, max_rows: int | None = None,
                       row_bytes: int = NARROW_ROW_BYTES) -> DataFrame:
    """Broadcast ``df`` only when it has at most ``max_rows`` rows (default:
    as many rows of ``row_bytes`` as fit in ``BROADCAST_BYTES``); otherwise
    leave it to a shuffle join (AQE may still convert it at runtime).
    Callers pass checkpointed or persisted tables, so the count is cheap."""
    limit = BROADCAST_BYTES // max(1, row_bytes)
    if max_rows is not None:
        limit = min(limit, max_rows)
    n = df.count()
    return F.broadcast(df) if n <= limit else df


def class_array(df: DataFrame, col: str) -> Column:
    """Sorted distinct values of ``col`` as a scalar-subquery array column,
    for tables whose very shape is one row per class."""
    return df.select(F.col(col).alias("c")).agg(F.sort_array(F.collect_set("c"))).scalar()
