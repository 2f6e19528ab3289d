"""Global row numbers over a total order without a single-partition window.

``row_number().over(Window.orderBy(...))`` moves every row into one task.
Here the rows are range-partitioned and sorted by Spark (balanced by
sampling), each row's partition index and position are frozen by a
checkpoint in the shared checkpoint folder, and the offset of each partition
is added back. The offsets table has one row per partition, so its size is
bounded by the partition count and not by the data; it is built on the
driver from the per-partition counts and broadcast. The result is the exact
1-based row number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valence.session import freeze


def global_row_number(df: DataFrame, order_cols, out_col: str = "rn") -> DataFrame:
    spark = df.sparkSession
    frozen = freeze(df.orderBy(*order_cols)
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_pos", F.monotonically_increasing_id()
                                - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)))
    counts = sorted(tuple(r) for r in frozen.groupBy("_pid").agg(F.count(F.lit(1))).collect())
    rows, run = [], 0
    for pid, n in counts:
        rows.append((pid, run))
        run += n
    offsets = spark.createDataFrame(rows or [(0, 0)], "_pid int, _off bigint")
    return (frozen.join(F.broadcast(offsets), "_pid")
            .withColumn(out_col, F.col("_off") + F.col("_pos") + 1)
            .drop("_pid", "_pos", "_off"))


def prefix_sum(df: DataFrame, order_cols, value: str, out_col: str = "before") -> DataFrame:
    """``df`` with the sum of the whole numbers ``value`` over all rows before
    each row, 0 for the first. Like :func:`global_row_number` it ranges the rows
    over partitions, sums within each and adds the sums of the ones before."""
    spark = df.sparkSession
    frozen = freeze(df.orderBy(*order_cols).withColumn("_pid", F.spark_partition_id()))
    sums = sorted(tuple(r) for r in frozen.groupBy("_pid").agg(F.sum(value)).collect())
    rows, run = [], 0
    for pid, n in sums:
        rows.append((pid, run))
        run += n or 0
    offsets = spark.createDataFrame(rows or [(0, 0)], "_pid int, _off bigint")
    own = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    return (frozen.join(F.broadcast(offsets), "_pid")
            .withColumn(out_col, F.col("_off") + F.coalesce(F.sum(value).over(own), F.lit(0)))
            .drop("_pid", "_off"))
