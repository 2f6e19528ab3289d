from pyspark.sql import functions as F

from valence.operators.guards import BROADCAST_BYTES, broadcast_if_small, class_array


def test_broadcast_only_within_byte_budget(spark):
    df = spark.range(4)
    assert broadcast_if_small(df) is not df                              # 4 narrow rows fit
    assert broadcast_if_small(df, row_bytes=BROADCAST_BYTES // 2) is df  # only 2 such rows fit
    assert broadcast_if_small(df, max_rows=3) is df


def test_class_array_is_sorted_and_distinct(spark):
    df = spark.range(10).select((F.col("id") % 5).alias("c"))
    assert df.select(class_array(df, "c").alias("a")).first().a == [0, 1, 2, 3, 4]
