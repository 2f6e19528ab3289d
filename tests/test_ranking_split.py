from pyspark.sql import Window
from pyspark.sql import functions as F

from valence.operators.ranking import global_row_number
from valence.operators.split import hash_split


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 1000).alias("k"), "id")
    ours = global_row_number(df.repartition(7), [F.desc("k"), F.asc("id")], "rn")
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy(F.desc("k"), F.asc("id"))))
    a = {(r.id, r.rn) for r in ours.collect()}
    b = {(r.id, r.rn) for r in ref.collect()}
    assert a == b


def test_hash_split_is_partitioning_invariant(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "doc_id")
    t1, _ = hash_split(df, "doc_id")
    t2, _ = hash_split(df.repartition(13), "doc_id")
    s1 = {r.doc_id for r in t1.collect()}
    s2 = {r.doc_id for r in t2.collect()}
    assert s1 == s2
    assert 0.6 < len(s1) / 2000 < 0.8
