import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from valence.session import scratch_path
from valence.sources import committed
from valence.streaming import ingest


def records(spark, a, b, parts=4):
    return spark.range(a, b, 1, parts).select(
        F.lit("A").alias("feed"), F.col("id").cast("string").alias("key"), F.concat(F.lit('é"\n'), "id").alias("value"))


def seen(spark, path):
    return sorted((int(r.key), r.value) for r in committed.read(spark, path).collect())


def rows(*ranges):
    return sorted((i, f'é"\n{i}') for r in ranges for i in r)


def test_each_batch_is_read_once(spark):
    path = scratch_path(spark, "committed")
    assert seen(spark, path) == []
    committed.publish(records(spark, 0, 50), path, "b0")
    committed.publish(records(spark, 0, 50, 7), path, "b0")  # the batch is retried
    committed.publish(records(spark, 50, 60), path, "b1")
    committed.publish(records(spark, 0, 0), path, "b2")
    assert seen(spark, path) == rows(range(60))


def test_aborted_jobs_leave_nothing_to_read(spark):
    path = scratch_path(spark, "committed")
    committed.publish(records(spark, 0, 5), path, "b0")
    # the last of four tasks fails after the others may have written
    bad = records(spark, 5, 45).withColumn("value", F.when(F.col("key") == "44", F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(PySparkException):
        committed.publish(bad, path, "b1")
    assert seen(spark, path) == rows(range(5))
    committed.publish(records(spark, 5, 45), path, "b1")
    assert seen(spark, path) == rows(range(45))
    with pytest.raises(PySparkException):
        committed.publish(records(spark, 0, 1), path, "../b")


def test_a_stream_that_repeats_a_batch(spark):
    root = scratch_path(spark, "committed")
    schema = "feed STRING, key STRING, kw_ord INT, leader STRING, page BIGINT, item BIGINT, text STRING"
    spark.createDataFrame([("A", str(i), 0, "k", 0, i, f"t{i}") for i in range(20)], schema).write.json(f"{root}/src")

    def score(batch):
        return batch.select("feed", "key", F.col("text").alias("value"))

    for check in ("one", "two"):  # the second run has lost its checkpoint
        ingest.score_stream_once(spark, f"{root}/src", f"{root}/out", f"{root}/{check}", score)
    assert sorted(r.value for r in committed.read(spark, f"{root}/out").collect()) == sorted(f"t{i}" for i in range(20))
