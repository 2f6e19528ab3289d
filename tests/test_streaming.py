from valence.plans import feed_queries as FQ
from valence.sources.feeds import articles
from conftest import SF_SMALL


def test_stream_dedup_equals_batch_distinct(spark):
    streamed = {tuple(r) for r in FQ.q_stream_dedup(spark, SF_SMALL).collect()}
    batch = {tuple(r) for r in articles(spark, SF_SMALL).select("feed", "key").distinct().collect()}
    assert streamed == batch


def test_stream_publish_equals_batch_publish(spark):
    streamed = {tuple(r) for r in FQ.q_stream_publish(spark, SF_SMALL).collect()}
    batch = {tuple(r) for r in FQ.q_publish_nb(spark, SF_SMALL).collect()}
    assert streamed == batch and len(batch) > 0


def test_bounded_dedup_drops_late_rows_only(spark):
    """A first arrival older than the watermark goes; within the delay none does."""
    from valence.session import scratch_path
    from valence.streaming import ingest

    days = ("2024-06-01", "2024-06-02", "2024-06-02", "2024-01-01", "2024-05-30")
    for delay, want in (("7 days", {0, 1, 4}), ("365 days", {0, 1, 3, 4})):
        root = scratch_path(spark, "late")
        for i, day in enumerate(days):
            user = 1 if i == 2 else i
            spark.sql(f"SELECT {user}L AS user_id, 'e' AS event_type, timestamp'{day}' AS ts").coalesce(1).write.mode(
                "append").parquet(f"{root}/src")
        stream = (spark.readStream.schema("user_id LONG, event_type STRING, ts TIMESTAMP")
                  .option("maxFilesPerTrigger", 1).parquet(f"{root}/src"))
        before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
        ingest.dedup_events(spark, stream, f"{root}/out", f"{root}/check", delay=delay)
        assert {r.user_id for r in spark.read.parquet(f"{root}/out").collect()} == want
        assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_the_number_of_batches_does_not_grow_with_what_waits(spark, tmp_path, monkeypatch):
    """Before, every batch took 8 MB however much waited."""
    from valence.plans import feed_queries as Q
    src = str(tmp_path / "src")
    spark.range(4000).selectExpr("repeat('x', 100) as text").repartition(4).write.json(src)
    assert Q._batch_bytes(spark, src) == Q.STREAM_BYTES
    monkeypatch.setattr(Q, "STREAM_BYTES", 1000)
    few = Q._batch_bytes(spark, src)
    assert few > 4000 * 100 // Q.STREAM_BATCHES
    monkeypatch.setattr(Q.ingest, "BATCH_BYTES", few - 1)
    assert Q._batch_bytes(spark, src) == few - 1
