"""Structured Streaming jobs.

The reference's ingest loop keeps process-lifetime "seen" sets and publishes
each new headline as it arrives. Here:

* R1: payload files stream in, articles are parsed and de-duplicated on
  ``(feed, key)`` with streaming state (``dropDuplicates``; unbounded like
  the reference's sets) or, with an event-time column, with
  ``dropDuplicatesWithinWatermark`` (bounded state).
* R1 + W2: articles stream in and the first headline of each key, by keyword
  order and position, is kept as state whatever the order of arrival.
* S12: articles stream in and each micro-batch becomes a segment of the
  search index.
* R2 + R3: headline files stream in and every micro-batch is scored against
  a static model inside ``foreachBatch`` (the model needs joins and
  aggregation, which a stream-static join alone cannot express), then written
  as JSON records to a per-batch folder, so a retried batch overwrites its own
  output instead of duplicating it.

All jobs use a checkpoint location and ``availableNow`` triggers, so they can
run as incremental batch jobs and resume after failure.
"""

from __future__ import annotations

import contextlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valence.operators import feeds, search_index
from valence.sources import committed
from valence.sources.feeds import parse_payloads

PAYLOAD_SCHEMA = "feed STRING, page BIGINT, payload STRING"
_STATE_KEY = "spark.sql.streaming.stateStore.providerClass"
_HEAP_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
_ROCKSDB_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Input of one micro-batch: the number of batches follows the bytes that wait,
# not the number of files.
BATCH_BYTES = 256 << 20
ARTICLE_SCHEMA = "feed STRING, key STRING, page BIGINT, item BIGINT, text STRING"
HEADLINE_SCHEMA = "feed STRING, key STRING, kw_ord INT, leader STRING, page BIGINT, item BIGINT, text STRING"


@contextlib.contextmanager
def _disk_backed_state(spark: SparkSession):
    """De-duplication state grows with the number of distinct keys. The
    default provider keeps all of it on the executor heap; RocksDB keeps it
    on local disk with a bounded memory footprint. A stream records its
    provider in its checkpoint, so a restarted stream keeps the one it began
    with. The caller's setting is put back afterwards."""
    before = spark.conf.get(_STATE_KEY)
    if before == _HEAP_STORE:
        spark.conf.set(_STATE_KEY, _ROCKSDB_STORE)
    try:
        yield
    finally:
        spark.conf.set(_STATE_KEY, before)


def _run(writer, checkpoint: str):
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def dedup_articles(spark: SparkSession, source: str, sink: str, checkpoint: str,
                   bytes_per_batch: int = BATCH_BYTES) -> None:
    """R1 (unbounded): distinct ``(feed, key, page, item, text)`` rows appended to
    parquet under ``sink``; the first arrival of a key is kept."""
    s = (spark.readStream.schema(PAYLOAD_SCHEMA)
         .option("maxBytesPerTrigger", bytes_per_batch).json(source))
    arts = parse_payloads(s).select("feed", "key", "page", "item", "text")
    d = arts.dropDuplicates(["feed", "key"])
    with _disk_backed_state(spark):
        _run(d.writeStream.format("parquet").option("path", sink).outputMode("append"), checkpoint)


def dedup_events(spark: SparkSession, source_df: DataFrame, sink: str, checkpoint: str,
                 keys=("user_id", "event_type"), delay: str = "1 hour") -> None:
    """R1 (bounded): event-time de-duplication whose state expires with the
    watermark.

    Bounded state has a price that the caller chooses with ``delay``: a row
    older than the newest row of the earlier batches less ``delay`` is late and
    is dropped, even if its key was never seen, and a key that comes again more
    than ``delay`` after its first row may be kept again. Within the delay every
    repeat is dropped and no key is lost."""
    d = source_df.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))
    with _disk_backed_state(spark):
        _run(d.writeStream.format("parquet").option("path", sink).outputMode("append"), checkpoint)


def first_headlines(spark: SparkSession, source: str, sink: str, checkpoint: str, leaders,
                    bytes_per_batch: int = BATCH_BYTES) -> None:
    """R1 + W2: article files stream in; for each ``(feed, key)`` the state
    holds the least ``(kw_ord, page, item, text)`` seen so far, so the headline
    kept does not depend on the order of arrival. Each micro-batch writes the
    headlines of the keys it touched to ``sink/batch=<id>`` (a retried batch
    overwrites its own); :func:`read_headlines` gives the last state. Keys are
    kept for ever, like the reference's sets: articles carry no event time
    that could expire them. Of article rows with equal ids and other texts the
    least text that holds the keyword is kept."""
    s = (spark.readStream.schema(ARTICLE_SCHEMA)
         .option("maxBytesPerTrigger", bytes_per_batch).json(source))
    least = F.min(F.struct("kw_ord", "page", "item", "text", "leader")).alias("best")
    best = feeds.match_rows(s, leaders).groupBy("feed", "key").agg(least).select("feed", "key", "best.*")

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("compression", "gzip").json(os.path.join(sink, f"batch={batch_id}"))

    with _disk_backed_state(spark):
        _run(best.writeStream.outputMode("update").foreachBatch(each), checkpoint)


def read_headlines(spark: SparkSession, sink: str) -> DataFrame:
    """The last state of :func:`first_headlines`: updates of a key only ever
    get smaller, so its least one is the last."""
    rows = spark.read.schema(HEADLINE_SCHEMA).json(sink)
    least = F.min(F.struct("kw_ord", "page", "item", "text", "leader")).alias("best")
    return rows.groupBy("feed", "key").agg(least).select("feed", "key", "best.*")


def index_stream(spark: SparkSession, source: str, index: str, checkpoint: str,
                 bytes_per_batch: int = BATCH_BYTES) -> None:
    """Article files stream in, each micro-batch is a segment of the
    search index ``index``; a retried batch replaces its own segment."""
    s = (spark.readStream.schema(ARTICLE_SCHEMA)
         .option("maxBytesPerTrigger", bytes_per_batch).json(source))
    _run(s.writeStream.foreachBatch(lambda batch, i: search_index.add_segment(batch, index, f"batch-{i}")), checkpoint)


def score_stream(spark: SparkSession, source: str, sink: str, checkpoint: str, score_batch,
                 bytes_per_batch: int = BATCH_BYTES) -> None:
    """R2 + R3: ``score_batch(df) -> records(feed, key, value)`` applied to
    each micro-batch of headline files; output under ``sink/batch=<id>``."""
    s = (spark.readStream.schema(HEADLINE_SCHEMA)
         .option("maxBytesPerTrigger", bytes_per_batch).json(source))

    def each(batch: DataFrame, batch_id: int) -> None:
        score_batch(batch).write.mode("overwrite").json(os.path.join(sink, f"batch={batch_id}"))

    _run(s.writeStream.foreachBatch(each), checkpoint)


def score_stream_once(spark: SparkSession, source: str, sink: str, checkpoint: str, score_batch,
                      bytes_per_batch: int = BATCH_BYTES) -> None:
    """:func:`score_stream` into the exactly-once sink: a batch is one commit
    named by its id, and a batch that was committed is not published again."""
    s = (spark.readStream.schema(HEADLINE_SCHEMA)
         .option("maxBytesPerTrigger", bytes_per_batch).json(source))
    _run(s.writeStream.foreachBatch(lambda batch, i: committed.publish(score_batch(batch), sink, f"batch-{i}")), checkpoint)


def read_records(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.schema("feed STRING, key STRING, value STRING").json(sink).select("feed", "key", "value")
