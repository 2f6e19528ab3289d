"""Registered queries: feeds, keyword matching, de-duplication, scoring,
publishing, streaming."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from valence.functions.text import clean_text, regex_tokens, word_tokens
from valence.operators import feeds as FD
from valence.operators import knn as K
from valence.operators import naive_bayes as NB
from valence.operators import search_index as SI
from valence.plans import sql as S
from valence.plans.knn_queries import knn_ctes
from valence.plans.nb_queries import nb_model, nb_pred_ctes
from valence.plans.prepare import train_test
from valence.session import freeze, scratch_path, store
from valence.sources import committed, sinks
from valence.sources.feeds import articles, parse_payloads, payloads_from_tables
from valence.sources.tables import table
from valence.streaming import ingest

# Test keywords: words that occur in all three stand-in feeds, and phrases.
TEST_KEYWORDS = ("that", "was", "for", "with", "this", "are", "que", "anea", "der",
                 "of the", "and the", "zu den")
SEEN_KEYWORDS = 4   # keywords of an earlier run whose headlines count as published
QUERY_DAYS = 10     # the test events span thirty days
# Stream sources are written by parallel tasks in files of at most this many
# records; a micro-batch takes files up to this size, or a larger share of what
# waits: each batch reads models and state whole, so their number must not grow
# with the input.
FILE_RECORDS = 1024
STREAM_BYTES = 8 << 20
STREAM_BATCHES = 8


def _batch_bytes(spark, src: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(src)
    waits = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return min(ingest.BATCH_BYTES, max(STREAM_BYTES, waits // STREAM_BATCHES))


def _kw(spark):
    return FD.keyword_table(spark, TEST_KEYWORDS)


def q_feed_articles(spark, sf):
    """The articles as parsed from the services' JSON payloads."""
    return parse_payloads(payloads_from_tables(spark, sf)).select("feed", "key", "title", "text")


def q_feed_source_filter(spark, sf):
    d = FD.source_filter(table(spark, sf, "documents"))
    return d.select("doc_id", "source")


def q_keyword_matches(spark, sf):
    m = FD.match_keywords(articles(spark, sf), _kw(spark))
    return m.select("feed", "key", "kw_ord", "leader")


def q_feed_first_n(spark, sf):
    kw = _kw(spark)
    m = FD.first_n_per_keyword(FD.match_keywords(FD.at_first_places(articles(spark, sf), kw), kw))
    return m.select("feed", "kw_ord", "rank", "key")


def q_headlines(spark, sf):
    return FD.headlines(articles(spark, sf), _kw(spark), FD.FIRST_N)


def q_headlines_all(spark, sf):
    return FD.headlines(articles(spark, sf), _kw(spark)).select("feed", "key", "kw_ord", "leader", "text")


def q_headlines_unseen(spark, sf):
    arts, kw = articles(spark, sf), _kw(spark)
    seen = FD.headlines(arts, kw.filter(F.col("kw_ord") < SEEN_KEYWORDS), FD.FIRST_N)
    return FD.unseen(FD.headlines(arts, kw, FD.FIRST_N), seen).select("feed", "key", "kw_ord", "leader")


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def q_events_recent(spark, sf):
    return FD.recent(table(spark, sf, "events"), days=QUERY_DAYS).select("event_id", "user_id", "event_type")


def q_events_newest_page(spark, sf):
    e = _events(spark, sf)
    p = FD.newest_pages(e, "event_type", "ts", "event_id", 10, 2)
    return p.select("event_type", "page", F.col("rank").cast("int").alias("rank"), "event_id")


def _headline_docs(h, keep=store):
    """The headlines as documents, computed once: the models read them several
    times and the records once more. Each takes a number: the models carry the
    id with every word, and a key may be as long as a text."""
    return keep(h.select(F.monotonically_increasing_id().alias("doc_id"), "feed", "key", "leader", "text"))


def nb_records(model, h, keep=store):
    docs = _headline_docs(h, keep)
    pred = NB.predict(model, docs.select("doc_id", regex_tokens(clean_text("text")).alias("tokens")), keep=keep)
    return sinks.polarity_records(docs.join(pred, "doc_id"), "nb")


def q_publish_nb(spark, sf):
    model, _ = nb_model(spark, sf)
    return nb_records(model, FD.headlines(articles(spark, sf), _kw(spark)))


def knn_records(model, h, keep=store):
    docs = _headline_docs(h, keep)
    pred = K.predict(model, docs.select("doc_id", word_tokens(clean_text("text")).alias("words")))
    return sinks.polarity_records(docs.join(pred, "doc_id"), "knn")


def _knn_model(spark, sf):
    train, _ = train_test(spark, sf)
    return K.fit(train.select("doc_id", "label", "words"))


def q_publish_knn(spark, sf):
    return knn_records(_knn_model(spark, sf), FD.headlines(articles(spark, sf), _kw(spark)))


def q_publish_nb_files(spark, sf):
    root = scratch_path(spark, "publish")
    path = sinks.index_path(root)
    sinks.write_records(q_publish_nb(spark, sf), path, mode="overwrite")
    return ingest.read_records(spark, path)


def q_publish_nb_committed(spark, sf):
    """The records through the exactly-once sink, read back."""
    path = scratch_path(spark, "committed")
    committed.publish(q_publish_nb(spark, sf), path, "headlines")
    return committed.read(spark, path)


def q_stream_dedup(spark, sf):
    root = scratch_path(spark, "stream-dedup")
    src = os.path.join(root, "payloads")
    payloads_from_tables(spark, sf).write.option("maxRecordsPerFile", FILE_RECORDS).json(src)
    sink = os.path.join(root, "articles")
    ingest.dedup_articles(spark, src, sink, os.path.join(root, "_checkpoint"), _batch_bytes(spark, src))
    return spark.read.parquet(sink).select("feed", "key")


def q_stream_dedup_events(spark, sf):
    """R1, bounded state: event-time de-duplication of (user, event type);
    with a delay as long as the recency window every repeat is dropped."""
    root = scratch_path(spark, "stream-events")
    src = os.path.join(root, "events")
    _events(spark, sf).write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    sink = os.path.join(root, "dedup")
    ingest.dedup_events(spark, stream, sink, os.path.join(root, "_checkpoint"),
                        delay=f"{FD.RECENT_DAYS} days")
    return spark.read.parquet(sink).select("user_id", "event_type")


def _article_files(spark, sf, root):
    src = os.path.join(root, "articles")
    (articles(spark, sf).select("feed", "key", "page", "item", "text")
     .write.option("maxRecordsPerFile", FILE_RECORDS).option("compression", "gzip").json(src))
    return src


def q_index_matches(spark, sf):
    """S12 + P10: the articles stream into a search index, its segments are
    merged, and the keywords are answered from the index alone."""
    root = scratch_path(spark, "index")
    index = os.path.join(root, "words")
    src = _article_files(spark, sf, root)
    ingest.index_stream(spark, src, index, os.path.join(root, "_checkpoint"), _batch_bytes(spark, src))
    SI.merge(spark, index)
    SI.vacuum(spark, index)
    return SI.search(spark, index, TEST_KEYWORDS).select("feed", "key", "kw_ord", "leader")


def q_stream_headlines(spark, sf):
    """R1 + W2: the first headline of each key from a stream of articles."""
    root = scratch_path(spark, "stream-headlines")
    sink = os.path.join(root, "out")
    src = _article_files(spark, sf, root)
    ingest.first_headlines(spark, src, sink, os.path.join(root, "_checkpoint"),
                           TEST_KEYWORDS, _batch_bytes(spark, src))
    return ingest.read_headlines(spark, sink).select("feed", "key", "kw_ord", "leader", "text")


def stream_publish(spark, sf, records):
    """The headlines as a stream of files, ``records(batch)`` published
    for each micro-batch."""
    root = scratch_path(spark, "stream-publish")
    src = os.path.join(root, "headlines")
    FD.headlines(articles(spark, sf), _kw(spark)).write.option("maxRecordsPerFile", FILE_RECORDS).json(src)
    sink = sinks.index_path(os.path.join(root, "out"))
    ingest.score_stream(spark, src, sink, os.path.join(root, "_checkpoint"),
                        records, _batch_bytes(spark, src))
    return ingest.read_records(spark, sink)


def q_stream_publish(spark, sf):
    model, _ = nb_model(spark, sf)
    return stream_publish(spark, sf, lambda b: nb_records(model, b, freeze))


def q_stream_publish_knn(spark, sf):
    model = _knn_model(spark, sf)
    return stream_publish(spark, sf, lambda b: knn_records(model, b, freeze))


QUERIES = {
    "feed_articles": q_feed_articles,
    "feed_source_filter": q_feed_source_filter,
    "keyword_matches": q_keyword_matches,
    "feed_first_n": q_feed_first_n,
    "headlines": q_headlines,
    "headlines_all": q_headlines_all,
    "headlines_unseen": q_headlines_unseen,
    "events_recent": q_events_recent,
    "events_newest_page": q_events_newest_page,
    "publish_nb": q_publish_nb,
    "publish_knn": q_publish_knn,
    "publish_nb_files": q_publish_nb_files,
    "publish_nb_committed": q_publish_nb_committed,
    "stream_dedup": q_stream_dedup,
    "stream_dedup_events": q_stream_dedup_events,
    "index_matches": q_index_matches,
    "stream_headlines": q_stream_headlines,
    "stream_publish": q_stream_publish,
    "stream_publish_knn": q_stream_publish_knn,
}

_KW_SQL = " UNION ALL ".join(f"SELECT {i} AS kw_ord, '{k}' AS leader" for i, k in enumerate(TEST_KEYWORDS))

FEED_CTES = f""",
arts AS (
  SELECT 'A' AS feed, title AS key, doc_id // 100 AS page, doc_id AS item, title,
         concat_ws(' ', title, description) AS text
  FROM (SELECT doc_id, split_part(text, chr(10), 1) AS title,
               CASE WHEN contains(text, chr(10)) THEN substr(text, strpos(text, chr(10)) + 1) END AS description
        FROM documents) a
  UNION ALL
  SELECT 'B', url, page_id // 100, page_id, t, t
  FROM (SELECT url, page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages) b
  UNION ALL
  SELECT 'C', conv_id || ':' || turn, conv_id, turn, text, text FROM conversations),
kw AS ({_KW_SQL}),
mt AS (SELECT arts.*, kw.kw_ord, kw.leader FROM arts JOIN kw
       ON contains(' ' || {S.clean('arts.text')} || ' ', ' ' || kw.leader || ' ')),
fn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feed, kw_ord ORDER BY page, item, key) AS rank
                      FROM mt) r WHERE rank <= 10),
hl AS (SELECT feed, key, kw_ord, leader, page, item, text FROM (
         SELECT *, row_number() OVER (PARTITION BY feed, key ORDER BY kw_ord, page, item) AS r FROM fn) x
       WHERE r = 1),
hla AS (SELECT feed, key, kw_ord, leader, page, item, text FROM (
         SELECT *, row_number() OVER (PARTITION BY feed, key ORDER BY kw_ord, page, item) AS r FROM mt) x
        WHERE r = 1)"""

_NB_PUBLISH = nb_pred_ctes(
    "quality", extra=FEED_CTES,
    tdocs=f"SELECT feed || ':' || key AS doc_id, 0 AS label, {S.tokens(S.clean('text'))} AS tokens FROM hla") + """
SELECT hl.feed, hl.key,
       json_object('news', hl.text, 'leader', hl.leader, 'naviesBayesPolarity', pred.prediction) AS value
FROM hla hl JOIN pred ON pred.doc_id = hl.feed || ':' || hl.key"""

_KNN_PUBLISH = knn_ctes(
    "quality", extra=FEED_CTES,
    qdocs=f"SELECT feed || ':' || key AS doc_id, 0 AS label, {S.words(S.clean('text'))} AS words FROM hla") + """
SELECT hl.feed, hl.key,
       json_object('news', hl.text, 'leader', hl.leader, 'knnpolarity', pred.prediction) AS value
FROM hla hl JOIN pred ON pred.doc_id = hl.feed || ':' || hl.key"""

_W = "WITH dummy AS (SELECT 1)"

ORACLE = {
    "feed_articles": _W + FEED_CTES + " SELECT feed, key, title, text FROM arts",
    "feed_source_filter": """SELECT doc_id, source FROM documents
                             WHERE lang = 'en' AND source IN ('src1', 'src3')""",
    "keyword_matches": _W + FEED_CTES + " SELECT feed, key, kw_ord, leader FROM mt",
    "feed_first_n": _W + FEED_CTES + " SELECT feed, kw_ord, rank::INT AS rank, key FROM fn",
    "headlines": _W + FEED_CTES + " SELECT * FROM hl",
    "headlines_all": _W + FEED_CTES + " SELECT feed, key, kw_ord, leader, text FROM hla",
    "headlines_unseen": _W + FEED_CTES + f""",
fn0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feed, kw_ord ORDER BY page, item, key) AS rank
                       FROM mt WHERE kw_ord < {SEEN_KEYWORDS}) r WHERE rank <= 10),
seen AS (SELECT DISTINCT feed, key FROM fn0)
SELECT feed, key, kw_ord, leader FROM hl
WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.feed = hl.feed AND seen.key = hl.key)""",
    "events_recent": f"""SELECT event_id, user_id, event_type FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL {QUERY_DAYS} DAY""",
    "events_newest_page": """SELECT event_type, ((rank - 1) // 10 + 1)::INT AS page, rank::INT AS rank, event_id
FROM (SELECT event_type, event_id,
             row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS rank
      FROM events) r WHERE rank <= 20""",
    "publish_nb": _NB_PUBLISH,
    "publish_knn": _KNN_PUBLISH,
    "publish_nb_files": _NB_PUBLISH,
    "publish_nb_committed": _NB_PUBLISH,
    "stream_dedup": _W + FEED_CTES + " SELECT DISTINCT feed, key FROM arts",
    "stream_dedup_events": "SELECT DISTINCT user_id, event_type FROM events",
    "index_matches": _W + FEED_CTES + " SELECT feed, key, kw_ord, leader FROM mt",
    "stream_headlines": _W + FEED_CTES + " SELECT feed, key, kw_ord, leader, text FROM hla",
    "stream_publish": _NB_PUBLISH,
    "stream_publish_knn": _KNN_PUBLISH,
}
