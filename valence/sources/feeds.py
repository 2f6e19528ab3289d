"""News feed payloads (S5, F16) in the three shapes the reference reads.

Feed A ``{"articles": [{"title", "description"}]}`` keyed by title, feed B
``{"articles": {"results": [{"uri", "title"}]}}`` keyed by uri, feed C
``{"stories": [{"id", "title"}]}`` keyed by id. Each payload also carries
its ``page`` number and the offset ``first`` of its first item in that page;
articles are ordered by ``(page, item)``, item being ``first`` plus the index.

The live HTTP services are not available, so the articles are derived from the
given tables: a document's title is its first line and its description all the
rest, a page's title is its ``<title>`` (feed B carries titles only), and a
turn's title is its text. :func:`articles` gives these rows as such; the
payload functions write them as the services' JSON, in pages of bounded size,
and parse it back with pinned schemas. Feeds A and B page by ``id // PAGE_SIZE``; feed C pages by conversation,
and a conversation is cut into chunks of ``PAGE_SIZE`` turn numbers, so a
very long conversation never becomes one unbounded payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valence.functions.text import title_with_description
from valence.sources.tables import table

PAGE_SIZE = 100

# Pinned payload schemas (only the fields the reference reads, plus page
# and first).
FEED_SCHEMAS = {
    "A": "page BIGINT, first BIGINT, articles ARRAY<STRUCT<title: STRING, description: STRING>>",
    "B": "page BIGINT, first BIGINT, articles STRUCT<results: ARRAY<STRUCT<uri: STRING, title: STRING>>>",
    "C": "page BIGINT, first BIGINT, stories ARRAY<STRUCT<id: STRING, title: STRING>>",
}


def _paged(df: DataFrame, page: F.Column, order: F.Column, item: F.Column,
           first: F.Column | None = None) -> DataFrame:
    """One row per ``(page, first)`` with its items in order. Every group
    holds at most ``PAGE_SIZE`` items, so no group grows with the table."""
    first = F.lit(0).cast("bigint") if first is None else first
    return (df.groupBy(page.alias("page"), first.alias("first"))
            .agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), item.alias("i")))).alias("_a"))
            .select("page", "first", F.col("_a.i").alias("items")))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    at = F.locate("\n", text)
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text).alias("title"),
        F.when(at > 0, F.substring(text, at + 1, F.length(text))).alias("description"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", F.col("url").alias("uri"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.concat_ws(":", "conv_id", "turn").alias("id"), F.col("text").alias("title"))


def _page(col: str) -> Column:
    return F.floor(F.col(col) / PAGE_SIZE).cast("bigint")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article rows ``(feed, key, page, item, title, text)`` of all three
    feeds, straight from the tables; ``item`` orders the articles of a page."""
    a = _documents(spark, sf_dir).select(
        F.lit("A").alias("feed"), F.col("title").alias("key"), _page("doc_id").alias("page"),
        F.col("doc_id").alias("item"), "title", title_with_description("title", "description").alias("text"))
    b = _pages(spark, sf_dir).select(
        F.lit("B").alias("feed"), F.col("uri").alias("key"), _page("page_id").alias("page"),
        F.col("page_id").alias("item"), "title", F.col("title").alias("text"))
    c = _turns(spark, sf_dir).select(
        F.lit("C").alias("feed"), F.col("id").alias("key"), F.col("conv_id").alias("page"),
        F.col("turn").alias("item"), "title", F.col("title").alias("text"))
    return a.unionByName(b).unionByName(c)


def payloads_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(feed, page, payload STRING)`` built from documents (A), pages (B)
    and conversations (C)."""
    a = _paged(_documents(spark, sf_dir), _page("doc_id"), F.col("doc_id"), F.struct("title", "description"))
    a = a.select(F.lit("A").alias("feed"), "page",
                 F.to_json(F.struct("page", "first", F.col("items").alias("articles"))).alias("payload"))
    b = _paged(_pages(spark, sf_dir), _page("page_id"), F.col("page_id"), F.struct("uri", "title"))
    b = b.select(F.lit("B").alias("feed"), "page",
                 F.to_json(F.struct("page", "first", F.struct(F.col("items").alias("results")).alias("articles")))
                 .alias("payload"))
    chunk_first = (F.floor(F.col("turn") / PAGE_SIZE) * PAGE_SIZE).cast("bigint")
    c = _paged(_turns(spark, sf_dir), F.col("conv_id"), F.col("turn"), F.struct("id", "title"), chunk_first)
    c = c.select(F.lit("C").alias("feed"), "page",
                 F.to_json(F.struct("page", "first", F.col("items").alias("stories"))).alias("payload"))
    return a.unionByName(b).unionByName(c)


def parse_payloads(payloads: DataFrame) -> DataFrame:
    """F16 + U1: ``(feed, page, payload)`` -> article rows
    ``(feed, key, page, item, title, text)`` of all three feeds."""
    out = None
    for feed, schema in FEED_SCHEMAS.items():
        p = (payloads.filter(F.col("feed") == feed)
             .select(F.from_json("payload", schema).alias("j")).select("j.*"))
        if feed == "A":
            items = p.select("page", "first", F.posexplode("articles").alias("idx", "a")).select(
                "page", "first", "idx", F.col("a.title").alias("key"), F.col("a.title").alias("title"),
                title_with_description("a.title", "a.description").alias("text"))
        elif feed == "B":
            items = p.select("page", "first", F.posexplode("articles.results").alias("idx", "a")).select(
                "page", "first", "idx", F.col("a.uri").alias("key"), F.col("a.title").alias("title"),
                F.col("a.title").alias("text"))
        else:
            items = p.select("page", "first", F.posexplode("stories").alias("idx", "a")).select(
                "page", "first", "idx", F.col("a.id").alias("key"), F.col("a.title").alias("title"),
                F.col("a.title").alias("text"))
        items = items.select(F.lit(feed).alias("feed"), "key", "page",
                             (F.coalesce("first", F.lit(0)) + F.col("idx")).alias("item"), "title", "text")
        out = items if out is None else out.unionByName(items)
    return out


def read_feed_files(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """S5 from files: JSON-lines payloads of one feed under ``path``."""
    raw = spark.read.text(path).select(F.lit(feed).alias("feed"), F.lit(None).cast("bigint").alias("page"),
                                       F.col("value").alias("payload"))
    return parse_payloads(raw)


def write_payload_files(payloads: DataFrame, path: str) -> None:
    """JSON-lines payload files, one folder per feed (``feed=A`` ...)."""
    payloads.select("feed", "payload").write.mode("overwrite").partitionBy("feed").text(path)
