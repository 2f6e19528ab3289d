"""Positional search index of articles in Parquet.

An index is a folder of segments. A segment holds one row for each word of an
article, ``(term, page, item, doc, positions)``, in folders by
bucket of the term and sorted by term, written with Parquet's delta encodings
(positions as differences, terms as suffixes), and once for each article its
``(page, item, doc, feed, key)``: a key may be as long as a text, so it does not go
with every word. Each micro-batch of a stream
adds a segment; :func:`merge` puts all of them into one. A search reads only
the buckets of its own words.

The live segments are named in a manifest, one numbered file for each commit,
so readers never see a segment that was not finished or one that was merged. An index
has one writer at a time. A segment that is written again under its name
replaces itself; postings that reach the index twice count once.

``doc`` is a hash of feed, key and text: articles with equal positions in the feed
but other keys or texts keep their words apart. A term of very many articles is
spread over several files of its bucket.
"""

from __future__ import annotations

import json
import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valence.functions.text import clean_text
from valence.operators.feeds import keyword_table

BUCKETS = 64
IDS = ["feed", "key", "page", "item"]
PLACE = ["page", "item", "doc"]
POSTINGS = "term STRING, page BIGINT, item BIGINT, doc BIGINT, positions ARRAY<INT>"
SCHEMA = f"{POSTINGS}, segment STRING, bucket INT"
ARTICLES = "page BIGINT, item BIGINT, doc BIGINT, feed STRING, key STRING, segment STRING"


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _commits(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _files(spark, os.path.join(path, "manifest"))
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def segments(spark: SparkSession, path: str) -> tuple[list[str], int]:
    """Names of the live segments and the number of buckets (0: no index)."""
    commits = _commits(spark, path)
    if not commits:
        return [], 0
    name = os.path.join(path, "manifest", f"{commits[-1]:010d}.json")
    state = json.loads(spark.read.text(name, wholetext=True).first()[0])
    return state["segments"], state["buckets"]


def _commit(spark: SparkSession, path: str, live: list[str], buckets: int) -> None:
    number = max(_commits(spark, path), default=0) + 1
    target = os.path.join(path, "manifest", f"{number:010d}.json")
    fs, draft = _files(spark, f"{target}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps({"segments": live, "buckets": buckets}).encode()))
    out.close()
    final = _files(spark, target)[1]
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"another writer has committed {target}")


def _bucket(term: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _doc() -> Column:
    # a null counts as a value of its own
    return F.xxhash64(*(x for c in ("feed", "key", "text") for x in (F.col(c).isNull(), F.col(c))))


def postings(arts: DataFrame) -> DataFrame:
    """``(term, page, item, doc, positions)`` of the cleaned text. The words of
    an article are grouped where it is read; none is shuffled for that."""
    words = arts.select(F.col("page").cast("bigint"), F.col("item").cast("bigint"), _doc().alias("doc"),
                        F.split(clean_text("text"), " ").alias("words"))

    def run(batches):
        for b in batches:
            lists = b.column(3)
            flat = lists.flatten().dictionary_encode()
            n = lists.value_lengths().to_numpy()
            row, first = np.repeat(np.arange(len(n)), n), np.repeat(np.cumsum(n) - n, n)
            group = row * len(flat.dictionary) + flat.indices.to_numpy()
            by = np.argsort(group, kind="stable")  # positions stay in order
            new = np.flatnonzero(np.append(True, np.diff(group[by]) != 0)) if len(by) else by
            at = pa.array(row[by[new]])
            found = pa.ListArray.from_arrays(pa.array(np.append(new, len(by)), pa.int32()),
                                             pa.array((np.arange(len(row)) - first)[by], pa.int32()))
            yield pa.RecordBatch.from_arrays([flat.dictionary.take(flat.indices.take(pa.array(by[new]))),
                                              *(b.column(i).take(at) for i in range(3)), found],
                                             names=["term", *PLACE, "positions"])

    return words.mapInArrow(run, POSTINGS)


def _write(rows: DataFrame, path: str, name: str, buckets: int) -> None:
    (rows.withColumn("bucket", _bucket("term", buckets))
     # files of even size: small buckets share a task, large ones are split
     .hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", *PLACE)
     .write.mode("overwrite").option("parquet.writer.version", "v2").partitionBy("bucket")
     .parquet(os.path.join(path, "segments", f"segment={name}")))


def _write_articles(rows: DataFrame, path: str, name: str) -> None:
    rows.write.mode("overwrite").parquet(os.path.join(path, "articles", f"segment={name}"))


def add_segment(arts: DataFrame, path: str, name: str, buckets: int = BUCKETS) -> None:
    """Index ``arts`` ``(feed, key, page, item, text)`` as segment ``name``.
    The number of buckets is fixed by the first segment."""
    spark = arts.sparkSession
    live, fixed = segments(spark, path)
    _write(postings(arts), path, name, fixed or buckets)
    _write_articles(arts.select(F.col("page").cast("bigint"), F.col("item").cast("bigint"), _doc().alias("doc"), "feed", "key"), path, name)
    _commit(spark, path, sorted({*live, name}), fixed or buckets)


def _live(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    live, _ = segments(spark, path)
    if not live:
        return spark.createDataFrame([], schema)
    root = os.path.join(path, kind)
    return (spark.read.schema(schema).option("basePath", root)
            .parquet(*(os.path.join(root, f"segment={s}") for s in live)))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The postings of the live segments."""
    return _live(spark, path, "segments", SCHEMA)


def articles(spark: SparkSession, path: str) -> DataFrame:
    """The articles of the live segments; one that came twice is there twice."""
    return _live(spark, path, "articles", ARTICLES)


def _same(a: str, b: str) -> list[Column]:
    return [F.col(f"{a}.doc") == F.col(f"{b}.doc"), *(F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in ("page", "item"))]


def merge(spark: SparkSession, path: str) -> None:
    """Put the live segments into one; :func:`vacuum` removes the old ones."""
    live, buckets = segments(spark, path)
    if len(live) < 2:
        return
    name = f"merged-{uuid.uuid4().hex[:12]}"
    rows = read(spark, path).drop("segment", "bucket")
    arts = articles(spark, path).drop("segment")
    # only postings of articles that came more than once can be there twice
    twice = arts.groupBy(*PLACE).count().where("count > 1").drop("count")
    if not twice.isEmpty():
        near = [rows.alias("r").join(twice.alias("t"), _same("r", "t"), how) for how in ("left_anti", "left_semi")]
        rows = near[0].unionByName(near[1].dropDuplicates(["term", *PLACE]))
    _write(rows, path, name, buckets)
    _write_articles(arts.dropDuplicates(PLACE), path, name)
    _commit(spark, path, [name], buckets)


def vacuum(spark: SparkSession, path: str) -> None:
    """Delete segments that are not live and manifests but the last, when no
    reader of an earlier state is left."""
    live, _ = segments(spark, path)
    commits = _commits(spark, path)
    for kind in ("segments", "articles"):
        fs, folder = _files(spark, os.path.join(path, kind))
        for s in fs.listStatus(folder) if fs.exists(folder) else []:
            if s.getPath().getName().removeprefix("segment=") not in live:
                fs.delete(s.getPath(), True)
    for n in commits[:-1]:
        fs.delete(_files(spark, os.path.join(path, "manifest", f"{n:010d}.json"))[1], False)


def search(spark: SparkSession, path: str, keywords) -> DataFrame:
    """P10 + J8 from the index: distinct ``(feed, key, page, item, kw_ord,
    leader)`` of the articles that hold a keyword of the list as whole words.

    Every word of the keywords is looked up in its bucket; for a phrase the
    positions less the word's place in it must meet in one start."""
    _, buckets = segments(spark, path)
    words = (keyword_table(spark, keywords)
             .select("kw_ord", "leader", F.split("leader", " ").alias("w"))
             .select("kw_ord", "leader", F.size("w").alias("n"), F.posexplode("w").alias("i", "term")))
    # as many rows as the caller's own list has words
    asked = words.select("term", _bucket("term", buckets or 1).alias("bucket")).distinct().collect()
    rows = read(spark, path).where(F.col("bucket").isin(sorted({r.bucket for r in asked}))
                                   & F.col("term").isin(sorted({r.term for r in asked})))
    hits = rows.join(words, "term")
    single = hits.where("n = 1").select(*PLACE, "kw_ord", "leader")
    starts = F.transform("positions", lambda p: p - F.col("i"))
    places = F.transform("s", lambda x: x["at"])
    common = F.aggregate(F.slice(places, 2, F.col("n")), F.get(places, 0), F.array_intersect)
    phrases = (hits.where("n > 1").groupBy(*PLACE, "kw_ord", "leader", "n")
               .agg(F.collect_set(F.struct("i", starts.alias("at"))).alias("s"))
               .where((F.size("s") == F.col("n")) & (F.size(common) > 0)).select(*PLACE, "kw_ord", "leader"))
    found = single.unionByName(phrases).alias("f").join(articles(spark, path).alias("a"), _same("f", "a"))
    return found.select("a.feed", "a.key", "a.page", "a.item", "kw_ord", "leader").distinct()
