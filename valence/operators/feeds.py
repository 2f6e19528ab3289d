"""Feed operators: keyword match, per-keyword cut, de-duplication, recency
(P9-P12, J6, J8, W2, W3, T3, U2).

The reference loops over keywords on the driver, asks each news service for
articles about the keyword, keeps the first few of each response, skips keys
it has already published (one in-memory set per feed) and appends the rest.
Here the same result is one declarative plan over the article table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valence.functions.text import clean_text

# Articles kept per (feed, keyword) where the cut is asked for, and the recency
# window in days.
FIRST_N = 10
RECENT_DAYS = 31


def keyword_table(spark: SparkSession, keywords) -> DataFrame:
    """S3: ``(kw_ord, leader)`` from a small in-memory list, lower-cased and
    cleaned like article text so phrase matching compares like with like."""
    rows = [(i, k) for i, k in enumerate(keywords)]
    kw = spark.createDataFrame(rows, "kw_ord int, leader string")
    return kw.select("kw_ord", clean_text("leader").alias("leader"))


def _phrase_in(text: Column, phrase: Column) -> Column:
    """Whole-word phrase test on single-space separated text."""
    return F.contains(F.concat(F.lit(" "), text, F.lit(" ")), F.concat(F.lit(" "), phrase, F.lit(" ")))


def _matched(clean: Column, keywords: DataFrame) -> Column:
    """``(kw_ord, leader)`` of each keyword in a cleaned text, as an array. The
    keywords are a list in the caller's memory and become a literal: the words
    of the text meet their first words, then the phrases are tested."""
    begin: dict[str, list[Column]] = {}
    for r in keywords.select("kw_ord", "leader").collect():
        entry = F.struct(F.lit(r.kw_ord).cast("int").alias("kw_ord"), F.lit(r.leader).alias("leader"))
        begin.setdefault(r.leader.split(" ")[0], []).append(entry)
    if not begin:
        return F.array().cast("array<struct<kw_ord: int, leader: string>>")
    first = F.array(*map(F.lit, begin))
    entries = F.map_from_arrays(first, F.array(*(F.array(*e) for e in begin.values())))

    def found(text: Column) -> Column:
        begun = F.array_intersect(F.split(text, " "), first)
        return F.filter(F.flatten(F.transform(begun, lambda w: F.element_at(entries, w))),
                        lambda k: _phrase_in(text, k["leader"]))

    # bound as a variable, the text is cleaned once and not for each keyword
    return F.get(F.transform(F.array(clean), found), 0)


def match_keywords(arts: DataFrame, keywords: DataFrame) -> DataFrame:
    """P10 + J8: ``(feed, key, page, item, kw_ord, leader)`` for every article
    whose cleaned text contains the keyword as whole words.

    An article meets the keywords where it is read. No word and no text is
    shuffled, and any number of keywords has the same plan.
    """
    ids = ["feed", "key", "page", "item"]
    return (arts.select(*ids, clean_text("text").alias("_clean"))
            .select(*ids, F.explode(_matched(F.col("_clean"), keywords)).alias("_kw"))
            .select(*ids, "_kw.*"))


def match_rows(arts: DataFrame, leaders) -> DataFrame:
    """:func:`match_keywords` without a second look at ``arts``, so that it
    also runs on a stream; every column of ``arts`` stays. Only words that
    begin a keyword of the list are exploded, at most one row for each."""
    keywords = keyword_table(arts.sparkSession, leaders).withColumn("_w", F.get(F.split("leader", " "), 0))
    first = [r._w for r in keywords.select("_w").distinct().collect()]  # as long as the caller's own list
    clean = clean_text("text")
    begun = F.array_intersect(F.split(clean, " "), F.array(*map(F.lit, first)).cast("array<string>"))
    return (arts.withColumn("_w", F.explode(begun)).join(keywords, "_w")
            .where(_phrase_in(clean, F.col("leader"))).drop("_w"))


def first_n_per_keyword(matches: DataFrame, n: int = FIRST_N) -> DataFrame:
    """The first ``n`` articles of each (feed, keyword) by position.
    Catalyst plans a partial WindowGroupLimit before the shuffle, so a hot
    keyword ships at most ``n`` rows per map task."""
    w = Window.partitionBy("feed", "kw_ord").orderBy("page", "item", "key")
    return matches.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def at_first_places(arts: DataFrame, keywords: DataFrame, n: int = FIRST_N) -> DataFrame:
    """The articles that stand at one of the first ``n`` places of a feed for
    some keyword. A key may be as long as a text, so the places are found
    without it: what is sorted has a few numbers in a row. Articles that share a
    place stay together, for :func:`first_n_per_keyword` to tell them apart."""
    w = Window.partitionBy("feed", "kw_ord").orderBy("page", "item")
    places = (match_keywords(arts, keywords).select("feed", "kw_ord", "page", "item")
              .withColumn("rank", F.rank().over(w)).where(F.col("rank") <= n)
              .select("feed", "page", "item").distinct())
    # n places at most for each feed and keyword of the caller's list
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("feed", "page", "item")]
    return arts.alias("a").join(F.broadcast(places.alias("p")), same, "left_semi")


def first_per_key(rows: DataFrame) -> DataFrame:
    """One row per (feed, key), the earliest keyword winning, then
    the earliest position. A min_by aggregate combines map-side, so a key
    repeated across a third of the input still reduces before the shuffle."""
    cols = [c for c in rows.columns if c not in ("feed", "key")]
    best = (rows.groupBy("feed", "key")
            .agg(F.min_by(F.struct(*cols), F.struct("kw_ord", "page", "item")).alias("_b")))
    return best.select("feed", "key", "_b.*")


def unseen(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """Drop keys already published (``seen`` has ``feed, key``)."""
    return rows.join(seen.select("feed", "key"), ["feed", "key"], "left_anti")


def headlines(arts: DataFrame, keywords: DataFrame, n: int | None = None) -> DataFrame:
    """The reference's news list: the articles matching each keyword, each feed
    key kept once under its first keyword; with ``n``, only the first ``n``
    articles of each feed and keyword count.
    ``(feed, key, kw_ord, leader, page, item, text)``. Articles that repeat
    their feed, key and position give one headline, with the least text."""
    ids = ["feed", "key", "page", "item"]
    if n is None:
        return _all_headlines(arts.select(*ids, "text"), keywords)
    near = at_first_places(arts.select(*ids, "text"), keywords, n)
    # n rows at most for each feed and keyword of the caller's list
    kept = F.broadcast(first_per_key(first_n_per_keyword(match_keywords(near, keywords), n).drop("rank")))
    same = [F.col(f"h.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ids]
    return (kept.alias("h").join(near.alias("t"), same)
            .groupBy("h.feed", "h.key", "h.kw_ord", "h.leader", "h.page", "h.item").agg(F.min("t.text").alias("text")))


def _all_headlines(arts: DataFrame, keywords: DataFrame) -> DataFrame:
    """The first place of each key is found from digests of the keys; then each
    text goes through one exchange, to meet the place where it stands."""
    def or_dash(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("-"))

    name = F.concat_ws("/", or_dash(F.col("feed")), or_dash(F.sha2("key", 256)))
    place = F.concat_ws("/", "_name", or_dash(F.col("page")), or_dash(F.col("item")))
    first = (arts.select(name.alias("_name"), "page", "item", clean_text("text").alias("_clean"))
             .select("_name", "page", "item", F.array_min(_matched(F.col("_clean"), keywords)).alias("_kw"))
             .where("_kw is not null")
             .groupBy("_name").agg(F.min(F.struct("_kw.kw_ord", "page", "item", "_kw.leader")).alias("_b"))
             .select("_name", "_b.*").select(place.alias("_place"), "kw_ord", "leader"))
    return (arts.withColumn("_name", name).withColumn("_place", place).drop("_name")
            .join(first, "_place")
            .groupBy("_place").agg(F.min("text").alias("text"),
                                   *(F.first(c).alias(c) for c in ("feed", "key", "kw_ord", "leader", "page", "item")))
            .select("feed", "key", "kw_ord", "leader", "page", "item", "text"))


def recent(df: DataFrame, ts_col: str = "ts", days: int = RECENT_DAYS) -> DataFrame:
    """Rows at most ``days`` days older than the newest row (anchored
    on the data, not on the clock, so the result is reproducible)."""
    newest = df.agg(F.max(ts_col)).scalar()
    return df.filter(F.col(ts_col) >= newest - F.make_dt_interval(days=F.lit(days)))


def newest_pages(df: DataFrame, group_col: str, ts_col: str, id_col: str, n: int = 10,
                 pages: int = 1) -> DataFrame:
    """T3 for pages ``1..pages`` in one pass: ``rank`` and its ``page``."""
    w = Window.partitionBy(group_col).orderBy(F.desc(ts_col), F.asc(id_col))
    return (df.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= pages * n)
            .withColumn("page", ((F.col("rank") - 1) / n).cast("int") + 1))


def source_filter(docs: DataFrame, lang: str = "en", sources=("src1", "src3")) -> DataFrame:
    """Language and source predicates (pushed into the parquet scan)."""
    return docs.filter((F.col("lang") == lang) & F.col("source").isin(list(sources)))
