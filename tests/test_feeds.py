import re

from pyspark.sql import functions as F

from valence.operators import feeds as FD
from valence.sources.feeds import articles, parse_payloads, payloads_from_tables
from conftest import SF_SMALL

ART_SCHEMA = "feed string, key string, page long, item long, title string, text string"


def test_whole_word_phrase_match(spark):
    arts = spark.createDataFrame([("A", "k1", 0, 0, "t", "Joe Biden said"), ("A", "k2", 0, 1, "t", "joebiden"),
                                  ("A", "k3", 0, 2, "t", "Biden, Joe"), ("A", None, 0, 3, "t", "so joe biden"),
                                  ("A", "k5", 0, 4, "t", None)], ART_SCHEMA)
    kw = FD.keyword_table(spark, ("joe biden", "joe"))
    got = {(r.key, r.leader) for r in FD.match_keywords(arts, kw).collect()}
    assert got == {("k1", "joe biden"), (None, "joe biden"), ("k1", "joe"), ("k3", "joe"), (None, "joe")}


def test_a_keyword_on_a_late_line_is_found(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    text = docs.where("doc_id = 4").first().text
    late = text.split("\n")[-1].lower().replace(".", " ").replace(",", " ").split()[-2:]
    got = FD.match_keywords(articles(spark, SF_SMALL), FD.keyword_table(spark, (" ".join(late),)))
    assert 4 in {r.item for r in got.where("feed = 'A'").collect()}


def test_match_plan_has_no_nested_loop_and_carries_no_text(spark):
    m = FD.match_keywords(articles(spark, SF_SMALL), FD.keyword_table(spark, ("that", "of the")))
    plan = spark._jvm.PythonSQLUtils.explainString(m._jdf.queryExecution(), "simple")
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_matching_shuffles_nothing(spark):
    """Before, every distinct word of every article was shuffled with the article's key."""
    arts = articles(spark, SF_SMALL)
    m = FD.match_keywords(arts, FD.keyword_table(spark, ("that", "of the")))
    plan = spark._jvm.PythonSQLUtils.explainString(m._jdf.queryExecution(), "simple")
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_headlines_of_long_keys_are_numbered_for_the_models(spark):
    from valence.plans.feed_queries import _headline_docs
    h = spark.createDataFrame([("A", "k" * 5000, "w", "t1"), ("A", None, "w", "t2"), ("A", "", "w", "t3")],
                              "feed string, key string, leader string, text string")
    rows = _headline_docs(h).collect()
    assert len({r.doc_id for r in rows}) == 3 and all(isinstance(r.doc_id, int) for r in rows)
    assert {(r.key, r.text) for r in rows} == {("k" * 5000, "t1"), (None, "t2"), ("", "t3")}


def test_headline_takes_the_least_text_of_its_place_even_without_the_keyword(spark):
    arts = spark.createDataFrame([("A", "k", 0, 1, "z rain"), ("A", "k", 0, 1, "a sun"), ("A", "k", 0, 0, "snow rain"),
                                  ("A", None, None, 2, "rain"), ("A", "n", 0, 3, "sun")],
                                 "feed string, key string, page long, item long, text string")
    got = {(r.key, r.leader, r.page, r.item, r.text)
           for r in FD.headlines(arts, FD.keyword_table(spark, ["rain", "snow"])).collect()}
    assert got == {("k", "rain", 0, 0, "snow rain"), (None, "rain", None, 2, "rain")}


def test_key_under_two_keywords_keeps_first_keyword(spark):
    arts = spark.createDataFrame([("A", "k", 0, 0, "t", "alpha beta")], ART_SCHEMA)
    kw = FD.keyword_table(spark, ("beta", "alpha"))
    h = FD.headlines(arts, kw).collect()
    assert len(h) == 1 and h[0].leader == "beta" and h[0].kw_ord == 0


def test_first_n_cuts_before_dedup(spark):
    rows = [("A", f"k{i}", 0, i, "t", "w") for i in range(15)]
    arts = spark.createDataFrame(rows, ART_SCHEMA)
    kw = FD.keyword_table(spark, ("w",))
    h = FD.headlines(arts, kw, n=10)
    assert sorted(r.item for r in h.collect()) == list(range(10))
    assert FD.headlines(arts, kw).count() == 15


def test_repeated_articles_give_one_headline(spark):
    """Repeated rows, also with another text under one position, stay one
    headline, so joins on its key do not multiply."""
    arts = spark.createDataFrame(
        [("A", "k1", 0, 1, "b rain"), ("A", "k1", 0, 1, "b rain"), ("A", "k1", 0, 1, "a rain"),
         ("A", "k2", 0, 2, "snow"), ("B", None, 1, 1, "rain snow"), ("B", None, 1, 1, "rain snow")],
        "feed string, key string, page long, item long, text string")
    kw = FD.keyword_table(spark, ["rain", "snow"])
    got = sorted((r.feed, r.key or "", r.leader, r.text) for r in FD.headlines(arts, kw).collect())
    assert got == [("A", "k1", "rain", "a rain"), ("A", "k2", "snow", "snow"), ("B", "", "rain", "rain snow")]


def _nodes(df, kind):
    """The formatted plan's entries of one kind of operator."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [e for e in text.split("\n\n") if re.match(rf"\s*\(\d+\) {kind}\b", e)]


def test_headlines_shuffle_each_text_and_key_once(spark):
    """Before, keys went through an exchange with each keyword, and texts through two."""
    h = FD.headlines(articles(spark, SF_SMALL), FD.keyword_table(spark, ("that", "of the")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        carried = [e for e in _nodes(h, "Exchange") if re.search(r"\b(text|key)#", e)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(carried) == 1


def test_first_places_are_sorted_without_keys(spark):
    """Before, the matches of a whole task were sorted with their keys."""
    near = FD.at_first_places(articles(spark, SF_SMALL), FD.keyword_table(spark, ("that", "of the")))
    cuts = _nodes(near, "WindowGroupLimit")
    assert cuts and not any("key#" in e for e in cuts)


def test_articles_that_share_a_place_are_cut_by_key(spark):
    arts = spark.createDataFrame([("A", f"k{9 - i}", 0, i // 4, "w x") for i in range(8)] + [("A", None, None, 5, "w")],
                                 "feed string, key string, page long, item long, text string")
    kw = FD.keyword_table(spark, ("w", "x"))
    got = {(r.key, r.kw_ord) for r in FD.headlines(arts, kw, n=3).collect()}
    assert got == {(None, 0), ("k6", 0), ("k7", 0), ("k8", 1)}
    assert FD.headlines(arts, kw.where("kw_ord > 5")).count() == 0


def test_unseen_drops_published_keys(spark):
    rows = spark.createDataFrame([("A", "a"), ("B", "a"), ("A", "b")], "feed string, key string")
    seen = spark.createDataFrame([("A", "a")], "feed string, key string")
    assert {tuple(r) for r in FD.unseen(rows, seen).collect()} == {("B", "a"), ("A", "b")}


def test_payload_roundtrip_keeps_every_article(spark):
    p = payloads_from_tables(spark, SF_SMALL)
    arts = parse_payloads(p)
    n_docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    n_pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").count()
    n_conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").count()
    counts = {r.feed: r["count"] for r in arts.groupBy("feed").count().collect()}
    assert counts == {"A": n_docs, "B": n_pages, "C": n_conv}
    assert arts.filter(F.col("feed") == "A").select("page", "item").distinct().count() == n_docs


def test_null_description_gives_title(spark):
    p = spark.createDataFrame(
        [("A", 0, '{"page":0,"articles":[{"title":"t","description":null},{"title":"u","description":"d"}]}')],
        "feed string, page long, payload string")
    got = {r.key: r.text for r in parse_payloads(p).collect()}
    assert got == {"t": "t", "u": "u d"}


def test_long_conversation_pages_stay_bounded(spark):
    """Feed C payloads hold at most PAGE_SIZE stories, and positions follow
    the turn order across chunks."""
    from valence.sources import feeds as SF
    conv = spark.createDataFrame([(7, t, f"turn {t}") for t in range(250)],
                                 "conv_id long, turn long, text string")
    first = (F.floor(F.col("turn") / SF.PAGE_SIZE) * SF.PAGE_SIZE).cast("bigint")
    paged = SF._paged(conv.withColumn("id", F.concat_ws(":", "conv_id", "turn")).withColumnRenamed("text", "title"),
                      F.col("conv_id"), F.col("turn"), F.struct("id", "title"), first)
    sizes = sorted(r[0] for r in paged.select(F.size("items")).collect())
    assert sizes == [50, 100, 100]
    payloads = paged.select(F.lit("C").alias("feed"), "page",
                            F.to_json(F.struct("page", "first", F.col("items").alias("stories"))).alias("payload"))
    arts = parse_payloads(payloads).select("key", "page", "item").collect()
    assert sorted((r.page, r.item, r.key) for r in arts) == [(7, t, f"7:{t}") for t in range(250)]


def test_payload_files_read_back_as_the_same_articles(spark):
    """S5 from files: JSON-lines payloads written per feed and read back give
    the same article rows."""
    from valence.session import scratch_path
    from valence.sources.feeds import read_feed_files, write_payload_files
    path = scratch_path(spark, "feed-files")
    write_payload_files(payloads_from_tables(spark, SF_SMALL), path)
    back = None
    for feed in ("A", "B", "C"):
        part = read_feed_files(spark, f"{path}/feed={feed}", feed)
        back = part if back is None else back.unionByName(part)
    cols = ["feed", "key", "page", "title", "text"]
    want = {tuple(r) for r in articles(spark, SF_SMALL).select(*cols).collect()}
    got = {tuple(r) for r in back.select(*cols).collect()}
    assert got == want and len(want) > 0
