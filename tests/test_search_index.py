import random

from valence.operators import feeds as FD
from valence.operators import search_index as SI
from valence.session import scratch_path
from valence.streaming import ingest

WORDS = ["alpha", "beta", "gamma", "delta", "of", "the"]
LEADERS = ["alpha", "of the", "the of the", "Beta beta", "gamma delta of", "none", "beta-gamma"]
SCHEMA = "feed string, key string, page long, item long, text string"


def rows(seed, n=60):
    rng = random.Random(seed)
    out = [("A", f"k{i}", i // 10, i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 12)))) for i in range(n)]
    return out + [("A", "k1", 0, 1, "of the of the"), ("B", None, 0, 0, "the of the"), ("B", "x", 0, 0, None),
                  ("B", "y", 0, 0, ""), ("B", "long", 1, 1, "of " * 50_000 + "the")]


def phrase(text, leader):
    return f" {leader} " in f" {text} "


def test_index_equals_scan_before_and_after_merge(spark):
    path = scratch_path(spark, "index")
    data = rows(1)
    assert SI.search(spark, path, LEADERS).count() == 0
    for i, part in enumerate((data[:20], data[20:40], data[40:] + data[:5])):
        SI.add_segment(spark.createDataFrame(part, SCHEMA), path, f"s{i}", buckets=8)
    SI.add_segment(spark.createDataFrame(data[20:40], SCHEMA), path, "s1")  # the batch comes again
    want = {tuple(r) for r in FD.match_keywords(spark.createDataFrame(data, SCHEMA), FD.keyword_table(spark, LEADERS))
            .select(*SI.IDS, "kw_ord", "leader").collect()}
    got = lambda: [tuple(r) for r in SI.search(spark, path, LEADERS).collect()]
    assert len(SI.segments(spark, path)[0]) == 3 and len(got()) == len(want) and set(got()) == want
    clean = [r.leader for r in FD.keyword_table(spark, LEADERS).orderBy("kw_ord").collect()]
    brute = {(*r[:4], k, w) for r in data for k, w in enumerate(clean) if phrase(r[4] or " ", w)}
    assert want == brute
    SI.merge(spark, path)
    SI.vacuum(spark, path)
    live, buckets = SI.segments(spark, path)
    assert len(live) == 1 and buckets == 8 and len(got()) == len(want) and set(got()) == want


def test_search_reads_only_its_buckets(spark):
    path = scratch_path(spark, "index")
    SI.add_segment(spark.createDataFrame(rows(2), SCHEMA), path, "s", buckets=16)
    plan = SI.search(spark, path, ["alpha"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket#", "bucket#").replace("(bucket#", "bucket#") \
        and "PushedFilters: [" in plan and "term" in plan.split("PushedFilters")[1][:80]


def test_unfinished_segments_are_not_seen(spark):
    path = scratch_path(spark, "index")
    SI.add_segment(spark.createDataFrame(rows(3)[:10], SCHEMA), path, "s")
    before = SI.search(spark, path, LEADERS).count()
    SI._write(SI.postings(spark.createDataFrame(rows(3), SCHEMA)), path, "broken", SI.BUCKETS)
    assert SI.search(spark, path, LEADERS).count() == before
    SI.add_segment(spark.createDataFrame([], SCHEMA), path, "empty")
    assert SI.search(spark, path, LEADERS).count() == before


def test_first_headlines_for_any_order_of_files_and_a_restart(spark):
    data = [r for r in rows(4) if r[1] is not None] + [("A", f"k{i}", 50, i, "alpha") for i in range(0, 60, 2)]
    arts = spark.createDataFrame(data, SCHEMA)
    want = {tuple(r) for r in FD.headlines(arts, FD.keyword_table(spark, LEADERS)).select(
        "feed", "key", "kw_ord", "page", "item", "leader").collect()}
    for order in (1, -1):
        root = scratch_path(spark, "first")
        for n, part in enumerate([data[:30], data[30:70], data[70:]][::order]):
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").json(f"{root}/src")
            if n:  # the second run starts from the checkpoint of the first
                ingest.first_headlines(spark, f"{root}/src", f"{root}/out", f"{root}/check", LEADERS, 1)
        got = [tuple(r) for r in ingest.read_headlines(spark, f"{root}/out").select(
            "feed", "key", "kw_ord", "page", "item", "leader").collect()]
        assert set(got) == want and len(got) == len(want)


def test_long_keys_are_held_once_and_keep_articles_apart(spark):
    """Before, each word of an article carried its key."""
    path = scratch_path(spark, "index")
    data = [("A", "k" * 50_000 + str(i), 0, i % 3, " ".join(["alpha"] + [f"w{j}" for j in range(500)])) for i in range(6)]
    data += [("A", None, 0, 0, "alpha"), (None, "A", 0, 0, "alpha"), ("B", None, None, None, "of the"), ("B", "", None, None, "of the")]
    for i, part in enumerate((data[:5], data[5:] + data[:2])):
        SI.add_segment(spark.createDataFrame(part, SCHEMA), path, f"s{i}", buckets=4)
    want = {(*r[:4], k, w) for r in data for k, w in enumerate(("alpha", "of the")) if phrase(r[4], w)}
    assert "key" not in SI.read(spark, path).columns
    for _ in range(2):
        got = [tuple(r) for r in SI.search(spark, path, ["alpha", "of the"]).collect()]
        assert len(got) == len(want) == 10 and set(got) == want
        SI.merge(spark, path)
        SI.vacuum(spark, path)
    assert SI.read(spark, path).groupBy("term", *SI.PLACE).count().where("count > 1").count() == 0
    assert SI.articles(spark, path).count() == 10
