import pathlib

from pyspark.sql import functions as F

from valence.operators import vocab as V
from valence.plans.prepare import filtered_tokens, train_test, without_stop_words
from valence.session import freeze
from conftest import SF_SMALL


def test_freeze_keeps_rows_and_cuts_lineage(spark):
    df = spark.range(200).withColumn("g", F.col("id") % 7).groupBy("g").agg(F.sum("id").alias("s"))
    frozen = freeze(df)
    assert sorted(map(tuple, frozen.collect())) == sorted(map(tuple, df.collect()))
    logical = frozen._jdf.queryExecution().logical().toString()
    assert "LogicalRDD" in logical and "Aggregate" not in logical
    assert not frozen.is_cached and not df.is_cached      # the helper's cache is released


def test_dropping_the_empty_filter_keeps_term_counts(spark):
    train, _ = train_test(spark, SF_SMALL)
    a = {tuple(r) for r in V.term_frequencies(without_stop_words(train), "tokens").collect()}
    b = {tuple(r) for r in V.term_frequencies(filtered_tokens(train), "tokens").collect()}
    assert a == b and len(a) > 0


def test_global_row_number_on_empty_input(spark):
    from valence.operators.ranking import global_row_number
    empty = spark.range(10).filter("id < 0")
    assert global_row_number(empty, [F.col("id")]).count() == 0


def test_stream_state_moves_off_heap_unless_chosen(spark):
    from valence.streaming import ingest
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, ingest._HEAP_STORE)
        with ingest._disk_backed_state(spark):
            assert spark.conf.get(key) == ingest._ROCKSDB_STORE
        assert spark.conf.get(key) == ingest._HEAP_STORE
        spark.conf.set(key, "some.other.Provider")
        with ingest._disk_backed_state(spark):
            assert spark.conf.get(key) == "some.other.Provider"
    finally:
        spark.conf.set(key, old)


def test_stored_rows_take_no_room_in_the_cache_and_less_on_disk(spark, monkeypatch):
    """Before, tokens and headlines were cached and checkpointed, neither compressed."""
    import valence.session as session
    df = spark.range(2000).selectExpr("id", "array_repeat('some word', 200) as tokens", "cast(null as string) as text")
    paths = []
    monkeypatch.setattr(session, "scratch_path", lambda s, name, f=session.scratch_path: paths.append(f(s, name)) or paths[-1])
    stored = session.store(df)
    assert stored.dtypes == df.dtypes and stored.exceptAll(df).count() == df.exceptAll(stored).count() == 0
    size = sum(f.stat().st_size for f in pathlib.Path(paths[0].removeprefix("file:")).rglob("*.parquet"))
    assert 0 < size < 2000 * 200 * 9 / 4


def test_publishing_stores_what_the_models_read(spark):
    from valence.plans.feed_queries import _headline_docs
    h = spark.createDataFrame([("A", "k", "w", "t")], "feed string, key string, leader string, text string")
    assert "parquet" in spark._jvm.PythonSQLUtils.explainString(_headline_docs(h)._jdf.queryExecution(), "simple")
