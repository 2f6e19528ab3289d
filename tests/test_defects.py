"""Guards for reference defects the build fixes."""

import json

from pyspark.sql import functions as F

from valence.operators import knn as K
from valence.plans import feed_queries as FQ
from valence.plans import linear_queries as LQ
from valence.plans.prepare import train_test
from conftest import SF_SMALL


def test_d3_knn_trains_on_the_training_split_only(spark):
    train, test = train_test(spark, SF_SMALL, "en")
    model = K.fit(train.select("doc_id", "label", "words"))
    t_ids = {r.t_id for r in model.vectors.select("t_id").collect()}
    test_ids = {r.doc_id for r in test.select("doc_id").collect()}
    assert t_ids and test_ids and not (t_ids & test_ids)


def test_d5_unknown_words_pool_on_reserved_id(spark):
    vocab = spark.createDataFrame([("a", 1), ("b", 2)], "term string, term_id int")
    docs = spark.createDataFrame([(1, ["a", "x", "y", "x", "b", "b"])], "doc_id long, words array<string>")
    v = K.sparse_vectors(docs, vocab).first()
    assert list(zip(v.terms, v.counts)) == [(0, 3), (1, 1), (2, 2)] and v.norm2 == 9 + 1 + 4


def test_d12_nb_record_polarity_is_a_scalar(spark):
    for r in FQ.q_publish_nb(spark, SF_SMALL).collect():
        rec = json.loads(r.value)
        assert set(rec) == {"news", "leader", "naviesBayesPolarity"}
        assert isinstance(rec["naviesBayesPolarity"], float)


def test_d18_linear_record_carries_class_and_probability(spark):
    rows = LQ.q_publish_linear(spark, SF_SMALL).collect()
    assert rows
    for r in rows:
        rec = json.loads(r.value)
        assert rec["lstmclass"] in (0.0, 1.0) and 0.5 <= rec["lstmpolarity"] <= 1.0


def test_linear_publishing_keeps_headlines_without_tokens(spark):
    from valence.operators import linear as L
    docs = spark.createDataFrame([("a", []), ("b", ["market", "falls"])], "doc_id string, tokens array<string>")
    vocab = spark.createDataFrame([("market", 2)], "term string, term_id int")
    vecs = spark.createDataFrame([(2, [1.0, 2.0])], "term_id int, vec array<float>")
    got = {r.doc_id: r.features.toArray().tolist() for r in L.pooled_vectors(docs, vocab, vecs).collect()}
    assert got == {"a": [0.0, 0.0], "b": [0.5, 1.0]}
    heads = FQ.q_headlines_all(spark, SF_SMALL).count()
    assert LQ.q_publish_linear(spark, SF_SMALL).count() == heads
