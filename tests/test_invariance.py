"""Repartitioning the input or changing the shuffle partition count must not
change any result (SURVEY §5, item 4)."""

from contextlib import contextmanager

from valence.operators import knn as K
from valence.operators import naive_bayes as NB
from valence.operators import vocab as V
from valence.plans.prepare import train_test
from conftest import SF_SMALL


@contextmanager
def shuffle_partitions(spark, n):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def _nb(train, test):
    tf = NB.term_counts(train.select("doc_id", "label", "tokens"))
    model = NB.fit(train.select("doc_id", "label", "tokens"), V.count_vectorizer_vocab(tf), train_tf=tf)
    pred = NB.predict(model, test.select("doc_id", "label", "tokens"))
    return {(r.doc_id, r.prediction, r.zero_factors, round(r.log_score, 9)) for r in pred.collect()}


def _knn(train, test):
    model = K.fit(train.select("doc_id", "label", "words"))
    return {tuple(r) for r in K.predict(model, test.select("doc_id", "label", "words"), 10).collect()}


def test_vocabulary_ids_do_not_depend_on_partitioning(spark):
    train, _ = train_test(spark, SF_SMALL)
    tf = V.term_frequencies(train, "tokens")
    base = {tuple(r) for r in V.build_vocab(tf).collect()}
    with shuffle_partitions(spark, 7):
        other = {tuple(r) for r in V.build_vocab(tf.repartition(1)).collect()}
    assert base == other and len(base) > 100


def test_naive_bayes_does_not_depend_on_partitioning(spark):
    train, test = train_test(spark, SF_SMALL)
    base = _nb(train, test)
    with shuffle_partitions(spark, 3):
        other = _nb(train.repartition(5), test.repartition(2))
    assert base == other and len(base) > 0


def test_knn_does_not_depend_on_partitioning(spark):
    train, test = train_test(spark, SF_SMALL, "en")
    base = _knn(train, test)
    with shuffle_partitions(spark, 5):
        other = _knn(train.repartition(3), test.repartition(7))
    assert base == other and len(base) > 0
