from collections import Counter

import numpy as np
import pandas as pd

from pyspark.sql import functions as F

from valence.operators import naive_bayes as NB
from valence.operators import vocab as V
from valence.plans.prepare import train_test
from conftest import SF_SMALL


def _fit_predict(spark, train_rows, test_rows):
    tr = spark.createDataFrame([(i, y, t) for i, (y, t) in enumerate(train_rows)],
                               "doc_id long, label int, tokens array<string>")
    te = spark.createDataFrame([(100 + i, y, t) for i, (y, t) in enumerate(test_rows)],
                               "doc_id long, label int, tokens array<string>")
    vocab = V.count_vectorizer_vocab(V.term_frequencies(tr))
    model = NB.fit(tr, vocab)
    pred = NB.predict(model, te).orderBy("doc_id").collect()
    return [int(r.prediction) for r in pred], pred


def _brute(train_rows, test_rows):
    """By definition, on a dense table: a word's likelihood is the share of the
    class's rows with the same count; the largest product wins, then the
    smaller label."""
    x = pd.DataFrame([Counter(t) for _, t in train_rows]).fillna(0)
    y = np.array([label for label, _ in train_rows])
    out = []
    for _, t in test_rows:
        same = x == pd.Series(Counter(t), dtype=float).reindex(x.columns).fillna(0)
        share = same.groupby(y).mean()  # a row for each class, a column for each word
        logs = {c: round(float(np.log(p).sum() + np.log((y == c).mean())), 9)
                for c, p in zip(share.index, share.to_numpy()) if (p > 0).all()}
        out.append(int(max(logs, key=lambda c: (logs[c], -c)) if logs else min(share.index)))
    return out


def test_more_classes_than_any_fixed_limit(spark):
    train = [(c, [f"w{c}", "all"]) for c in range(1100)]
    test = [(7, ["w7", "all"]), (1099, ["w1099", "all"]), (0, ["new"]), (0, [])]
    got, _ = _fit_predict(spark, train, test)
    assert got[:2] == [7, 1099] and got == _brute(train, test)


def test_unseen_value_gives_smaller_label(spark):
    train = [(0, ["a"]), (1, ["b"]), (1, ["b", "b"])]
    test = [(1, ["a", "a", "a"])]   # count 3 of "a" seen in no class
    got, rows = _fit_predict(spark, train, test)
    assert got == [0] == _brute(train, test)
    assert rows[0].zero_factors > 0


def test_word_in_every_row_of_a_class_absent_in_test(spark):
    train = [(0, ["x", "y"]), (0, ["x"]), (1, ["y"]), (1, ["z"])]
    test = [(0, ["y"])]   # class 0 always has x: P(x=0 | 0) = 0
    got, rows = _fit_predict(spark, train, test)
    assert got == _brute(train, test)


def test_matches_brute_force_on_small_tables(spark):
    train, test = train_test(spark, SF_SMALL, "en")
    tr = [(r.label, r.tokens) for r in train.orderBy("doc_id").collect()]
    te = [(r.label, r.tokens) for r in test.orderBy("doc_id").collect()]
    got, _ = _fit_predict(spark, tr, te)
    assert got == _brute(tr, te)


def test_priors_sum_to_one(spark):
    train, _ = train_test(spark, SF_SMALL)
    p = NB.class_priors(train.select("label")).agg(F.sum("prior")).first()[0]
    assert abs(p - 1.0) < 1e-12
