import random
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
from helpers import docs  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from valence.llm import mixing as M  # noqa: E402
from valence.llm import quality as Q  # noqa: E402
from valence.llm.textstats import STATS, stats, text_stats  # noqa: E402

LABELS = "doc_id long, quality int, toxic int"


def corpus(rng, n=160):
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice("some plain words that make up a text".split()) for _ in range(rng.randint(20, 80))]
        low = i % 4 == 0
        rows.append((i, (" | " if low else " ").join(words)))
        labels.append((i, int(not low), int(i % 10 == 0)))
    rows += [(500, None), (501, ""), (502, "a | " * 50_000), rows[0], rows[0], (None, rows[1][1])]
    return rows, [*labels, (3, None, None), (None, 1, 0), (1, 1, 0)]


def test_stats_of_odd_texts():
    assert stats(b"") == stats(b" \n\t") == (0.0,) * len(STATS)
    assert all(np.isfinite(stats(t)).all() for t in (b"x", b"|" * 9, "ü é".encode(), b"\n\n.\n"))
    assert dict(zip(STATS, stats(b"a | b |")))["bare_symbols"] == 0.5


def test_rules_of_a_tree():
    text = "If (feature 0 <= 1.5)\n If (feature 0 <= 0.5)\n  Predict: 0.0\n Else (feature 0 > 0.5)\n  Predict: 1.0\nElse (feature 0 > 1.5)\n Predict: 0.0"
    name = STATS[0]
    assert Q.paths(text) == sorted([((name, True, 1.5),), ((name, True, 0.5),), ((name, False, 0.5), (name, True, 1.5)), ((name, False, 1.5),)])


def test_quality_on_held_out_rows(spark):
    rows, labels = corpus(random.Random(1))
    measured = text_stats(docs(spark, rows).selectExpr("*", "1 as words", "2 as symbols")).cache()
    lab = spark.createDataFrame(labels, LABELS).dropna().dropDuplicates(["doc_id"])
    train = measured.join(lab.where("doc_id % 3 <> 1"), "doc_id").withColumnRenamed("quality", "label")
    model = Q.fit(train, trees=3, depth=2)
    assert model.rules and len(model.rules) < 3 * 6
    got = {r.doc_id: r.score for r in Q.score(measured, model).collect()}
    assert all((got[i] >= 0.5) == bool(q) for i, q, _ in labels if i is not None and q is not None and i % 3 == 1)
    assert 0 <= got[500] == got[501] <= 1
    one = Q.fit(train.where("label = 1"))
    assert not one.rules and Q.fit(train.limit(0)).offset == 0
    assert Q.score(measured.limit(0), model).count() == 0


def test_rates_are_as_good_as_a_dense_solver(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet((4, 1, 1, 0.5), 300)
    t = rng.integers(0, 500, 300)
    df = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(t, p)], "words long, posterior array<double>")
    target = {"clean": 0.7, "low_quality": 0.15, "toxic": 0.1, "both": 0.05}
    steps = M.fit_rates(df, target)
    rate, _ = M.rates(p, steps)
    assert (rate >= 0).all()
    got = (rate * t) @ p / t.sum()
    assert np.abs(got - np.array(list(target.values()))).max() < 0.01
    # a dense projected gradient without momentum reaches the same rates
    r, w = np.ones(300), 1 / np.array(list(target.values()))
    gram = (p * t[:, None]).T @ p / t.sum()
    size = 1 / (np.linalg.eigvalsh(np.sqrt(np.outer(w, w)) * gram).max() + M.RIDGE)
    for _ in range(20000):
        e = ((r * t) @ p / t.sum() - np.array(list(target.values()))) * w
        r = np.maximum(0, r - size * (p @ e + M.RIDGE * (r - 1)))
    cost = lambda r: ((((r * t) @ p / t.sum() - np.array(list(target.values()))) ** 2 * w).sum()
                      + M.RIDGE * (t / t.sum() * (r - 1) ** 2).sum()) / 2
    assert cost(rate) <= cost(r) * 1.02 + 1e-6


def test_mix_of_odd_rows(spark):
    rows, labels = corpus(random.Random(6))
    df = docs(spark, rows).selectExpr("*", "0 as rate", "1 as posterior")
    got = M.mix(df, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows) and all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in got)
    assert all(abs(sum(r.posterior) - 1) < 1e-6 for r in got)
    assert len({(r.rate, r.copies) for r in got if r.doc_id == 0}) == 1
    empty = spark.createDataFrame([], LABELS)
    assert {r.rate for r in M.mix(df, empty).collect()} and M.mix(docs(spark, []), empty).count() == 0
    assert M.mix(df.where(F.col("doc_id") == 501), empty).first().rate == 1.0
