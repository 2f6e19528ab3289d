import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from valence.operators import descent as D
from valence.operators import linear as L
from valence.operators.split import hash_bucket

GRID = (D.Setting(), D.Setting(rate=0.05, momentum=0.5), D.Setting(ridge=0.1))


def _data(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 3)) * [1.0, 20.0, 0.0] + [5.0, -3.0, 2.0]
    y = ((x - [5, -3, 2]) @ [2.0, -0.05, 0.0] + 0.3 + rng.standard_normal(n) > 0).astype(int)
    rows = [(i, Vectors.dense(v), int(c)) for i, (v, c) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, ["doc_id", "features", "label"])


def _order(df):
    h = hash_bucket("doc_id", "order100", 1 << 30)
    return [r.doc_id for r in df.orderBy(h, "doc_id").select("doc_id").collect()]


def _slow(x, y, vx, vy, s, epochs, batch, lane):
    """One process, one setting: lanes one after another, then their mean."""
    mean, dev = x.mean(0), x.std(0)
    scale = np.where(dev > 1e-6, 1 / np.maximum(dev, 1e-300), 0)
    x, vx = (np.hstack(((a - mean) * scale, np.ones((len(a), 1)))) for a in (x, vx))
    w, out = np.zeros(x.shape[1]), []

    def value(xb, yb, w):
        m = xb @ w
        return np.log1p(np.exp(-np.where(yb > 0, m, -m))).mean(), ((m > 0) == (yb > 0)).mean()

    for _ in range(epochs):
        ends, met = [], []
        for a in range(0, len(y), batch * lane):
            u, speed = w.copy(), np.zeros_like(w)
            for b in range(a, min(a + batch * lane, len(y)), batch):
                stop = min(b + batch, a + batch * lane)
                xb, yb = x[b:stop], y[b:stop]
                met.append(value(xb, yb, u))
                g = xb.T @ (1 / (1 + np.exp(-xb @ u)) - yb) / len(yb) + s.ridge * np.append(u[:-1], 0)
                speed = s.momentum * speed - s.rate * g
                u = u + speed
            ends.append(u * len(y[a:a + batch * lane]))
        w = sum(ends) / len(y)
        seen = [value(vx[b:b + batch], vy[b:b + batch], w) for b in range(0, len(vy), batch)]
        out.append((np.mean(met, 0), np.mean(seen, 0), np.append(w[:-1] * scale, w[-1] - (w[:-1] * scale) @ mean)))
    return out


@pytest.mark.parametrize("lane", [2, 100])
def test_grid_equals_separate_fits_in_one_process(spark, lane):
    x, y, train = _data(spark, 230, 1)
    vx, vy, valid = _data(spark, 90, 2)
    model, setting, hist = D.train_batches(train, valid, GRID, epochs=4, batch_size=32, lane_batches=lane)
    at, vat = _order(train), _order(valid)
    want = [_slow(x[at], y[at], vx[vat], vy[vat], s, 4, 32, lane) for s in GRID]
    rows = {(r.setting, r.split, r.epoch): (r.loss, r.accuracy) for r in hist.collect()}
    assert len(rows) == 3 * 2 * 4
    for (i, split, e), got in rows.items():
        assert np.allclose(got, want[i][e - 1][split == "valid"], atol=1e-8)
    best = min(((want[i][e][1][0], e, i) for i in range(3) for e in range(4)))
    assert (model.epoch, setting) == (best[1] + 1, best[2]) and abs(model.loss - best[0]) < 1e-8
    assert np.allclose(model.weights, want[setting][model.epoch - 1][2], atol=1e-8)


def test_partitioning_changes_nothing(spark):
    _, _, train = _data(spark, 230, 1)
    _, _, valid = _data(spark, 90, 2)
    fits = []
    for n in (1, 7):
        model, setting, hist = D.train_batches(train.repartition(n), valid.repartition(n), GRID, epochs=3,
                                               batch_size=16, lane_batches=2)
        fits.append((model, setting, sorted(map(tuple, hist.collect()))))
    assert fits[0] == fits[1]


def test_missing_parts(spark):
    x, y, df = _data(spark, 40, 3)
    model, _, hist = D.train_batches(df.limit(0), df, epochs=2)
    assert model.weights == (0.0,) * 4 and hist.count() == 0
    model, _, hist = D.train_batches(df.limit(0), df.limit(0), epochs=2)
    assert model.weights == (0.0,) and hist.count() == 0
    model, _, hist = D.train_batches(df, df.limit(0), GRID[:1], epochs=2, batch_size=16)
    assert {r.split for r in hist.collect()} == {"train"} and len(model.weights) == 4 and model.weights[2] == 0
    scored = L.score(model, df).collect()
    assert np.mean([r.prediction == r.label for r in scored]) > 0.6


def _states(tokens, vec, dim, decay):
    """By the recurrences themselves, token by token."""
    zero = np.zeros(dim)
    seq = [np.array(vec.get(t, zero), float) for t in tokens]
    out = [np.mean(seq, 0)]
    for way in (seq, seq[::-1]):
        s, w = zero, 0.0
        for v in way:
            s, w = decay * s + v, decay * w + 1
        out.append(s / w)
    return np.concatenate(out)


def test_ordered_vectors_follow_the_recurrences(spark):
    rng = np.random.default_rng(4)
    names = ["w%d" % i for i in range(12)]
    vocab = spark.createDataFrame([(t, i + 2) for i, t in enumerate(names)], "term string, term_id int")
    vec = {t: rng.standard_normal(3).astype("float32") for t in names}
    vectors = spark.createDataFrame([(i + 2, [float(x) for x in vec[t]]) for i, t in enumerate(names)],
                                    "term_id int, vec array<float>")
    texts = [(i, [str(t) for t in rng.choice([*names, "unknown"], rng.integers(1, 40))]) for i in range(20)]
    texts += [(30, ["w1", "w2", "w3"]), (31, ["w3", "w2", "w1"]), (32, ["w1"] * 20_000 + ["w2"]), (33, []), (34, ["x"])]
    docs = spark.createDataFrame(texts, "doc_id long, tokens array<string>")
    got = {r.doc_id: r.features.toArray() for r in L.ordered_vectors(docs, vocab, vectors).collect()}
    assert len(got) == len(texts) and not got[33].any() and not got[34].any()
    for i, tokens in texts:
        if tokens:
            assert np.allclose(got[i], _states(tokens, vec, 3, L.DECAY), atol=1e-6)
    assert np.allclose(got[30][:3], got[31][:3]) and not np.allclose(got[30], got[31])
    assert np.allclose(got[30][3:6], got[31][6:])
    none = L.ordered_vectors(docs.filter(F.col("doc_id") < 0), vocab, vectors)
    assert none.count() == 0


def test_vectors_in_several_blocks_give_the_same_means(spark, monkeypatch):
    """The words' vectors go to the tasks in blocks; words with two vectors
    count twice, ids may repeat, unknown words weigh."""
    from valence.operators import linear as L
    docs = spark.createDataFrame([(1, ["a", "b", "x", "a"]), (2, []), (3, ["c"]), (3, ["b"]), (None, ["a"])],
                                 "doc_id long, tokens array<string>")
    vocab = spark.createDataFrame([("a", 2), ("b", 3), ("c", 4), ("d", 5)], "term string, term_id int")
    vectors = spark.createDataFrame([(2, [1.0, 0.0]), (3, [0.0, 2.0]), (3, [0.0, 4.0]), (4, None)],
                                    "term_id int, vec array<float>")
    want = {1: (2 / 5, 6 / 5), 2: (0.0, 0.0), 3: (0.0, 2.0), None: (0.0, 0.0)}
    for limit in (L.BROADCAST_BYTES, 50):
        monkeypatch.setattr(L, "BROADCAST_BYTES", limit)
        got = L.pooled_vectors(docs, vocab, vectors)
        assert sorted((r.doc_id or 0, *(round(x, 9) for x in r.features.toArray().tolist())) for r in got.collect()) == sorted(
            (k or 0, *(round(x, 9) for x in want[k])) for k in (1, 2, 3, 3, None))
        plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
        assert "term#" not in plan  # no word is exploded or shuffled
