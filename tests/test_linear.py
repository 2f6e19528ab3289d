import numpy as np
from pyspark.ml.linalg import Vectors

from valence.operators import linear as L
from valence.operators.metrics import best_so_far
from valence.session import scratch_path


def _data(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 3))
    y = (x @ [2.0, -1.0, 0.5] + 0.3 + rng.standard_normal(n) > 0).astype(int)
    rows = [(i, Vectors.dense(v), int(c)) for i, (v, c) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, ["doc_id", "features", "label"])


def _newton(x, y, steps):
    x = np.hstack((x, np.ones((len(x), 1))))
    w = np.zeros(4)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        r = L.RIDGE * len(x) * np.array([1, 1, 1, 0.0])
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(r + 1e-9), x.T @ (p - y) + r * w)
    return w


def test_epochs_are_newton_steps_and_the_best_is_kept(spark):
    x, y, train = _data(spark, 300, 1)
    vx, vy, valid = _data(spark, 120, 2)
    model, hist = L.train_epochs(train, valid, epochs=5, batch_size=100)
    rows = {(r.split, r.epoch): r for r in hist.collect()}
    assert set(rows) == {(s, e) for s in ("train", "valid") for e in range(1, 6)}
    best = min(range(1, 6), key=lambda e: rows["valid", e].loss)
    assert model.epoch == best and abs(model.loss - rows["valid", best].loss) < 1e-12
    assert np.allclose(model.weights, _newton(x, y, best), atol=1e-8)
    flags = [r.epoch for r in best_so_far(hist).collect() if r.improved]
    assert max(flags) == best
    path = scratch_path(spark, "linear-test")
    model.save(spark, path)
    assert L.LinearModel.load(spark, path) == model
    m = np.hstack((vx, np.ones((120, 1)))) @ np.array(model.weights)
    got = {r.doc_id: (r.prediction, r.probability) for r in L.score(model, valid).collect()}
    assert all(got[i][0] == float(m[i] > 0) and abs(got[i][1] - 1 / (1 + np.exp(-abs(m[i])))) < 1e-9 for i in range(120))


def test_no_rows_to_train_on(spark):
    _, _, df = _data(spark, 5, 3)
    model, hist = L.train_epochs(df.limit(0), df.limit(0), epochs=2)
    assert hist.count() == 0 and model.weights == (0.0,)
