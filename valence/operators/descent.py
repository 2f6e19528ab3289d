"""Mini-batch training of the linear classifier, several settings at once.

Rows stand in the seeded order of ``linear.batch_ids`` and are cut into batches;
``LANE_BATCHES`` successive batches make a lane, and the rows are dealt out by
lanes once. In an epoch every lane starts from the same coefficients and
descends with momentum through its batches in order; the lanes' coefficients,
weighted by their rows, are averaged once at the end of the epoch. Lanes are
bounded in rows and their number grows with the data, so an epoch is one narrow
pass and a sum of a few numbers for each lane.

All settings of a grid descend side by side in the same pass, so a grid costs
the scans of one fit. Features are scaled to mean 0 and deviation 1 on the
training rows; the model returned has the coefficients of the plain features.

Sums over lanes are taken in decimals, so nothing depends on how the rows were
partitioned. Without training rows the coefficients are 0; without validation
rows the training loss decides; ties go to the earlier epoch, then to the
earlier setting; constant features get no weight.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valence.operators.linear import BATCH_SIZE, EPOCHS, LinearModel, batch_ids
from valence.session import freeze

LANE_BATCHES = 16  # 8,192 rows in a lane with the usual batches


@dataclass(frozen=True)
class Setting:
    """Step size, share of the last step that goes on, and ridge of a fit."""

    rate: float = 0.3
    momentum: float = 0.9
    ridge: float = 1e-3


GRID = (Setting(), Setting(rate=0.1), Setting(rate=0.03), Setting(ridge=1e-2))


def lanes(df: DataFrame, split: str, batch_size: int, lane_batches: int) -> DataFrame:
    """``(split, lane, batch, doc_id, label, features)`` of one part."""
    ranked = batch_ids(df.select("doc_id", vector_to_array("features").alias("features"),
                                 F.col("label").cast("double").alias("label")), batch_size=batch_size)
    return ranked.select(F.lit(split).alias("split"), F.floor(F.col("batch") / lane_batches).alias("lane"),
                         "batch", "doc_id", "label", "features")


def _lanes_of(batches):
    """``(split, x, y)`` of each lane of a partition that is sorted by lanes;
    one lane is held at a time."""
    key, held = None, []

    def whole():
        y = np.concatenate([p[1] for p in held])
        return key[0], np.concatenate([p[0] for p in held]).reshape(len(y), -1), y

    for b in batches:
        if not b.num_rows:
            continue
        split, lane = b.column(0).to_pylist(), b.column(1).to_pylist()
        cuts = [0, *(i for i in range(1, len(lane)) if (split[i], lane[i]) != (split[i - 1], lane[i - 1])), len(lane)]
        for i, j in zip(cuts, cuts[1:]):
            part = b.slice(i, j - i)
            if held and key != (split[i], lane[i]):
                yield whole()
                held = []
            key = split[i], lane[i]
            held.append((part.column(3).flatten().to_numpy(), part.column(2).to_numpy()))
    if held:
        yield whole()


def _sums(table: DataFrame, of) -> dict[str, np.ndarray]:
    """The sums over lanes of the numbers ``of(x, y, split)`` gives, by split."""
    schema = pa.schema([("split", pa.string()), ("sums", pa.list_(pa.float64()))])

    def run(batches):
        for split, x, y in _lanes_of(batches):
            yield pa.RecordBatch.from_arrays([pa.array([split]), pa.array([of(x, y, split)], schema[1].type)],
                                             schema=schema)

    got = (table.select("split", "lane", "label", "features").mapInArrow(run, "split string, sums array<double>")
           .select("split", F.posexplode("sums").alias("at", "v"))
           .groupBy("split", "at").agg(F.sum(F.col("v").cast("decimal(38,12)")).cast("double").alias("v"))
           .orderBy("split", "at").collect())  # a few rows for each coefficient
    return {s: np.array([r.v for r in got if r.split == s]) for s in {r.split for r in got}}


def _losses(m: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean loss and accuracy of each setting's margins."""
    up = (y > 0)[:, None]
    return np.logaddexp(0, np.where(up, -m, m)).mean(0), ((m > 0) == up).mean(0)


def descend(x: np.ndarray, y: np.ndarray, start: np.ndarray, settings, batch_size: int, learn: bool = True):
    """One lane: the coefficients of each setting after its batches, and the
    sums over batches of loss and accuracy, each met before its own step."""
    w, speed = start.copy(), np.zeros_like(start)
    rate, momentum, ridge = (np.array([[getattr(s, k)] for s in settings]) for k in ("rate", "momentum", "ridge"))
    free = np.append(np.ones(w.shape[1] - 1), 0.0)  # no ridge on the intercept
    totals = np.zeros((2, len(w)))
    for a in range(0, len(y), batch_size):
        xb, yb = x[a:a + batch_size], y[a:a + batch_size]
        m = xb @ w.T
        totals += _losses(m, yb)
        if learn:
            p = 1 / (1 + np.exp(-np.clip(m, -500, 500)))
            step = (p - (yb > 0)[:, None]).T @ xb / len(yb) + ridge * free * w
            speed = momentum * speed - rate * step
            w = w + speed
    return w, totals


def train_batches(train: DataFrame, valid: DataFrame, settings=GRID, epochs: int = EPOCHS, run: str = "sgd",
                  batch_size: int = BATCH_SIZE, lane_batches: int = LANE_BATCHES) -> tuple[LinearModel, int, DataFrame]:
    """The model of the lowest validation loss over all settings and epochs,
    the number of its setting, and the history ``(run, setting, split, epoch,
    loss, accuracy)``: training values are met on the way, validation values
    at the epoch's end, both unweighted means over batches.

    ``train`` and ``valid`` are ``(doc_id, features, label)``, labels 0 and 1."""
    settings = tuple(settings)
    parts = (lanes(df, name, batch_size, lane_batches) for name, df in (("train", train), ("valid", valid)))
    # a lane lies in one partition, its batches in order; passes read the frozen partitions as they are
    table = freeze(next(parts).unionByName(next(parts)).repartition("split", "lane")
                   .sortWithinPartitions("split", "lane", "batch", "doc_id", "label", "features"))
    spread = _sums(table, lambda x, y, _: [*x.sum(0), *(x * x).sum(0), len(y)]).get("train")
    names = "run string, setting int, split string, epoch int, loss double, accuracy double"
    if spread is None:
        first = table.select(F.size("features")).first()
        return LinearModel((0.0,) * ((first[0] if first else 0) + 1)), 0, table.sparkSession.createDataFrame([], names)
    d, n = len(spread) // 2, spread[-1]
    mean = spread[:d] / n
    dev = np.sqrt(np.maximum(spread[d:-1] / n - mean * mean, 0))
    scale = np.divide(1, dev, out=np.zeros(d), where=dev > 1e-6)
    k = len(settings)

    def step(start, learn):
        def of(x, y, split):
            own = np.hstack(((x - mean) * scale, np.ones((len(y), 1))))
            w, totals = descend(own, y, start, settings, batch_size, learn and split == "train")
            return [*(w * len(y)).ravel(), *totals.ravel(), -(-len(y) // batch_size), len(y)]
        return of

    w, best, history = np.zeros((k, d + 1)), None, []
    for e in range(epochs + 1):
        # pass e trains epoch e + 1 and judges the coefficients of epoch e
        got = _sums(table, step(w, e < epochs))
        means = {s: v[-2 - 2 * k:-2].reshape(2, k) / v[-2] for s, v in got.items()}
        if e:
            seen = {"train": met} | ({"valid": means["valid"]} if "valid" in means else {})
            history += [(run, i, s, e, *map(float, v[:, i])) for s, v in seen.items() for i in range(k)]
            loss = seen.get("valid", seen["train"])[0]
            i = int(np.argmin(loss))
            if best is None or loss[i] < best[0].loss:
                plain = w[i, :d] * scale
                best = LinearModel((*plain.tolist(), float(w[i, d] - plain @ mean)), e, float(loss[i])), i
        met = means["train"]
        w = got["train"][:k * (d + 1)].reshape(k, d + 1) / got["train"][-1]
    best = best or (LinearModel((0.0,) * (d + 1)), 0)
    return *best, table.sparkSession.createDataFrame(history, names)
