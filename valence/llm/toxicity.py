"""Toxicity by maximum-scoring segments.

Token weights are log-odds of toxic against other labelled documents under a
Dirichlet prior; only weights of several standard errors enter the lexicon,
and all other tokens cost a small drift. One linear scan finds every maximal
segment of a text. Extreme-value statistics turn segment scores into expected
chance counts, the significant segments are added up, and a logistic curve
over that sum gives the probability.

Defined cases: null and empty texts score as texts without a segment; without
labels of both kinds every score is the share of label 1 (0.5 if there is no
label); repeated rows get equal results; ids with several labels take the
larger; very long texts are scanned in one linear pass; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valence.llm.common import column, fit_labels, fold, largest, materialise, read_table, record, utf8

TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+")
PRIOR = 1.0  # pseudo-documents of each token in either class, before the shared frequency
LEAST_Z = 3.5  # standard errors from even odds that a lexicon token needs
MOST_WEIGHT = 10.0
DRIFT = -0.1  # of a token outside the lexicon
LEXICON = 50_000  # model size: tokens of the largest |z|
HELD_TOKENS = 200_000  # distinct tokens a task holds before it sends them on


def tokens(text: bytes) -> list[bytes]:
    return TOKEN.findall(text.lower())


def lexicon(train: DataFrame) -> dict[bytes, float]:
    """Token weights from ``train(text, label)``; a token counts once for each
    document that holds it."""
    schema = pa.schema([("token", pa.binary()), ("label", pa.int32()), ("n", pa.int64())])

    def count(batches):
        held = (Counter(), Counter())

        def flush():
            for label, c in enumerate(held):
                yield record(schema, [list(c), [label] * len(c), list(c.values())])
                c.clear()

        for b in batches:
            for text, label in zip(utf8(b, "text"), column(b, "label").to_pylist()):
                held[label].update(set(tokens(text)))
                if sum(map(len, held)) > HELD_TOKENS:
                    yield from flush()
        yield from flush()

    counted = (train.select("text", "label").mapInArrow(count, "token binary, label int, n long")
               .groupBy("token").agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("n1"),
                                     F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("n0")))
    counted = materialise(counted, "toxicity")
    t1, t0, types = counted.agg(F.sum("n1"), F.sum("n0"), F.count("*")).first()
    if not t1 or not t0:
        return {}
    # Dirichlet prior: PRIOR for each token and class, in proportion to the class size
    a1, a0 = (PRIOR * 2 * t / (t1 + t0) for t in (t1, t0))
    k1, k0 = F.col("n1") + a1, F.col("n0") + a0
    odds = (F.log(k1 / (t1 + a1 * types - k1)) - F.log(k0 / (t0 + a0 * types - k0)))
    weighed = (counted.select("token", odds.alias("w"), F.sqrt(1 / k1 + 1 / k0).alias("se"))
               .withColumn("z", F.abs(F.col("w") / F.col("se"))).where(F.col("z") >= LEAST_Z))
    return {bytes(r.token): max(-MOST_WEIGHT, min(MOST_WEIGHT, r.w))
            for r in largest(weighed, "z", LEXICON).select("token", "w").collect()}


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)`` in linear time."""
    found: list[list] = []  # left sum, right sum, start, end, index of the nearest earlier with a lower left sum
    total = 0.0
    for i, s in enumerate(scores):
        left, total = total, total + s
        if s <= 0:
            continue
        new = [left, total, i, i + 1, -1]
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][0] >= new[0]:
                j = found[j][4]
            if j < 0 or found[j][1] >= new[1]:
                new[4] = j
                found.append(new)
                break
            new[0], new[2] = found[j][0], found[j][2]
            prior = found[j][4]
            del found[j:]
            j = prior
    return [(a, b, right - left) for left, right, a, b, _ in found]


def segments(text: bytes, weights: dict[bytes, float]) -> tuple[int, list[tuple[int, int, float]]]:
    """Number of tokens, and the maximal segments in token positions; runs of
    tokens outside the lexicon enter the scan as one step."""
    words = tokens(text)
    return len(words), _segments([(i, weights[w]) for i, w in enumerate(words) if w in weights])


def _segments(hits: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
    scores, at, last = [], [], -1
    for i, w in hits:
        if i > last + 1:
            scores.append(DRIFT * (i - last - 1))
            at.append(last + 1)
        scores.append(w)
        at.append(i)
        last = i
    return [(at[a], at[b - 1] + 1, s) for a, b, s in maximal_segments(scores)]


@dataclass(frozen=True)
class Model:
    weights: dict
    rate: float  # lambda of the extreme-value law
    chance: float  # its K
    slope: float
    offset: float

    def significance(self, n: int, scores: list[float]) -> float:
        """Sum over segments of how far each is below one expected by chance."""
        return min(50.0, sum(max(0.0, self.rate * s - math.log(max(self.chance * max(n, 1), 1e-300))) for s in scores))

    def probability(self, x: float) -> float:
        z = self.offset + self.slope * x
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def _rate(scores: np.ndarray, freq: np.ndarray) -> float:
    """The positive root of sum(freq * exp(rate * score)) = 1, 0.05 at least and
    8 at most (also where no token has a positive score)."""
    low, high = 0.0, 1.0
    while (freq * np.exp(high * scores)).sum() < 1 and high < 8:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (freq * np.exp(mid * scores)).sum() < 1 else (low, mid)
    return max(high, 0.05)


def _logistic(x: np.ndarray, ones: np.ndarray, total: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps over binned counts, lightly damped."""
    X = np.stack((x, np.ones_like(x)), 1)
    beta = np.array([0.0, math.log((ones.sum() + 0.5) / (total.sum() - ones.sum() + 0.5))])
    damp = np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(X @ beta, -30, 30)))
        step = np.linalg.solve((X * (total * p * (1 - p))[:, None]).T @ X + damp, X.T @ (ones - total * p) - damp @ beta)
        beta = beta + np.clip(step, -2, 2)
    return max(0.0, float(beta[0])), float(beta[1])


def fit(train: DataFrame) -> Model:
    """Fit on rows ``(text, label)``."""
    weights = lexicon(train)
    shared = train.sparkSession.sparkContext.broadcast(weights)  # at most LEXICON tokens
    schema = pa.schema([("label", pa.int32()), ("n", pa.int64()), ("scores", pa.list_(pa.float64())),
                        ("weights", pa.list_(pa.float64())), ("counts", pa.list_(pa.int64()))])

    def scan(batches):
        """A row for each document, and one for each task: how often documents
        that are not toxic hold each weight."""
        held: Counter = Counter()
        for b in batches:
            found = []
            labels = column(b, "label")
            for ws, label in zip(map(tokens, utf8(b, "text")), labels.to_pylist()):
                hits = [(i, shared.value[w]) for i, w in enumerate(ws) if w in shared.value]
                found.append((len(ws), [s for *_, s in _segments(hits)]))
                if label == 0:
                    held.update(w for _, w in hits)
            none = [None] * len(found)
            yield record(schema, [labels, [n for n, _ in found], [x for _, x in found], none, none])
        yield record(schema, [[None], [None], [None], [list(held)], [list(held.values())]])

    rows = materialise(train.select("text", "label").mapInArrow(
        scan, "label int, n long, scores array<double>, weights array<double>, counts array<long>"), "toxicity")
    seen = rows.where("scores is not null").select("label", "n", "scores")
    # chance law from the documents that are not toxic: the share of each weight among their tokens
    clean = seen.where("label = 0")
    n_tokens, n_docs = clean.agg(F.sum("n"), F.count("*")).first()
    n_tokens, n_docs = n_tokens or 0, n_docs or 0
    held = (rows.where("scores is null").select(F.explode(F.arrays_zip("weights", "counts")).alias("x"))
            .groupBy(F.col("x.weights").alias("w")).agg(F.sum("x.counts").alias("n")).orderBy("w").collect())  # a row for each lexicon weight at most
    w, n = np.array([r.w for r in held]), np.array([float(r.n) for r in held])
    rate = _rate(np.append(w, DRIFT), np.append(n, n_tokens - n.sum()) / n_tokens) if weights and n_tokens else 1.0
    best = F.coalesce(F.array_max("scores"), F.lit(0.0))
    mass = clean.agg(F.sum(F.col("n") * F.exp(-F.lit(rate) * best))).first()[0] or 0
    model = Model(weights, rate, n_docs / mass if mass else 1.0, 0.0, 0.0)
    limit = F.log(F.greatest(F.lit(model.chance) * F.greatest(F.col("n"), F.lit(1)), F.lit(1e-300)))
    x = F.least(F.lit(50.0), F.aggregate("scores", F.lit(0.0), lambda a, s: a + F.greatest(F.lit(0.0), s * rate - limit)))
    bins = (seen.select(F.round(x * 4).cast("int").alias("x"), "label").groupBy("x")
            .agg(F.sum("label").alias("ones"), F.count("*").alias("n")).orderBy("x").collect())  # 201 at most
    if not bins:
        return model
    slope, offset = _logistic(*(np.array([float(r[c]) for r in bins]) / d for c, d in (("x", 4), ("ones", 1), ("n", 1))))
    return Model(weights, rate, model.chance, slope, offset)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, n_segments, seg_start, seg_end, seg_score)``: the
    probability, the number of significant segments and the best one in token
    positions (null without one)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("n_segments", pa.int32()),
                        ("seg_start", pa.int64()), ("seg_end", pa.int64()), ("seg_score", pa.float64())])

    def run(batches):
        m = shared.value
        for b in batches:
            rows = []
            for t in utf8(b, "text"):
                n, found = segments(t, m.weights)
                sure = [x for x in found if m.significance(n, [x[2]]) > 0]
                top = max(sure, key=lambda x: (x[2], -x[0]), default=(None, None, None))
                rows.append((m.probability(m.significance(n, [x[2] for x in found])), len(sure), *top))
            yield record(schema, [column(b, "doc_id"), *(zip(*rows) if rows else [[]] * 5)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double, n_segments int, seg_start long, seg_end long, seg_score double")


def training_rows(docs: DataFrame, labels: DataFrame, keep) -> DataFrame:
    """``(text, label)`` of the labelled rows that ``keep(doc_id)`` admits."""
    known = fit_labels(labels.where(keep), ["toxic"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(known, "doc_id").select(
        "text", F.col("toxic").alias("label"))


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = fit(training_rows(docs, labels, fold("doc_id", 5) != 0))
    return score(docs, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_segments", "seg_start", "seg_end")


QUERIES = {"op2_toxicity": query}
ORACLE = {}
