"""Mixing sources to target weights by soft membership.

A multinomial classifier learned from the labelled table predicts each
document's posterior over domains (clean, low quality, toxic, both). The
expected tokens of a domain are the sum of rate x tokens x posterior. Document
rates start at one and are fitted by projected-gradient least squares, with
momentum, so that these totals match the target weights of the corpus's
tokens; rates stay nonnegative, and a small ridge keeps them near one. Each
step is one distributed sum of as many numbers as there are domains. A rate is
a function of the posterior and the sequence of those sums, so no state is
kept for a document: each pass replays the steps.

Defined cases: null and empty texts have no tokens, zero statistics and the
rate of their posterior; without labels every domain is as likely as the
others; domains never labelled have posterior zero and their target is shared
among the others in proportion; an id without rate does not occur; repeated
rows get equal rates; ids with several labels take the larger; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valence.llm.common import column, fit_labels, materialise, read_table, record
from valence.llm.textstats import STATS, text_stats
from valence.llm.toxicity import lexicon, tokens

DOMAINS = ("clean", "low_quality", "toxic", "both")  # by quality = 0 and toxic = 1
TARGET = {"clean": 0.90, "low_quality": 0.06, "toxic": 0.03, "both": 0.01}
RIDGE = 1e-3
ROUNDS = 60
CLOSE = 1e-5  # largest change of a domain's share at which the steps end


@dataclass(frozen=True)
class Step:
    """One projected-gradient step: the weighted residual of each domain, the
    step size and the momentum that follows."""

    residual: tuple[float, ...]
    size: float
    momentum: float


def rates(posterior: np.ndarray, steps: list[Step], ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray]:
    """Rates and extrapolated rates after the steps, for rows of posteriors."""
    rate = ahead = np.ones(len(posterior))
    for s in steps:
        new = np.maximum(0.0, ahead - s.size * (posterior @ np.array(s.residual) + ridge * (ahead - 1)))
        ahead = new + s.momentum * (new - rate)
        rate = new
    return rate, ahead


def domain_posteriors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, words, posterior)`` for each row of ``docs``, materialised."""
    known = fit_labels(labels, ["quality", "toxic"])
    pairs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(known, "doc_id").select(
        "text", F.col("toxic").alias("label"))
    toxic = frozenset(t for t, w in lexicon(pairs).items() if w > 0)
    shared = docs.sparkSession.sparkContext.broadcast(toxic)  # a bounded lexicon
    measured = materialise(
        text_stats(docs, {"toxic_tokens": lambda t: np.log1p(len(shared.value.intersection(tokens(t))))}), "mixing")
    inputs = array_to_vector(F.array(*STATS, "toxic_tokens")).alias("features")
    train = materialise(measured.join(known, "doc_id").repartition(8, "doc_id").sortWithinPartitions("doc_id").select(
        ((1 - F.col("quality")) + 2 * F.col("toxic")).cast("double").alias("label"), inputs), "mixing")
    present = sorted(int(r.label) for r in train.select("label").distinct().collect())  # at most four
    even = F.array(*(F.lit(1 / len(present) if i in present else 0.0) if present else F.lit(0.25)
                     for i in range(len(DOMAINS))))
    if len(present) < 2:
        return materialise(measured.select("doc_id", "words", even.alias("posterior")), "mixing")
    model = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=60).fit(train)
    out = model.transform(measured.select("doc_id", "words", inputs)).select(
        "doc_id", "words", vector_to_array("probability").alias("posterior"))
    # classes above the largest label seen are missing from the vector
    full = F.transform(F.sequence(F.lit(0), F.lit(len(DOMAINS) - 1)),
                       lambda i: F.coalesce(F.get(F.col("posterior"), i), F.lit(0.0)))
    return materialise(out.select("doc_id", "words", full.alias("posterior")), "mixing")


def _matrix(col: pa.Array) -> np.ndarray:
    return col.values.to_numpy(zero_copy_only=False).reshape(len(col), -1) if len(col) else np.zeros((0, len(DOMAINS)))


def _totals(members: DataFrame, steps: list[Step], ridge: float) -> np.ndarray:
    """Expected tokens of each domain at the extrapolated rates, and at the rates."""
    k = len(DOMAINS)
    schema = pa.schema([("i", pa.int32()), ("x", pa.float64())])

    def run(batches):
        total = np.zeros(2 * k)
        for b in batches:
            p, t = _matrix(column(b, "posterior")), column(b, "words").to_numpy(zero_copy_only=False).astype(float)
            rate, ahead = rates(p, steps, ridge)
            total += np.concatenate(((ahead * t) @ p, (rate * t) @ p))
        yield record(schema, [np.arange(2 * k, dtype=np.int32), total])

    got = members.select("posterior", "words").mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x"))
    out = np.zeros(2 * k)
    for r in got.collect():  # 2k numbers
        out[r.i] = r.x
    return out


def fit_rates(members: DataFrame, target: dict | None = None, ridge: float = RIDGE, rounds: int = ROUNDS) -> list[Step]:
    """Steps of the projected gradient over ``(words, posterior)``."""
    k = len(DOMAINS)
    mass = _totals(members, [], ridge)[:k]
    total = mass.sum()
    if total <= 0:
        return []
    share = np.array([(target or TARGET).get(d, 0.0) for d in DOMAINS]) * (mass > 0)
    share = share / share.sum() if share.sum() else mass / total
    # residuals are weighted by 1 / target, so a rare domain counts as much as a
    # common one; the largest eigenvalue of the weighted Gram matrix sets the step
    weight = np.where(mass > 0, 1 / np.maximum(share, 1e-3), 0.0)
    grams = members.agg(*(F.sum(F.col("words") * F.get("posterior", F.lit(i)) * F.get("posterior", F.lit(j)))
                          for i in range(k) for j in range(k))).first()
    gram = np.array([float(x or 0) for x in grams]).reshape(k, k) / total
    size = 1 / (np.linalg.eigvalsh(np.sqrt(np.outer(weight, weight)) * gram).max() + ridge)
    steps: list[Step] = []
    t, now = 1.0, mass / total
    for _ in range(rounds):
        following = (1 + (1 + 4 * t * t) ** 0.5) / 2
        steps.append(Step(tuple((now - share) * weight), size, (t - 1) / following))
        t = following
        got = _totals(members, steps, ridge) / total
        if np.abs(got[:k] - now).max() < CLOSE and np.abs(got[k:] - got[:k]).max() < CLOSE:
            break
        now = got[:k]
    return steps


def mix(docs: DataFrame, labels: DataFrame, target: dict | None = None) -> DataFrame:
    """``(doc_id, words, posterior, domain, rate, copies)`` for each row;
    ``copies`` is the rate rounded up or down by a hash of the id, so that the
    expected number of copies is the rate."""
    members = domain_posteriors(docs, labels)
    steps = fit_rates(members, target)
    schema = pa.schema([("doc_id", pa.int64()), ("words", pa.int64()), ("posterior", pa.list_(pa.float64())),
                        ("domain", pa.string()), ("rate", pa.float64())])

    def run(batches):
        for b in batches:
            p = _matrix(column(b, "posterior"))
            yield record(schema, [column(b, "doc_id"), column(b, "words"), column(b, "posterior"),
                                  [DOMAINS[i] for i in p.argmax(1)], rates(p, steps)[0]])

    drawn = (F.pmod(F.xxhash64(F.lit("copies"), "doc_id"), F.lit(1 << 20)) / float(1 << 20))
    return members.mapInArrow(run, "doc_id long, words long, posterior array<double>, domain string, rate double").withColumn(
        "copies", (F.floor("rate") + (drawn < F.col("rate") - F.floor("rate")).cast("long")).cast("long"))


def query(spark, sf_dir: str) -> DataFrame:
    got = mix(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return got.select("doc_id", F.col("words").alias("tokens"), "domain", "rate", "copies",
                      *(F.get("posterior", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(DOMAINS)))


QUERIES = {"op8_mixing": query}
ORACLE = {}
