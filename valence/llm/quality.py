"""Quality classifier: a sparse rule ensemble.

Trees grown on text statistics give the rules: each path from a root to a node
is one conjunction of thresholds. A lasso logistic regression weighs the rules
and drops most of them, and the rest are compiled into one Spark column
expression over the statistics.

Defined cases: null and empty texts have zero statistics and score like any
other; without labels of both kinds every score is the share of label 1 (0.5
without labels); ids with several labels take the larger; repeated rows get
equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valence.llm.common import fit_labels, fold, materialise, read_table
from valence.llm.textstats import STATS, text_stats

TREES, DEPTH, LASSO, STEPS, SEED = 8, 3, 2e-4, 40, 7

Rule = tuple[tuple[str, bool, float], ...]  # (statistic, at most?, threshold), all of which must hold


@dataclass(frozen=True)
class Model:
    rules: tuple[tuple[Rule, float], ...]
    offset: float


def paths(tree_text: str) -> list[Rule]:
    """Every path of a tree's printed form, as a rule in normal form."""
    out, above = set(), []
    for line in tree_text.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        above = [a for a in above if a[0] < depth] + [(depth, STATS[int(m[2])], m[3] == "<=", float(m[4]))]
        bounds: dict = {}
        for _, name, most, at in above:
            old = bounds.get((name, most), at)
            bounds[name, most] = min(old, at) if most else max(old, at)
        out.add(tuple(sorted((name, most, at) for (name, most), at in bounds.items())))
    return sorted(out)


def condition(rule: Rule) -> Column:
    """The rule as a column expression."""
    out = F.lit(True)
    for name, most, at in rule:
        out = out & ((F.col(name) <= at) if most else (F.col(name) > at))
    return out


def fit(train: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> Model:
    """Fit on rows ``(*STATS, label)``."""
    n, ones = train.agg(F.count("*"), F.sum("label")).first()
    if not n or ones in (0, n):
        p = (ones + 0.5) / (n + 1) if n else 0.5
        return Model((), math.log(p / (1 - p)))
    rows = train.select(array_to_vector(F.array(*STATS)).alias("features"), F.col("label").cast("double").alias("label"), *STATS)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, subsamplingRate=0.7).fit(rows)
    rules = sorted({r for t in forest.trees for r in paths(t.toDebugString)})
    if not rules:
        p = ones / n
        return Model((), math.log(p / (1 - p)))
    held = rows.select("label", array_to_vector(F.array(*(condition(r).cast("double") for r in rules))).alias("features"))
    lr = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=STEPS).fit(held)
    kept = tuple((r, float(w)) for r, w in zip(rules, lr.coefficients.toArray()) if abs(w) > 1e-9)
    return Model(kept, float(lr.intercept))


def probability(model: Model) -> Column:
    """The model as one column expression over the statistics."""
    z = F.lit(model.offset)
    for rule, weight in model.rules:
        z = z + F.when(condition(rule), F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def score(measured: DataFrame, model: Model) -> DataFrame:
    return measured.select("doc_id", probability(model).alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    measured = materialise(text_stats(docs), "quality")
    known = fit_labels(labels.where(fold("doc_id", 3) != 1), ["quality"]).withColumnRenamed("quality", "label")
    # a bounded sample, written once: the trees read it in every round
    train = materialise(measured.join(known, "doc_id").repartition(8, "doc_id").sortWithinPartitions("doc_id"), "quality")
    return score(measured, fit(train)).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op6_quality_classifier": query}
ORACLE = {}
