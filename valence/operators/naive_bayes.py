"""Unsmoothed categorical naive Bayes on term counts (A1-A3, A5, A6,
A10-A12, J3, M3, M4, F25).

The reference treats every vocabulary word as a categorical feature whose
value is the word's count in the document, with likelihood
``P(x_i = v | y) = #(class-y rows with x_i = v) / #(class-y rows)`` and no
smoothing; the posterior is ``prior(y) * prod_i P(x_i | y)`` over the whole
vocabulary and the prediction is the arg-max.

Nothing is densified. With ``n_y`` class rows and ``s(y,i)`` class rows that
contain word ``i``, the value-0 likelihood is ``(n_y - s) / n_y``. A class's
product over all words at value 0 is folded once into a per-class base
(count of zero factors, sum of logs); each test document then corrects only
the words it contains: remove their value-0 factor, add the factor for the
observed count. A posterior is zero exactly when the zero-factor count is
positive. Prediction: classes with a non-zero posterior beat the others,
then the larger log score (rounded to 1e-9), then the smaller label.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valence.operators.guards import class_array
from valence.session import freeze


@dataclass
class NBModel:
    classes: DataFrame      # label, n, prior, log_prior, base_zero, base_log
    likelihood: DataFrame   # label, term_id, tf, c, log_l        (tf >= 1, c > 0)
    class_terms: DataFrame  # label, term_id, s, zero0, log_l0    (s > 0)
    vocab: DataFrame        # term, term_id

    def save(self, path: str) -> None:
        """Four parquet tables under ``path``."""
        for name in ("classes", "likelihood", "class_terms", "vocab"):
            getattr(self, name).write.mode("overwrite").parquet(os.path.join(path, name))

    @classmethod
    def load(cls, spark, path: str) -> "NBModel":
        return cls(*(spark.read.parquet(os.path.join(path, name))
                     for name in ("classes", "likelihood", "class_terms", "vocab")))


def term_counts(docs: DataFrame, tokens_col: str = "tokens", keep=("label",)) -> DataFrame:
    """``(doc_id, [label], term, tf)``. Documents are hash-partitioned by
    ``doc_id`` once; counting terms per document and every later
    per-document aggregation reuse that partitioning."""
    keep = [k for k in keep if k in docs.columns]
    exploded = (docs.repartition("doc_id")
                .select("doc_id", *keep, F.explode(tokens_col).alias("term")))
    return exploded.groupBy("doc_id", *keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def with_term_ids(tf: DataFrame, vocab: DataFrame) -> DataFrame:
    """Vocabulary words only, ``term`` replaced by ``term_id``."""
    return tf.join(vocab.select("term", "term_id"), "term").drop("term")


def doc_term_counts(docs: DataFrame, vocab: DataFrame, tokens_col: str = "tokens",
                    keep=("label",)) -> DataFrame:
    """``(doc_id, [label], term_id, tf)`` for vocabulary words only."""
    return with_term_ids(term_counts(docs, tokens_col, keep), vocab)


def class_priors(labels: DataFrame) -> DataFrame:
    """``(label, n, total, prior)``; the grand total is a scalar subquery."""
    total = labels.agg(F.count(F.lit(1))).scalar()
    return (labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("total", total)
            .withColumn("prior", F.col("n") / F.col("total")))


def fit(train_docs: DataFrame, vocab: DataFrame, tokens_col: str = "tokens",
        checkpoint: bool = True, train_tf: DataFrame | None = None) -> NBModel:
    """M3: ``train_docs(doc_id, label, tokens)`` and a vocabulary -> model.
    ``train_tf`` may pass precomputed ``term_counts`` of the same documents.

    The training postings are aggregated once and that table is frozen:
    ``(label, term_id, tf, c)``, from which the per-class document frequency
    ``s`` and the per-class base follow."""
    keep = freeze if checkpoint else (lambda df: df)
    priors = class_priors(train_docs.select("label")).select("label", "n", "prior")
    if train_tf is None:
        train_tf = term_counts(train_docs.select("doc_id", "label", tokens_col), tokens_col)
    # A10: rows of class y whose word i has count v (v >= 1 only)
    counts = keep(with_term_ids(train_tf, vocab).groupBy("label", "term_id", "tf")
                  .agg(F.count(F.lit(1)).alias("c"))
                  .join(priors.select("label", "n"), "label"))
    lik = counts.select("label", "term_id", "tf", "c", F.log(F.col("c") / F.col("n")).alias("log_l"))
    full = F.col("s") == F.col("n")
    class_terms = (counts.groupBy("label", "term_id").agg(F.sum("c").alias("s"), F.first("n").alias("n"))
                   .select("label", "term_id", "s", full.cast("int").alias("zero0"),
                           F.when(full, F.lit(0.0))
                           .otherwise(F.log((F.col("n") - F.col("s")) / F.col("n"))).alias("log_l0")))
    base = class_terms.groupBy("label").agg(F.sum("zero0").alias("base_zero"),
                                            F.sum("log_l0").alias("base_log"))
    classes = keep(priors.join(base, "label", "left")
                   .select("label", "n", "prior", F.log("prior").alias("log_prior"),
                           F.coalesce("base_zero", F.lit(0)).cast("bigint").alias("base_zero"),
                           F.coalesce("base_log", F.lit(0.0)).alias("base_log")))
    # the vocabulary is the caller's (already frozen) table
    return NBModel(classes, lik, class_terms, vocab.select("term", "term_id"))


def score(model: NBModel, docs: DataFrame, tokens_col: str = "tokens", keep=freeze) -> DataFrame:
    """J3 + A11: ``(doc_id, label_c, zero_factors, log_score)`` for the classes
    that can win.

    A posterior is non-zero only if every present word has its observed count
    in some row of the class, so classes without a single such hit are left
    out: their posterior is zero. Two classes stand in for them in every
    document: the best by base score (it wins when no vocabulary word is
    present) and the smallest label (it wins when every posterior is zero).
    Rows grow with the hits, not with documents x classes. ``keep`` holds the
    postings: ``session.freeze`` or ``store``."""
    # read by three branches below; column pruning makes their plans differ,
    # so the exchange would not be reused: compute the postings once
    tf = keep(doc_term_counts(docs.select("doc_id", tokens_col), model.vocab, tokens_col,
                              keep=()))
    ct = model.class_terms.select("term_id", "label", "zero0", "log_l0")
    lk = model.likelihood.select("term_id", "tf", "label", "log_l")
    # A: remove the value-0 factor of every present word (classes where it occurs)
    a_rows = tf.join(ct, "term_id").select(
        "doc_id", F.col("label").alias("label_c"), F.lit(0).alias("hit"),
        (-F.col("zero0")).alias("dz"), (-F.col("log_l0")).alias("dl"))
    # B: the observed-count factor; a miss is a zero factor, a hit cancels it
    b_rows = tf.join(lk, ["term_id", "tf"]).select(
        "doc_id", F.col("label").alias("label_c"), F.lit(1).alias("hit"),
        F.lit(-1).alias("dz"), F.col("log_l").alias("dl"))
    base_rank = F.struct(F.col("base_zero") == 0,
                         F.round(F.col("log_prior") + F.col("base_log"), 9), -F.col("label"))
    stand_in = model.classes.agg(F.array(F.min("label"), F.max_by("label", base_rank))).scalar()
    g_rows = docs.select("doc_id", F.explode(F.array_distinct(stand_in)).alias("label_c")).select(
        "doc_id", "label_c", F.lit(1).alias("hit"), F.lit(0).alias("dz"), F.lit(0.0).alias("dl"))
    present = tf.groupBy("doc_id").agg(F.count(F.lit(1)).alias("m"))
    return (g_rows.unionByName(a_rows).unionByName(b_rows)
            .groupBy("doc_id", "label_c")
            .agg(F.sum("hit").alias("hit"), F.sum("dz").alias("dz"), F.sum("dl").alias("dl"))
            .where("hit > 0")
            .join(model.classes.withColumnRenamed("label", "label_c"), "label_c")
            .join(present, "doc_id", "left")
            .select("doc_id", "label_c",
                    (F.col("base_zero") + F.coalesce("m", F.lit(0)) + F.col("dz")).cast("bigint").alias("zero_factors"),
                    (F.col("log_prior") + F.col("base_log") + F.col("dl")).alias("log_score")))


def predict(model: NBModel, docs: DataFrame, tokens_col: str = "tokens", keep=freeze) -> DataFrame:
    """M4 + A12: ``(doc_id, [label], prediction DOUBLE, zero_factors, log_score)``
    for the winning class."""
    scores = score(model, docs, tokens_col, keep)
    ok = F.col("zero_factors") == 0
    key = F.struct(ok.alias("ok"),
                   F.when(ok, F.round("log_score", 9)).otherwise(F.lit(0.0)).alias("ls"),
                   (-F.col("label_c")).alias("neg"))
    best = (scores.groupBy("doc_id")
            .agg(F.max_by(F.struct("label_c", "zero_factors", "log_score"), key).alias("b"))
            .select("doc_id", F.col("b.label_c").cast("double").alias("prediction"),
                    F.col("b.zero_factors").alias("zero_factors"),
                    F.col("b.log_score").alias("log_score")))
    if "label" in docs.columns:
        best = best.join(docs.select("doc_id", "label"), "doc_id")
    return best


def likelihood_table(model: NBModel) -> DataFrame:
    """A6 + A10 in the reference's shape: ``(label, term_id, value,
    likelihood)`` for every class, every vocabulary word and every count value
    observed for that word in training (all classes), 0 included when some
    training row lacks the word. Values unseen in a class get 0."""
    n_total = model.classes.agg(F.sum("n")).scalar()
    seen = model.likelihood.select("term_id", F.col("tf").alias("value")).distinct()
    df_i = model.class_terms.groupBy("term_id").agg(F.sum("s").alias("df"))
    zero = df_i.filter(F.col("df") < n_total).select("term_id", F.lit(0).cast("bigint").alias("value"))
    values = seen.unionByName(zero)
    labels = class_array(model.classes, "label")
    grid = values.select("term_id", "value", F.explode(labels).alias("label"))
    n = model.classes.select("label", "n")
    pos = model.likelihood.select("label", "term_id", F.col("tf").alias("value"), "c")
    s = model.class_terms.select("label", "term_id", "s")
    return (grid.join(n, "label")
            .join(pos, ["label", "term_id", "value"], "left")
            .join(s, ["label", "term_id"], "left")
            .select("label", "term_id", "value",
                    (F.when(F.col("value") == 0, F.col("n") - F.coalesce("s", F.lit(0)))
                     .otherwise(F.coalesce("c", F.lit(0))) / F.col("n")).alias("likelihood")))
