"""Readers for the parquet tables and the labelled-text stand-ins.

Only the columns an operator needs are selected, so the parquet scan's
ReadSchema stays narrow; predicates placed after these readers are pushed
into the scan by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valence.functions.text import binarise_polarity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table; the session's split size decides the parallelism."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def labelled_text(spark: SparkSession, sf_dir: str, label: str = "quality") -> DataFrame:
    """Labelled texts ``(doc_id, text, label)``.

    ``label="quality"`` uses the labels table; ``label="en"`` labels a
    document 1 when its language is English, which the text predicts well.
    """
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    if label == "en":
        lab = labels.select("doc_id")
        return (docs.join(lab, "doc_id")
                .select("doc_id", "text", (F.col("lang") == "en").cast("int").alias("label")))
    return (docs.select("doc_id", "text")
            .join(labels.select("doc_id", F.col(label).cast("int").alias("label")), "doc_id"))


def polarity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed polarity stand-in ``(id, polarity)`` from customer balances."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("polarity"))


def labelled_polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, polarity, label)`` with the reference's binarisation (P5)."""
    return polarity_rows(spark, sf_dir).withColumn("label", binarise_polarity("polarity"))
