"""The corpus pipeline: five of the training-data operators in a row.

Each stage reads the documents its predecessor kept and returns documents with
the same columns; the last returns the sampling weights of the documents that
are left. Stages are written as Parquet in the session's shared folder and
read again. Null ids, null and empty texts, repeated rows, further columns and
empty tables are treated as the operators' modules define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valence.llm import decontam, langid, line_dedup, mixing, simhash
from valence.llm.common import materialise, read_table

# no stage but line dedup and the row selection after it can be put in SQL
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter, texts of which no language explains a
    quarter and texts far less likely than those of the learned languages;
    documents in two or three languages stay."""
    return langid.accept(docs, *langid.learn(docs.select("text", "lang")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops repeated lines; ``n_chars`` follows the text."""
    out = line_dedup.line_dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, tokens, domain, rate, copies)`` for the documents that are left."""
    mixed = mixing.mix(docs, read_table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", F.col("words").alias("tokens"), "domain", "rate", "copies")


STAGES = [
    ("language ID", language_id),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", weights),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
