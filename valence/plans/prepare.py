"""Shared preparation of labelled text: clean, tokenise, split.

One lazily-built DataFrame per query; Catalyst prunes what a query does
not use and pushes the scans' column lists down to parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valence.functions.text import clean_text, regex_tokens, remove_stop_words, word_tokens
from valence.operators.split import split_flag
from valence.sources.tables import labelled_text, table

SEED = 100
TRAIN_FRACTION = 0.7


def tokenised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, clean, tokens, words)`` of every document, labelled or not."""
    return (table(spark, sf_dir, "documents").select("doc_id", clean_text("text").alias("clean"))
            .withColumn("tokens", regex_tokens("clean"))
            .withColumn("words", word_tokens("clean")))


def prepared(spark: SparkSession, sf_dir: str, label: str = "quality") -> DataFrame:
    """``(doc_id, label, clean, tokens, words, is_train)``.

    ``tokens`` is the regex tokenisation (naive Bayes, sequence model),
    ``words`` the single-space split without empty pieces (KNN)."""
    lt = labelled_text(spark, sf_dir, label)
    return (lt.select("doc_id", "label", clean_text("text").alias("clean"))
            .withColumn("tokens", regex_tokens("clean"))
            .withColumn("words", word_tokens("clean"))
            .withColumn("is_train", split_flag("doc_id", TRAIN_FRACTION, SEED)))


def train_test(spark: SparkSession, sf_dir: str, label: str = "quality"):
    df = prepared(spark, sf_dir, label)
    return df.filter("is_train"), df.filter(~F.col("is_train"))


def without_stop_words(df: DataFrame) -> DataFrame:
    """Stop words removed, no row dropped. For consumers that explode the
    tokens (term counts, sequence encoding) this gives the same result as
    ``filtered_tokens``, because an empty list explodes to no rows. Leaving
    the filter out also keeps Catalyst from inlining the whole tokeniser into
    a pushed-down filter, where it would run a second time."""
    return df.withColumn("tokens", remove_stop_words("tokens"))


def filtered_tokens(df: DataFrame) -> DataFrame:
    """Stop words removed, empty token lists dropped (P6), as the sequence
    model's preparation does."""
    return without_stop_words(df).filter(F.size("tokens") > 0)
