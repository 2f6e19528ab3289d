"""Deterministic train/test splits (M1, M2).

``randomSplit`` depends on the input's partitioning (the same seed gives a
different split after a repartition), so the default split hashes the row
key instead: ``md5(salt:key)`` read as a number modulo 100. It needs no
shuffle, is reproducible on any cluster layout, and DuckDB computes the same
bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_bucket(key, salt: str, buckets: int = 100) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{salt}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def split_flag(key, fraction: float = 0.7, seed=100) -> Column:
    """True for rows of the first (training) part."""
    return hash_bucket(key, str(seed)) < int(round(fraction * 100))


def hash_split(df: DataFrame, key: str, fraction: float = 0.7, seed=100):
    """M1: ``(train, test)``, 70/30 with seed 100 by default."""
    flag = split_flag(key, fraction, seed)
    return df.filter(flag), df.filter(~flag)


def validation_split(df: DataFrame, key: str, fraction: float = 0.7, seed=100):
    """M2: split a training part again, with a different salt."""
    return hash_split(df, key, fraction, f"v{seed}")


def tag_split(df: DataFrame, key: str, fraction: float = 0.7, seed=100) -> DataFrame:
    return df.withColumn("split", F.when(split_flag(key, fraction, seed), "train").otherwise("test"))


def random_split(df: DataFrame, fraction: float = 0.7, seed=100) -> DataFrame:
    """M1, plain form: Spark's ``randomSplit`` with the reference's weights,
    tagged and unioned. Membership depends on partitioning; row totals do not."""
    train, test = df.randomSplit([fraction, 1.0 - fraction], seed=seed)
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test")))
