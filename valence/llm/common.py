"""Helpers shared by the operators: table access, folds, shared tables and
connected components."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valence.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: str | Column, parts: int) -> Column:
    """``crc32(doc_id as text) mod parts``; a null id counts as empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % parts


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage is
    cut, a lost executor costs nothing, and later readers prune columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`materialise`."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The column's texts as UTF-8 bytes; null is empty."""
    col = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def record(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
              for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of the undirected graph ``edges(a, b)``;
    ``root`` is the smallest node of the component.

    Alternates the large-star and small-star steps: each round hangs every
    node's larger, then smaller, neighbours below its smallest one, so the
    number of edges never grows and the rounds are logarithmic in practice.
    Each round is one table in the shared folder. Self-links are ignored; an
    empty graph gives an empty result.
    """
    current = materialise(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    state = None
    for _ in range(max_rounds):
        both = current.union(current.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(low, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a")
                 .select(F.explode(F.when(F.col("b") == F.col("m"), F.array(F.struct("a", "b")))
                                   .otherwise(F.array(F.struct(F.col("b").alias("a"),
                                                               F.col("m").alias("b"))))).alias("e"))
                 .select("e.a", "e.b").distinct())
        following = materialise(small, "cc")
        row = following.agg(F.count("*").alias("n"),
                            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        discard(current)
        current = following
        if (row.n, row.h) == state:
            break
        state = (row.n, row.h)
    else:
        raise RuntimeError("connected components did not converge")
    return (current.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(current.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())


#: Labelled rows a classifier is fitted on at most, taken by hash of the id.
FIT_ROWS = 200_000


def fit_labels(labels: DataFrame, columns: list[str], fit_rows: int = FIT_ROWS) -> DataFrame:
    """``(doc_id, *columns)``: one row for each labelled id, at most ``fit_rows``
    of them (the smallest id hashes), so the result has a proven size and is
    marked for broadcast. Rows with a null id or label are left out; an id
    with several rows takes the largest label."""
    clean = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          *(F.col(c).cast("int").alias(c) for c in columns)).dropna()
    one = clean.groupBy("doc_id").agg(*(F.max(c).alias(c) for c in columns))
    share = 0.95 * fit_rows / max(1, one.count())
    if share < 1:
        one = one.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    return F.broadcast(one.limit(fit_rows))


def largest(df: DataFrame, score: str, limit: int) -> DataFrame:
    """The rows of the largest positive scores, at most ``limit``. A histogram
    of logarithmic bins gives the threshold, so no task and not the driver
    ever sorts more than the result; rows of a bin stay or go together."""
    bins = (df.groupBy(F.floor(F.log2(score) * 32).alias("bin")).agg(F.count("*").alias("n"))
            .orderBy(F.desc("bin")).collect())  # about 64 x 32 bins whatever the rows
    total, edge = 0, None
    for r in bins:
        total += r.n
        if total > limit:
            break
        edge = r.bin
    if edge is None:
        return df.orderBy(F.desc(score)).limit(limit)
    return df.where(F.floor(F.log2(score) * 32) >= edge)
