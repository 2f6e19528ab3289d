"""Line dedup: drop lines that many documents repeat (native, no Python).

Lines are exploded and normalised, their 128-bit hashes counted over distinct
documents, lines over the threshold dropped everywhere but in one document,
and each text reassembled from the remaining positions.

Defined cases: a null or empty text is one empty line; rows with the same id
count as one document; rows without an id count together as one document that
never is the largest holder; repeated rows get equal results; columns other
than ``doc_id`` and ``text`` pass through unless they bear a result's name,
which then holds the result; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valence.llm.common import materialise, read_table

MIN_CHARS = 40
MIN_DOCS = 5
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lines(text: str | Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row_hash() -> list[Column]:
    """Two independent 64-bit hashes that name a row by its id and text."""
    return [F.xxhash64(F.lit(s), "doc_id", F.coalesce("text", F.lit(""))).alias(f"_r{s}") for s in (1, 2)]


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(_r1, _r2, _pos)``: the rows (by hash) and line numbers to drop."""
    key = F.trim(F.col("_line"), F.lit(SPACES))
    lines = (docs.select("doc_id", *_row_hash(), F.posexplode(_lines(F.col("text"))).alias("_pos", "_line"))
             .select("doc_id", "_r1", "_r2", "_pos", key.alias("_key"))
             .where(F.length("_key") >= min_chars)
             .withColumn("_key", F.translate("_key", UPPER, LOWER))
             .select("doc_id", "_r1", "_r2", "_pos",
                     F.xxhash64(F.lit(1), "_key").alias("_h1"), F.xxhash64(F.lit(2), "_key").alias("_h2")))
    # one row for each document and line, then partial sums for each line: a
    # line that a third of all documents hold never meets in one task
    frequent = (lines.groupBy("_h1", "_h2", "doc_id").agg(F.lit(1).alias("_one"))
                .groupBy("_h1", "_h2").agg(F.sum("_one").alias("_docs"), F.max("doc_id").alias("_holder"))
                .where(F.col("_docs") >= min_docs).select("_h1", "_h2", "_holder"))
    # written out, so that the join below has a shuffle of its own on both sides
    # and a line that very many documents hold is split over several tasks
    frequent = materialise(frequent, "lines")
    return (lines.join(frequent, ["_h1", "_h2"])
            .where(~F.col("doc_id").eqNullSafe(F.col("_holder")))
            .select("_r1", "_r2", "_pos"))


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``text`` rebuilt from its kept lines, plus ``n_lines``
    (before dropping) and ``n_dropped``."""
    base = docs.drop("n_lines", "n_dropped")
    gone = (repeated_lines(base, min_chars, min_docs)
            .groupBy("_r1", "_r2").agg(F.collect_set("_pos").alias("_gone")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), F.col("_gone"))
    text = F.when(F.col("_gone").isNull(), F.coalesce("_row.text", F.lit(""))).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col("_all"), i)), "\n"))
    kept_columns = [text.alias("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in base.columns]
    # the caller's columns travel in one struct, so none of them can meet a name used here
    return (base.select(F.struct(*base.columns).alias("_row"), *_row_hash())
            .join(gone, ["_r1", "_r2"], "left")
            .withColumn("_all", _lines(F.col("_row.text")))
            .select(*kept_columns, F.size("_all").cast("long").alias("n_lines"),
                    F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped")))


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_lines", "n_dropped",
                         F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return digest(line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


SQL = """
WITH l AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents
), k AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), f AS (
  SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT k.doc_id, k.pos, k.line, (f.key IS NOT NULL AND k.doc_id <> f.holder) AS gone
  FROM k LEFT JOIN f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

QUERIES = {"op3_line_dedup": query}
ORACLE = {"op3_line_dedup": SQL}
