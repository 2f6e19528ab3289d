"""Term counts and deterministic vocabularies.

Documents stay in a long ``(doc_id, term, tf)`` table; vectors are never
densified. Vocabulary ids follow ``(corpus count desc, term asc)`` and are
assigned with the distributed global row number, so the id of a word does
not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valence.operators.ranking import global_row_number
from valence.session import freeze

# The sequence model's specials, ids 0 and 1, and the
# reference's minimum corpus frequency for that vocabulary.
UNK, PAD = "<unk>", "<pad>"
MIN_FREQ = 4


def term_frequencies(docs: DataFrame, tokens_col: str = "tokens", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, term, tf)`` — a bag of words per document.

    The outer form with a filter on the position gives the rows of ``explode``;
    for that Spark would put a filter on the tokens' expression below every
    join, where it cleans and splits all texts of the table once more."""
    return (docs.select(F.col(id_col).alias("doc_id"), F.posexplode_outer(tokens_col).alias("pos", "term"))
            .where("pos is not null")
            .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf")))


def occurrences(docs: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """``(term, tf)``, a row of 1 for each token: what a vocabulary counts, where
    no document's own counts are needed. Terms add up before any shuffle."""
    return docs.select(F.explode(tokens_col).alias("term"), F.lit(1).cast("bigint").alias("tf"))


def distinct_words(docs: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """A4: distinct words of a corpus."""
    return docs.select(F.explode(tokens_col).alias("term")).distinct()


def corpus_counts(tf: DataFrame) -> DataFrame:
    """``(term, cnt, df)``: corpus count and document frequency."""
    return tf.groupBy("term").agg(F.sum("tf").alias("cnt"), F.count(F.lit(1)).alias("df"))


def build_vocab(tf: DataFrame, max_size: int | None = None, min_count: int = 1,
                specials: tuple = (), checkpoint: bool = False) -> DataFrame:
    """``(term, term_id, cnt)``.

    Terms with ``cnt >= min_count`` are numbered by ``(cnt desc, term)``;
    ``max_size`` keeps the first ones (a count vectoriser's vocabulary size).
    ``specials`` take ids ``0..len-1`` and shift the others. The ranked rows
    are already frozen by the row numbering, so the vocabulary is a cheap
    projection of that checkpoint; ``checkpoint=True`` freezes it again.
    """
    counts = corpus_counts(tf).filter(F.col("cnt") >= min_count).select("term", "cnt")
    ranked = global_row_number(counts, [F.desc("cnt"), F.asc("term")], "rn")
    if max_size is not None:
        ranked = ranked.filter(F.col("rn") <= max_size)
    vocab = ranked.select("term", (F.col("rn") - 1 + len(specials)).cast("int").alias("term_id"), "cnt")
    if specials:
        spark = tf.sparkSession
        extra = spark.createDataFrame([(s, i, 0) for i, s in enumerate(specials)],
                                      "term string, term_id int, cnt bigint")
        vocab = extra.unionByName(vocab)
    return freeze(vocab) if checkpoint else vocab


def count_vectorizer_vocab(tf: DataFrame, vocab_size: int | None = None) -> DataFrame:
    """All terms by count, ids from 0; ``vocab_size`` keeps the first ones."""
    return build_vocab(tf, max_size=vocab_size)


def sequence_vocab(tf: DataFrame, min_freq: int = MIN_FREQ) -> DataFrame:
    """``<unk>`` = 0, ``<pad>`` = 1, then terms seen at least ``min_freq`` times."""
    return build_vocab(tf, min_count=min_freq, specials=(UNK, PAD))


def lookup_ids(tf: DataFrame, vocab: DataFrame, default_id: int | None = None) -> DataFrame:
    """Attach ``term_id``. Unknown terms get ``default_id``; with
    ``default_id=None`` they are dropped. The planner
    broadcasts a vocabulary whose measured size allows it."""
    v = vocab.select("term", "term_id")
    if default_id is None:
        return tf.join(v, "term")
    return tf.join(v, "term", "left").withColumn(
        "term_id", F.coalesce(F.col("term_id"), F.lit(default_id)))


def encode_sequence(docs: DataFrame, vocab: DataFrame, tokens_col: str = "tokens",
                    default_id: int = 0) -> DataFrame:
    """token array -> id array in token order, unknown -> ``default_id``.

    Position-exploded tokens are joined to the (size-checked) vocabulary and
    gathered back per document in position order.
    """
    pos = docs.select("doc_id", F.posexplode(tokens_col).alias("pos", "term"))
    ids = lookup_ids(pos, vocab, default_id)
    return (ids.groupBy("doc_id")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "term_id"))).alias("_p"))
            .select("doc_id", F.col("_p.term_id").alias("ids")))
