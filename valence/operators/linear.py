"""Sequence classifier, re-aimed for Spark.

The reference embeds tokens with pretrained word vectors, runs a
bidirectional LSTM on one machine and trains it for ten epochs with
cross-entropy, keeping the weights of the epoch with the lowest validation
loss. Here a document is the mean of its token vectors (unknown and special
tokens count as zero vectors), computed as a weighted ``Summarizer.mean``
aggregate, and a logistic model is fitted to the same cross-entropy objective.

An epoch is one distributed pass over the documents: it sums the gradient and
the curvature of the loss at the present coefficients, which give the next
ones (a Newton step), together with the losses of both splits. The coefficients
of the epoch with the lowest validation loss are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valence.operators.guards import BROADCAST_BYTES, NARROW_ROW_BYTES
from valence.operators.ranking import global_row_number
from valence.operators.split import hash_bucket
from valence.session import freeze

# The reference's batch size and epoch count.
BATCH_SIZE = 512
EPOCHS = 10
N_SPECIALS = 2
DECAY = 0.9  # of a token's weight with each position from the end of the text
TOKENS = 1 << 16  # of a text whose vectors are added at a time
RIDGE = 1e-3  # per training row; keeps the steps finite on separable data


def word_vectors(vocab: DataFrame, embeddings: DataFrame) -> DataFrame:
    """J4 stand-in: ``(term_id, vec)``; word ``term_id >= 2`` takes the
    embedding row ``term_id % count(embeddings)``, specials have none."""
    n = embeddings.agg(F.count(F.lit(1))).scalar()
    ids = vocab.filter(F.col("term_id") >= N_SPECIALS).select(
        "term_id", (F.col("term_id") % n).alias("vec_id"))
    return ids.join(embeddings.select("vec_id", F.col("embedding").alias("vec")), "vec_id").drop("vec_id")


def _vector_sums(docs: DataFrame, vocab: DataFrame, vectors: DataFrame, tokens_col: str, dim: int,
                 decay: float | None) -> DataFrame:
    """``(doc_id, sums)``: for each kind of weight the weighted sum of the token
    vectors of a document and the sum of the weights. Without ``decay`` each
    token weighs 1; with it, there are also the weights of the two recurrences.

    The words' vectors go to the tasks in blocks of BROADCAST_BYTES at most, so
    no vector is shuffled with a token: a document sends one row of sums for
    each block. Words without a vector weigh, but add nothing; a word with
    several vectors counts once for each."""
    zero = F.array_repeat(F.lit(0.0).cast("float"), dim)
    table = (vocab.select("term", "term_id").join(vectors.select("term_id", F.coalesce("vec", zero).alias("vec")), "term_id")
             .select("term", "vec"))
    blocks = max(1, -(-vocab.count() * (4 * dim + NARROW_ROW_BYTES) // BROADCAST_BYTES))
    kinds = 1 if decay is None else 3
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def sums_of(block: int):
        got = table.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == block).toArrow().combine_chunks()
        known = pc.dictionary_encode(got["term"].combine_chunks())
        words, at = known.dictionary, known.indices.to_numpy()
        number = np.bincount(at, minlength=len(words)).astype(np.float64)
        own = got["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)
        if len(words) == len(at):
            matrix = own
        else:
            matrix = np.zeros((len(words), dim))
            np.add.at(matrix, at, own)
        shared = docs.sparkSession.sparkContext.broadcast((words, number - 1, matrix))

        def run(batches):
            words, more, matrix = shared.value
            for b in batches:
                tokens = b.column(1)
                flat = tokens.flatten()
                ids = pc.fill_null(pc.index_in(flat, value_set=words.cast(flat.type)), -1).to_numpy()
                ends = np.cumsum(pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False))
                out = np.zeros((b.num_rows, kinds, dim + 1))
                for k, (start, end) in enumerate(zip([0, *ends.tolist()], ends.tolist())):
                    for s in range(start, end, TOKENS):
                        own = ids[s:min(s + TOKENS, end)]
                        weights = np.ones((kinds, len(own)))
                        if decay is not None:
                            pos = np.arange(s - start, s - start + len(own))
                            weights[1] = np.power(decay, end - start - 1.0 - pos)
                            weights[2] = np.power(decay, pos.astype(np.float64))
                        if block == 0:
                            out[k, :, dim] += weights.sum(1)
                        met = np.flatnonzero(own >= 0)
                        weights, own = weights[:, met], own[met]
                        out[k, :, :dim] += weights @ matrix[own]
                        out[k, :, dim] += weights @ more[own]
                values = pa.array(out.ravel())
                offsets = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * (kinds * (dim + 1)))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, values)], names=["doc_id", "v"])

        return docs.select("doc_id", F.col(tokens_col).alias("tokens")).mapInArrow(run, f"doc_id {id_type}, v array<double>")

    rows = sums_of(0)
    for block in range(1, blocks):
        rows = rows.union(sums_of(block))
    sums = rows.groupBy("doc_id").agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("sums"))
    return sums.where(F.get("sums", F.lit(dim)) > 0)


def _means(docs: DataFrame, sums: DataFrame, dim: int, kinds: int) -> DataFrame:
    def part(i: int) -> Column:
        total = F.get("sums", F.lit(i * (dim + 1) + dim))
        return F.transform(F.slice("sums", i * (dim + 1) + 1, dim), lambda x: x / total)

    means = sums.select("doc_id", F.concat(*map(part, range(kinds))).alias("features"))
    nothing = F.array_repeat(F.lit(0.0), kinds * dim)
    return docs.select("doc_id").join(means, "doc_id", "left").select(
        "doc_id", array_to_vector(F.coalesce("features", nothing)).alias("features"))


def _dim(vectors: DataFrame) -> int:
    first = vectors.select(F.size("vec")).first()
    return first[0] if first else 0


def pooled_vectors(docs: DataFrame, vocab: DataFrame, vectors: DataFrame,
                   tokens_col: str = "tokens", dim: int | None = None) -> DataFrame:
    """``(doc_id, features)``, the mean token vector of each document; the
    zero vector for a document without tokens."""
    dim = _dim(vectors) if dim is None else dim
    return _means(docs, _vector_sums(docs, vocab, vectors, tokens_col, dim, None), dim, 1)


def ordered_vectors(docs: DataFrame, vocab: DataFrame, vectors: DataFrame,
                    tokens_col: str = "tokens", dim: int | None = None, decay: float = DECAY) -> DataFrame:
    """M9: ``(doc_id, features)`` that depend on the order of the tokens: the
    mean token vector, then the last states of two linear recurrences, one
    forwards (``s = decay * s + v`` from the first token to the last) and one
    backwards, each over the sum of its weights. ``3 * dim`` numbers, zeros for
    a document without tokens.

    A linear state is a sum weighted by position, so the sums of all blocks of
    words are added as in :func:`pooled_vectors`."""
    dim = _dim(vectors) if dim is None else dim
    return _means(docs, _vector_sums(docs, vocab, vectors, tokens_col, dim, float(decay)), dim, 3)


@dataclass(frozen=True)
class LinearModel:
    """A two-class softmax model: coefficients, then the intercept."""

    weights: tuple[float, ...]
    epoch: int = 0
    loss: float = float("nan")

    def save(self, spark: SparkSession, path: str) -> None:
        """S10."""
        spark.createDataFrame([(list(self.weights), self.epoch, self.loss)],
                              "weights array<double>, epoch int, loss double").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "LinearModel":
        r = spark.read.parquet(path).first()
        return cls(tuple(r.weights), r.epoch, r.loss)

    def margin(self, features: str | Column = "features") -> Column:
        products = F.zip_with(vector_to_array(features), F.array(*map(F.lit, self.weights[:-1])), lambda x, w: x * w)
        return F.aggregate(products, F.lit(self.weights[-1]), lambda a, x: a + x)


def cross_entropy(margin: Column, label: str | Column = "label") -> Column:
    """The loss of one row from its margin."""
    label = F.col(label) if isinstance(label, str) else label
    m = F.when(label > 0, margin).otherwise(-margin)
    return F.greatest(-m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m)))


def score(model: LinearModel, docs: DataFrame) -> DataFrame:
    """M12 + F22: ``(doc_id, [label], prediction, probability)`` where
    probability is the softmax probability of the predicted class."""
    keep = [c for c in ("doc_id", "label") if c in docs.columns]
    return (docs.select(*keep, model.margin().alias("_m"))
            .select(*keep, (F.col("_m") > 0).cast("double").alias("prediction"),
                    (1 / (1 + F.exp(-F.abs("_m")))).alias("probability")))


def batch_ids(docs: DataFrame, seed=100, batch_size: int = BATCH_SIZE) -> DataFrame:
    """T5 + M11: a seeded shuffled order (md5 of the key) cut into batches
    of ``batch_size``; the global row number is computed without a
    single-partition window."""
    order = hash_bucket("doc_id", f"order{seed}", 1 << 30)
    ranked = global_row_number(docs.withColumn("_o", order), [F.col("_o"), F.col("doc_id")], "_rn")
    return ranked.withColumn("batch", ((F.col("_rn") - 1) / batch_size).cast("bigint")).drop("_o", "_rn")


def pad_batches(batched: DataFrame, ids_col: str = "ids", pad_id: int = 1) -> DataFrame:
    """pad every id sequence to the longest sequence of its batch. The
    maximum is a window over the batch, which holds at most ``BATCH_SIZE``
    rows; nothing that grows with the data is broadcast."""
    longest = F.max(F.size(ids_col)).over(Window.partitionBy("batch"))
    return (batched.withColumn("_max", longest)
            .withColumn("padded", F.concat(F.col(ids_col), F.array_repeat(
                F.lit(pad_id), F.col("_max") - F.size(ids_col))))
            .drop("_max"))


def _pass(rows: DataFrame, weights: np.ndarray) -> dict[str, tuple[float, float, np.ndarray]]:
    """One job: for each split the mean over batches of the mean loss and
    accuracy at ``weights``, and the sums of gradient and curvature."""
    size = len(weights) * (len(weights) + 1)
    schema = pa.schema([("split", pa.string()), ("batch", pa.int64()), ("n", pa.float64()), ("loss", pa.float64()),
                        ("right", pa.float64()), ("sums", pa.list_(pa.float64()))])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(2).values.to_numpy().reshape(b.num_rows, -1)
            x = np.hstack((x, np.ones((len(x), 1))))
            y, split, batch = b.column(3).to_numpy(), np.array(b.column(0).to_pylist()), b.column(1).to_numpy()
            m = x @ weights
            p = 1 / (1 + np.exp(-np.clip(m, -500, 500)))
            loss = np.logaddexp(0, np.where(y > 0, -m, m))
            out = []
            for s, k in sorted(set(zip(split.tolist(), batch.tolist()))):
                at = (split == s) & (batch == k)
                g = x[at].T @ (p[at] - y[at])
                h = (x[at] * (p[at] * (1 - p[at]))[:, None]).T @ x[at]
                out.append((s, k, float(at.sum()), loss[at].sum(), float(((m > 0) == (y > 0))[at].sum()),
                            np.concatenate((g, h.ravel())) if s == "train" else np.zeros(size)))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    sums = Summarizer.sum(F.col("v"))
    got = (rows.mapInArrow(run, "split string, batch long, n double, loss double, right double, sums array<double>")
           .withColumn("v", array_to_vector("sums"))
           .groupBy("split", "batch").agg(F.sum("n").alias("n"), F.sum("loss").alias("loss"), F.sum("right").alias("right"),
                                          sums.alias("v"))
           .groupBy("split").agg(F.avg(F.col("loss") / F.col("n")).alias("loss"),
                                 F.avg(F.col("right") / F.col("n")).alias("accuracy"), sums.alias("v"),
                                 F.sum("n").alias("n")).collect())  # two rows
    return {r.split: (r.loss, r.accuracy, r.v.toArray(), r.n) for r in got}


def train_epochs(train: DataFrame, valid: DataFrame, epochs: int = EPOCHS, run: str = "lr",
                 batch_size: int = BATCH_SIZE) -> tuple[LinearModel, DataFrame]:
    """M10 + A18 + A19 + U3: the model of the epoch with the lowest validation
    loss (of the training loss without validation rows), and the history
    ``(run, split, epoch, loss, accuracy)``: unweighted means over batches of
    ``batch_size`` rows, as the reference averages its per-batch values.

    ``train`` and ``valid`` are ``(doc_id, features, label)``, labels 0 and 1.
    Epoch ``e`` is one pass over both and starts from epoch ``e - 1``."""
    parts = [batch_ids(df.select("doc_id", vector_to_array("features").alias("features"),
                                 F.col("label").cast("double").alias("label")), batch_size=batch_size)
             .select(F.lit(name).alias("split"), "batch", "features", "label")
             for name, df in (("train", train), ("valid", valid))]
    rows = freeze(parts[0].unionByName(parts[1]))
    first = rows.first()
    d = len(first.features) + 1 if first else 1
    weights, best, history = np.zeros(d), None, []
    for e in range(epochs + 1):
        seen = _pass(rows, weights)
        if e:
            history += [(run, s, e, *seen[s][:2]) for s in ("train", "valid") if s in seen]
            loss = seen.get("valid", seen.get("train", (float("nan"),)))[0]
            if best is None or loss < best.loss:
                best = LinearModel(tuple(weights.tolist()), e, loss)
        if "train" in seen:
            *_, sums, n = seen["train"]
            ridge = RIDGE * n * np.append(np.ones(d - 1), 0.0)
            weights = weights - np.linalg.solve(sums[d:].reshape(d, d) + np.diag(ridge + 1e-9),
                                                sums[:d] + ridge * weights)
    best = best or LinearModel(tuple(weights.tolist()))
    return best, rows.sparkSession.createDataFrame(
        history, "run string, split string, epoch int, loss double, accuracy double")
