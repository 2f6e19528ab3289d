"""Cross-tokenizer alignment by as-of merges.

Both tokenizers cut the same bytes, so tokens are ranges of byte positions.
A document falls into parts at blanks that no token of either side crosses;
within a batch two as-of merges, keyed by part, find for each token's start the
other side's token that covers it; both directions together are all overlapping
pairs, and a part that comes again is not aligned again. Byte positions where
tokens of both sides end cut a text into groups.

The first pass keeps each document's distinct id pairs and how often each
occurs. The documents that hold a pair are counted over the corpus; a table of
the ``HEAD`` most frequent pairs goes to every task and the other pairs are
joined by pair, so the pairs that very many documents hold are never shuffled.

Defined cases: a text that is null or empty, or whose tokens on either side do
not spell a space and the text, has no tokens and gets zeros and an empty
digest; every row counts as one document, repeated rows and null ids too; very
long texts make a batch of their own; ties for the highest count all count as
best; columns other than ``doc_id`` and ``text`` are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valence.llm.common import column, largest, materialise, read_table, record, utf8

#: Folder of the tokenizers' files; any folder with the two files will do.
FOLDER = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
MOST_FILE_BYTES = 64 << 20  # both files go to every executor
BATCH_BYTES = 1 << 19
HEAD = 1 << 18
#: Neither tokenizer has a token across a blank between two of these characters, so the parts of a
#: text that such blanks end are encoded on their own and equal parts once.
CUT = re.compile("(?<=[!-~\u00c0-\u00ff]) (?=[!-~\u00c0-\u00ff])")
HELD_CHARS = 1 << 22  # of parts that a worker remembers

COLUMNS = ("n_a", "n_b", "n_groups", "n_links")


class Side:
    """A tokenizer: ``encode`` gives the ids of a blank and each given part,
    ``pieces`` each id's bytes."""

    def __init__(self, encode, pieces: list[bytes]):
        self.encode, self.pieces = encode, pieces
        self.sizes = np.array([len(p) for p in pieces], np.int64)

    def ids(self, parts: list[str]) -> list[list[int]]:
        """Ids of the parts; none where they do not spell a blank and the part."""
        return [ids if b"".join(map(self.pieces.__getitem__, ids)) == (" " + p).encode() else []
                for p, ids in zip(parts, self.encode(parts))]


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for:
    printable bytes for themselves, the others in order from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level(data: bytes) -> Side:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(data.decode())
    tokenizer.encode_special_tokens = True
    letters = byte_letters()
    pieces = [b""] * tokenizer.get_vocab_size(True)
    for token, i in tokenizer.get_vocab(True).items():
        pieces[i] = bytes(map(letters.__getitem__, token)) if all(c in letters for c in token) else token.encode()
    return Side(lambda texts: [e.ids for e in tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)], pieces)


def sentence_pieces(data: bytes) -> Side:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=data)

    def spelled(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return Side(lambda texts: model.encode(texts, num_threads=1), [spelled(i) for i in range(model.get_piece_size())])


_LOADED: dict = {}


def load(a: bytes, b: bytes) -> Memory:
    """The two tokenizers and what has been aligned, once for each Python worker."""
    key = zlib.crc32(a), zlib.crc32(b)
    if key not in _LOADED:
        _LOADED[key] = Memory(byte_level(a), sentence_pieces(b))
    return _LOADED[key]


def _ranges(ids: list[list[int]], side: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, id, end)`` of all tokens, ends counted over the batch."""
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int64, int(size.sum()))
    return np.repeat(np.arange(len(ids)), size), flat, np.cumsum(side.sizes[flat])


def covering(doc: np.ndarray, start: np.ndarray, other_doc: np.ndarray, other_start: np.ndarray) -> np.ndarray:
    """Of each token's start, the other side's token that covers it."""
    left = pd.DataFrame({"pos": start, "doc": doc})
    right = pd.DataFrame({"pos": other_start, "doc": other_doc, "token": np.arange(len(other_doc))})
    return pd.merge_asof(left, right, on="pos", by="doc")["token"].to_numpy(np.int64)


@dataclass
class Aligned:
    """Alignments of parts: tokens on either side and groups as rows of
    ``counts``, the groups in digits, and the links' pairs ``a id << 32 | b
    id`` of all parts in turn, up to each part's ``ends``."""
    counts: np.ndarray
    groups: list[bytes]
    pairs: np.ndarray
    ends: np.ndarray


def align(parts: list[str], a: Side, b: Side) -> Aligned:
    """Alignments of parts; one that a side does not spell has no tokens."""
    ids_a, ids_b = a.ids(parts), b.ids(parts)
    for x, y in zip(ids_a, ids_b):
        if not x or not y:
            x.clear()
            y.clear()
    doc_a, a_id, a_end = _ranges(ids_a, a)
    doc_b, b_id, b_end = _ranges(ids_b, b)
    a_start, b_start = a_end - a.sizes[a_id], b_end - b.sizes[b_id]
    n = len(parts)

    # all overlapping pairs: the later start of a pair lies in the other token
    under_a, under_b = covering(doc_a, a_start, doc_b, b_start), covering(doc_b, b_start, doc_a, a_start)
    later = a_start[under_b] != b_start  # equal starts are found from both sides
    i = np.concatenate([np.arange(len(a_id)), under_b[later]])
    j = np.concatenate([under_a, np.flatnonzero(later)])
    doc = doc_a[i]
    pairs = (a_id[i] << 32 | b_id[j])[np.argsort(doc, kind="stable")]

    # groups end where tokens of both sides end
    ends = np.intersect1d(a_end, b_end, assume_unique=True)
    group_a, group_b = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
    counts = np.stack([np.bincount(d, minlength=n) for d in (doc_a, doc_b, doc_a[np.searchsorted(a_end, ends)])], 1)
    # in the text of the groups a token stands after all tokens of earlier
    # groups and, on the second side, after those of its own group's first side
    place_a = np.arange(len(a_id)) + np.searchsorted(group_b, group_a, "left")
    place_b = np.arange(len(b_id)) + np.searchsorted(group_a, group_b, "right")
    number = np.empty(len(a_id) + len(b_id), np.int64)
    mark = np.empty(len(number), np.int64)
    number[place_a], number[place_b] = a_id, b_id
    mark[place_a] = np.where(np.isin(a_end, ends, assume_unique=True), 1, 0)
    mark[place_b] = np.where(np.isin(b_end, ends, assume_unique=True), 2, 0)
    digits = _digits(max(len(a.pieces), len(b.pieces)))
    marked = list(map(digits.__getitem__, (number * 3 + mark).tolist()))
    size = counts[:, 0] + counts[:, 1]
    groups = [b"".join(marked[e - k:e])[:-1] for e, k in zip(np.cumsum(size).tolist(), size.tolist())]
    return Aligned(counts, groups, pairs, np.cumsum(np.bincount(doc, minlength=n)))


class Memory:
    """Alignments of the parts that a worker has met. Both sides have a token
    that ends where a part does, so a text's alignment is that of its parts in
    turn."""

    def __init__(self, a: Side, b: Side):
        self.sides = a, b
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.held = 0
        self.counts = np.zeros((0, 3), np.int64)
        self.starts, self.pairs = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def learn(self, parts: set[str]) -> None:
        """Align the parts that are not known."""
        new = [p for p in parts if p not in self.place]
        if not new:
            return
        found = align(new, *self.sides)
        self.place.update(zip(new, range(len(self.groups), len(self.groups) + len(new))))
        self.held += sum(map(len, new))
        self.groups += found.groups
        self.counts = np.concatenate([self.counts, found.counts])
        self.starts = np.concatenate([self.starts, found.ends + len(self.pairs)])
        self.pairs = np.concatenate([self.pairs, found.pairs])

    def texts(self, texts: list[bytes]) -> list:
        """Columns of the texts: the four counts, the digest, and the distinct
        pairs with their occurrences as lists."""
        if self.held > HELD_CHARS:
            self.forget()
        parts = [CUT.split(t.decode()) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(parts)))
        known = [[self.place[p] for p in x] for x in parts]
        # where a part is not spelled, the whole text decides
        unlike = [i for i, x in enumerate(known) if not self.counts[x, 0].all()]
        whole = {i: texts[i].decode() for i in unlike}
        self.learn(set(whole.values()))
        for i, t in whole.items():
            known[i] = [self.place[t]]
        n = len(texts)
        at = np.fromiter(chain.from_iterable(known), np.int64)
        doc = np.repeat(np.arange(n), np.fromiter(map(len, known), np.int64, n))
        counts = np.zeros((n, 3), np.int64)
        np.add.at(counts, doc, self.counts[at])
        size = self.starts[at + 1] - self.starts[at]
        stop = np.cumsum(size)
        pair = self.pairs[np.repeat(self.starts[at] - stop + size, size) + np.arange(stop[-1] if len(stop) else 0)]
        doc = np.repeat(doc, size)
        order = np.lexsort((pair, doc))
        pair, links = pair[order], np.bincount(doc, minlength=n)
        new = np.ones(len(pair), bool)
        new[1:] = (np.diff(doc[order]) != 0) | (np.diff(pair) != 0)
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(pair)))
        offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(doc[order][first], minlength=n)))).astype(np.int32))
        digest = [hashlib.sha256(b";".join(map(self.groups.__getitem__, x))).hexdigest() if k else ""
                  for x, k in zip(known, counts[:, 0].tolist())]
        return [*counts.T, links, digest, pa.ListArray.from_arrays(offsets, pa.array(pair[first])),
                pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))]


_TEXTS: dict[int, list[bytes]] = {}


def _digits(n: int) -> list[bytes]:
    """Each id's digits with the mark after it: within a group's side, at its
    first side's end, at its second side's."""
    if n not in _TEXTS:
        _TEXTS[n] = [b"%d%s" % (i, m) for i in range(n) for m in (b",", b"|", b";")]
    return _TEXTS[n]


def slices(batch: pa.RecordBatch, most: int):
    """The batch in parts of about ``most`` bytes of text, as ``(part, texts)``."""
    start, size, held = 0, 0, []
    for i, text in enumerate(utf8(batch, "text")):
        if held and size + len(text) > most:
            yield batch.slice(start, i - start), held
            start, size, held = i, 0, []
        held.append(text)
        size += len(text)
    if held:
        yield batch.slice(start), held


def encoded(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times)``
    of each row, and a number ``row`` of its own once it is written."""
    files = []
    for name in (A_FILE, B_FILE):
        path = os.path.join(folder, name)
        if os.path.getsize(path) > MOST_FILE_BYTES:
            raise ValueError(f"{path} is over {MOST_FILE_BYTES} bytes")
        with open(path, "rb") as f:
            files.append(f.read())
    shared = docs.sparkSession.sparkContext.broadcast(tuple(files))
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in COLUMNS), ("groups_sha256", pa.string()),
                        ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])

    def run(batches):
        memory = load(*shared.value)
        for batch in batches:
            for part, texts in slices(batch, BATCH_BYTES):
                distinct = {t: i for i, t in enumerate(dict.fromkeys(texts))}  # copies are encoded once
                columns = memory.texts(list(distinct))
                table = pa.table([pa.array(c) if not isinstance(c, pa.Array) else c for c in columns], names=schema.names[1:])
                if len(distinct) < len(texts):
                    table = table.take(pa.array([distinct[t] for t in texts]))
                table = table.combine_chunks()
                yield record(schema, [column(part, "doc_id"), *(c.chunk(0).cast(f.type) for c, f in zip(table.columns, list(schema)[1:]))])

    ddl = ("doc_id long, " + ", ".join(f"{c} long" for c in COLUMNS) + ", groups_sha256 string, pairs array<long>, times array<int>")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ddl)
            .withColumn("row", F.monotonically_increasing_id()))


def pair_counts(rows: DataFrame) -> DataFrame:
    """``(pair, n, best)``: how many rows hold the pair, and whether no pair of
    its first id is held by more."""
    counts = materialise(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
                         .withColumn("a", F.shiftright("pair", 32).cast("int")), "alignment")
    # one row for each id of a vocabulary
    most = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("most")))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def scored(rows: DataFrame, counts: DataFrame, head_size: int = HEAD) -> DataFrame:
    """``rows`` with ``n_best`` and ``count_sum`` over their links."""
    head = largest(counts, "n", head_size).toArrow().sort_by("pair")
    shared = rows.sparkSession.sparkContext.broadcast(
        (head["pair"].to_numpy(), head["n"].to_numpy(), head["best"].to_numpy()))
    schema = pa.schema([("row", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()),
                        ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])

    def run(batches):
        known, n, best = shared.value
        for b in batches:
            lists = column(b, "pairs")
            pair, times = lists.flatten().to_numpy(), column(b, "times").flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(known, pair), len(known) - 1)
            hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            total, good = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            np.add.at(total, row[hit], times[hit] * n[at[hit]])
            np.add.at(good, row[hit], times[hit] * best[at[hit]])
            offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row[~hit], minlength=b.num_rows)))).astype(np.int32))
            yield record(schema, [column(b, "row"), good, total, pa.ListArray.from_arrays(offsets, pa.array(pair[~hit])),
                                  pa.ListArray.from_arrays(offsets, pa.array(times[~hit].astype(np.int32)))])

    parts = materialise(rows.select("row", "pairs", "times").mapInArrow(
        run, "row long, n_best long, count_sum long, pairs array<long>, times array<int>"), "alignment")
    rest = (parts.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
            .select("row", F.col("p.pairs").alias("pair"), F.col("p.times").cast("long").alias("times")).join(counts, "pair")
            .select("row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"),
                    (F.col("times") * F.col("n")).alias("count_sum")))
    sums = (parts.select("row", "n_best", "count_sum").union(rest)
            .groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    return rows.join(sums, "row")


def aligned(docs: DataFrame, folder: str = FOLDER, head_size: int = HEAD) -> DataFrame:
    """One row for each document: its counts, the digest of its groups, its
    distinct pairs with their occurrences, and the corpus-wide scores."""
    rows = materialise(encoded(docs, folder), "alignment")
    return scored(rows, materialise(pair_counts(rows), "alignment"), head_size)


def query(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return aligned(docs).select("doc_id", *COLUMNS, "n_best", "count_sum", "groups_sha256")


QUERIES = {"op13_cross_tokenizer_alignment": query}
ORACLE = {}
