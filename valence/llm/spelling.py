"""Spelling variants by a trie of letter-group counts.

A word's counts of the letter groups, one level for each group, are its path
in a trie. Words that differ by one code point differ by at most one surplus
and one deficit along that path, so a depth-first search that may spend one of
each reaches every near word; the words at the leaves are compared letter by
letter. Of each pair only one word searches: the shorter for the longer, or
the one whose first differing level is a surplus in the other (with equal
counts, the smaller).

The upper levels of the trie are dealt out by Spark: a word is stored in the
cell of its counts of the first groups and searches the cells within the
budget. Cells that would get more than ``CELL_ROWS`` rows are dealt out again
by more levels; those that are too large with all levels are cut into tiles of
searching words. Each cell holds its stored words in one task and streams the
others past them.

Defined cases: null and empty texts hold no word; a null id counts as empty
text in the hash that deletes letters; rows are counted as they come, repeated
ones too; ties between forms go to the smaller word in code-point order; very
long words are compared like others; columns other than ``doc_id`` and ``text``
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valence.llm.common import column, materialise, read_table, record, utf8

# code points U+00C0 to U+00FF are the bytes C3 80 to C3 BF of UTF-8
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
DELETE_EACH = 97
LEAST_CHARS = 5
LEAST_COUNT = 3
FORM_TIMES = 2
HELD_WORDS = 200_000  # a task sends its counts on beyond so many words

#: Letter groups, one trie level each, frequent letters first; all other letters are the last group.
GROUPS = ("e", "t", "a", "o", "i", "n", "s", "h", "r", "d", "l", "c", "u", "m", "wf", "gy", "pb", "vk", "jxqz")
LEVELS = len(GROUPS) + 1
DEPTHS = (6, 10, 14, LEVELS)  # levels by which cells are dealt out
CELL_ROWS = 32_768
FRONT = 1 << 17  # search states held at once
CELLS = 1 << 22  # letters compared at once
_GROUP = np.full(256, LEVELS - 1)
for _i, _letters in enumerate(GROUPS):
    _GROUP[list(_letters.encode())] = _i
# odd multipliers that turn the counts of the levels into one number
_FACTORS = np.random.default_rng(12).integers(1 << 62, size=LEVELS).astype(np.uint64) * np.uint64(2) + np.uint64(1)

ENTRY = pa.schema([("cell", pa.int64()), ("role", pa.int8()), ("word", pa.string()), ("n", pa.int64())])
ENTRY_DDL = "cell long, role byte, word string, n long"
STORED, SEARCHING = 0, 1


def document_words(doc: bytes, text: bytes, delete_each: int = DELETE_EACH) -> Counter:
    """The words of one text with their counts; ``doc`` is the id as text."""
    out: Counter = Counter()
    start = zlib.crc32(doc + b":")
    for word, n in Counter(RUN.findall(text.translate(LOWER))).items():
        h = zlib.crc32(word, start)
        word = word.decode()
        if h % delete_each == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        if len(word) >= LEAST_CHARS:
            out[word] += n
    return out


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT, delete_each: int = DELETE_EACH) -> DataFrame:
    """``(word, n)`` of the words with ``least`` occurrences or more."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        held: Counter = Counter()
        for b in batches:
            for doc, text in zip(utf8(b, "doc"), utf8(b, "text")):
                held.update(document_words(doc, text, delete_each))
                if len(held) > HELD_WORDS:
                    yield record(schema, [list(held), list(held.values())])
                    held.clear()
        if held:
            yield record(schema, [list(held), list(held.values())])

    return (docs.select(F.col("doc_id").cast("string").alias("doc"), "text").mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


class Words:
    """Words as one array of letters, with their letter-group counts."""

    def __init__(self, words: list[str]):
        raw = [w.encode("latin-1") for w in words]  # the letters are all below U+0100
        self.size = np.fromiter(map(len, raw), np.int64, len(raw))
        self.start = np.cumsum(self.size) - self.size
        self.letters = np.frombuffer(b"".join(raw), np.uint8)
        at = np.repeat(np.arange(len(raw)), self.size) * LEVELS + _GROUP[self.letters]
        self.counts = np.bincount(at, minlength=len(raw) * LEVELS).reshape(len(raw), LEVELS)

    def block(self, at: np.ndarray, width: int) -> np.ndarray:
        """Letters of the words ``at``, filled up with zeros."""
        col = np.arange(width)
        place = self.start[at, None] + col
        return np.where(col < self.size[at, None], self.letters[np.minimum(place, len(self.letters) - 1)], 0)


def entries(words: DataFrame, depth: int, before: int = 0) -> DataFrame:
    """``(cell, role, word, n)``: each word once as stored and once for each
    cell that it searches, by the counts of the first ``depth`` groups. With
    ``before``, ``words`` are entries by so many groups, which are dealt out
    further."""
    pairs = [(i, j) for i in range(depth) for j in range(i + 1, depth)]
    up, down = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))

    def moved(levels: int, counts: np.ndarray) -> np.ndarray:
        """For each word the cells of its own counts, of one more in a group,
        and of one more in a group and one less in a later one."""
        f = np.where(np.arange(LEVELS) < levels, _FACTORS, np.uint64(0))
        own = (counts.astype(np.uint64) * f).sum(1)[:, None]
        return np.concatenate([own, own + f[None, :depth], own + (f[up] - f[down])[None, :]], 1)

    def run(batches):
        for batch in batches:
            step = max(1, (1 << 19) // (1 + depth + len(pairs)))
            for b in (batch.slice(i, step) for i in range(0, batch.num_rows, step)):
                texts, n = column(b, "word"), column(b, "n").to_numpy()
                counts = Words(texts.to_pylist()).counts
                cells = moved(depth, counts)
                keep = np.ones(cells.shape, bool)
                keep[:, 1 + depth:] = counts[:, down] > 0
                stored = np.ones(len(n), bool)
                if before:
                    stored = column(b, "role").to_numpy() == STORED
                    keep &= moved(before, counts) == column(b, "cell").to_numpy().view(np.uint64)[:, None]
                    keep &= ~stored[:, None]
                s, (q, k) = np.flatnonzero(stored), np.nonzero(keep)
                at = np.concatenate([s, q])
                yield record(ENTRY, [np.concatenate([cells[s, 0], cells[q, k]]).view(np.int64),
                                     np.repeat(np.array([STORED, SEARCHING], np.int8), [len(s), len(q)]),
                                     texts.take(pa.array(at)), n[at]])

    return words.mapInArrow(run, ENTRY_DDL)


class Trie:
    """Trie of the stored words: at each level the children's keys, sorted.
    Words with equal counts are neighbours in ``order``."""

    def __init__(self, words: Words):
        self.words = words
        self.order = np.lexsort(words.counts.T[::-1])
        counts = words.counts[self.order]
        self.width = int(counts.max()) + 3
        self.keys = []
        node = np.zeros(len(counts), np.int64)
        for level in range(LEVELS):
            key = node * self.width + counts[:, level]
            new = np.concatenate(([True], key[1:] != key[:-1]))
            self.keys.append(key[new])
            node = np.cumsum(new) - 1
        self.first = np.append(np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1]))), len(node))

    def _child(self, level: int, node: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = node * self.width + count
        at = np.minimum(np.searchsorted(self.keys[level], key), len(self.keys[level]) - 1)
        return at, (self.keys[level][at] == key) & (count >= 0) & (count < self.width)

    def search(self, counts: np.ndarray):
        """``(query, stored word)`` pairs whose counts differ by nothing, one
        surplus, or one surplus and a later deficit, in blocks. The search goes
        depth-first over blocks of states; ``spent`` is 0, 1 or 2."""
        zero = np.zeros(len(counts), np.int64)
        stack = [(0, np.arange(len(counts)), zero, zero)]
        while stack:
            level, query, node, spent = stack.pop()
            if len(query) > FRONT:
                half = len(query) // 2
                stack += [(level, query[half:], node[half:], spent[half:]), (level, query[:half], node[:half], spent[:half])]
            elif level == LEVELS:
                size = self.first[node + 1] - self.first[node]
                ends = np.cumsum(size)
                yield np.repeat(query, size), self.order[
                    np.repeat(self.first[node] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
            else:
                found = []
                for change, at in ((0, slice(None)), (1, spent == 0), (-1, spent == 1)):
                    q, s = query[at], spent[at]
                    child, there = self._child(level, node[at], counts[q, level] + change)
                    found.append((q[there], child[there], (s + abs(change))[there]))
                stack.append((level + 1, *map(np.concatenate, zip(*found))))


def near(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether word ``j`` of ``b`` is word ``i`` of ``a`` with one code point
    replaced or inserted."""
    out = np.zeros(len(i), bool)
    order = np.argsort(b.size[j], kind="stable")
    at = 0
    while at < len(order):
        # words of like length together; a long one does not widen the others
        width = int(b.size[j[order[at]]])
        stop = int(np.searchsorted(b.size[j[order]], width, "right"))
        step = max(1, CELLS // max(1, width))
        for part in (order[k:min(k + step, stop)] for k in range(at, stop, step)):
            x, y = a.block(i[part], width), b.block(j[part], width)
            differ = x != y
            one = (a.size[i[part]] == width) & (differ.sum(1) == 1)
            # inserted: the letters before the first difference agree, those after it are shifted by one
            shifted = x[:, :-1] != y[:, 1:]
            # one past the last difference
            last = np.where(shifted.any(1), width - 1 - shifted[:, ::-1].argmax(1), 0) if width > 1 else np.zeros(len(part))
            out[part] = one | ((a.size[i[part]] == width - 1) & (differ.argmax(1) >= last))
        at = stop
    return out


def _found(cells: DataFrame, keys: list[str]) -> DataFrame:
    """``(a, na, b, nb)``: near words within cells, each pair once."""
    schema = pa.schema([("a", pa.string()), ("na", pa.int64()), ("b", pa.string()), ("nb", pa.int64())])

    def run(batches):
        current, stored, trie, words = None, [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([column(batch, k).to_numpy().astype(np.int64) for k in keys], 1)
            role = column(batch, "role").to_numpy()
            edges = np.flatnonzero((ids[1:] != ids[:-1]).any(1) | (role[1:] != role[:-1])) + 1
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(ids)]):
                if current != tuple(ids[s]):
                    current, stored, trie = tuple(ids[s]), [], None
                part = batch.slice(s, e - s)
                if role[s] == STORED:
                    stored.append(part)
                    continue
                if not stored:
                    continue  # nobody to meet in this cell
                if trie is None:
                    words = pa.Table.from_batches(stored).combine_chunks()
                    trie = Trie(Words(words["word"].to_pylist()))
                asking, texts, n = column(part, "word"), words["word"].combine_chunks(), words["n"].combine_chunks()
                queries = Words(asking.to_pylist())
                for i, j in trie.search(queries.counts):
                    ok = near(queries, i, trie.words, j)
                    i, j = pa.array(i[ok]), pa.array(j[ok])
                    u, v = asking.take(i), texts.take(j)
                    out = pa.table([u, column(part, "n").take(i), v, n.take(j)], schema=schema)
                    # words of equal counts find each other: the smaller one's pair stays
                    same = np.array([len(x) == len(y) and x > y and sorted_groups(x) == sorted_groups(y)
                                     for x, y in zip(u.to_pylist(), v.to_pylist())], bool)
                    yield from out.filter(pa.array(~same)).combine_chunks().to_batches()

    return (cells.repartition(*keys).sortWithinPartitions(*keys, "role")
            .mapInArrow(run, "a string, na long, b string, nb long"))


def sorted_groups(word: str) -> list[int]:
    return sorted(_GROUP[list(word.encode("latin-1"))].tolist())


def near_pairs(words: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(a, na, b, nb)``: all pairs of ``words(word, n)`` that differ by one
    inserted, deleted or replaced code point, each once."""
    pairs = None
    rows, before = words, 0
    for depth in DEPTHS:
        cells = materialise(entries(rows, depth, before), "spelling")
        # cells that store no word are asked in vain
        held = cells.groupBy("cell").agg(F.count("*").alias("rows"), F.min("role").alias("least")).where(f"least = {STORED}")
        large = materialise(held.where(F.col("rows") > cell_rows).select("cell", "rows"), "spelling")
        some = large.count() > 0
        rest = cells.join(large, "cell", "left_anti") if some else cells
        found = _found(rest, ["cell"])
        pairs = found if pairs is None else pairs.union(found)
        if not some:
            return pairs
        rows, before = cells.join(large, "cell", "left_semi"), depth
    # cells of equal counts in all groups: every tile stores all its words and asks a part of the others
    tiles = F.ceil(F.col("rows") / cell_rows).cast("int")
    tiled = cells.join(large, "cell").withColumn("tile", F.explode(
        F.when(F.col("role") == STORED, F.sequence(F.lit(0), tiles - 1)).otherwise(F.array(F.pmod(F.xxhash64("word"), tiles).cast("int")))))
    return pairs.union(_found(tiled.drop("rows"), ["cell", "tile"]))


def variants(words: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every row of ``words(word, n)``."""
    both = near_pairs(words, cell_rows).select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("other_n")))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"),
                                    F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    takes = -F.col("best.less") >= FORM_TIMES * F.col("n")
    out = materialise(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("best.other")).alias("form"), F.when(takes, -F.col("best.less")).alias("form_n")), "spelling")
    # a form is FORM_TIMES as frequent as its word, which bounds the steps to the root; each round doubles them
    most = out.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.floor(math.log(most, FORM_TIMES)))
    roots = out.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        roots = materialise(roots, "spelling")
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return (out.join(materialise(roots, "spelling"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants(materialise(vocabulary(docs), "spelling"))


QUERIES = {"op12_spelling_variants": query}
ORACLE = {}
