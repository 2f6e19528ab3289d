"""SimHash near-dedup with Golay-code fuzzy keys.

Each text becomes a 64-bit fingerprint: the bitwise majority of the XXH64
hashes of its word shingles. Fingerprints that differ in at most four bits are
linked; the result names each document's connected component.

The fingerprint is cut into segments A (23 bits), B (23) and C (18). Decoding
every word within one bit of a 23-bit segment to its Golay codeword gives one
to six 12-bit indices, and two segments that differ in at most two bits share
one of them, since a word half-way between them is within one bit of both.
With at most four differing bits (a, b, c by segment) one of these holds:

* c = 0: a <= 2 or b <= 2, so C and a Golay index of A or of B agree;
* c <= 2 and a = 0 or b = 0: A or B agrees, and one third of C;
* (2,1,1), (1,2,1), (1,1,2) and below: two segments with one error each, so
  two thirds of both agree;
* c >= 3: one of A and B agrees, and a half of the other.

Each case is a key of at least 27 agreeing bits. Rows are joined by key, and
each bucket's distinct fingerprints are verified by their exact bit distance.
A bucket yields a spanning forest of its links, never all pairs.

Defined cases: a text without words (null, empty, blanks) has fingerprint zero
and links like any other; repeated rows and copies share a fingerprint and so
a component; a row without id gets its group's component, or null if no member
has an id; an empty table gives an empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valence.llm.common import column, connected_components, materialise, read_table, record, utf8

SHINGLE = 4
MAX_BITS = 4
SEED = 42
CHUNK = 1 << 16  # shingles counted at a time, so that a very long text stays small

# fixed value: generator polynomial of the binary Golay code (23, 12)
GOLAY = 0b101011100011


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of ASCII-lower-cased UTF-8 text."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[:max(1, n - shingle + 1)].tolist()
    ends = ends[min(n, shingle) - 1:].tolist()
    digest, total, ones = xxhash.xxh64_intdigest, len(starts), np.zeros(64, np.int64)
    for at in range(0, total, CHUNK):
        h = np.array([digest(joined[s:e], SEED) for s, e in
                      zip(starts[at:at + CHUNK], ends[at:at + CHUNK])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` for every row; ``fp`` is the fingerprint as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in utf8(b, "text")], np.uint64)
            yield record(schema, [column(b, "doc_id").cast(pa.int64()), fps.view(np.int64)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, fp long")


@functools.cache
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """Parity of each 12-bit message, and the error pattern of each syndrome."""
    def remainder(v: np.ndarray) -> np.ndarray:
        v = v.copy()
        for bit in range(22, 10, -1):
            v = np.where(v >> bit & 1, v ^ (GOLAY << (bit - 11)), v)
        return v

    parity = remainder(np.arange(4096, dtype=np.int64) << 11)
    errors = np.zeros(2048, np.int64)
    single = [1 << i for i in range(23)]
    patterns = [0, *single,
                *(single[i] | single[j] for i in range(23) for j in range(i)),
                *(single[i] | single[j] | single[k] for i in range(23) for j in range(i) for k in range(j))]
    p = np.array(patterns, np.int64)
    errors[remainder(p)] = p
    return parity, errors


def decode(words: np.ndarray) -> np.ndarray:
    """12-bit index of the Golay codeword nearest to each 23-bit word."""
    parity, errors = _golay()
    return (words ^ errors[(words & 2047) ^ parity[words >> 11]]) >> 11


def golay_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, index)``: the distinct indices of all words within one bit."""
    flips = np.concatenate(([0], 1 << np.arange(23, dtype=np.int64)))
    near = np.sort(decode(words[:, None] ^ flips), axis=1)
    first = np.ones(near.shape, bool)
    first[:, 1:] = near[:, 1:] != near[:, :-1]
    rows, cols = np.nonzero(first)
    return rows, near[rows, cols]


def _cut(low: int, sizes: tuple[int, ...]) -> list[int]:
    out = []
    for s in sizes:
        out.append(((1 << s) - 1) << low)
        low += s
    return out


@functools.cache
def _masks() -> tuple[int, ...]:
    """The bits that must agree, for each case but the Golay ones."""
    (a, b, c), a3, b3 = _cut(0, (23, 23, 18)), _cut(0, (8, 8, 7)), _cut(23, (8, 8, 7))
    c3, a2, b2 = _cut(46, (6, 6, 6)), _cut(0, (12, 11)), _cut(23, (12, 11))
    return (*(s | x for s in (a, b) for x in c3),
            *((s ^ x) | (t ^ y) for s, xs, t, ys in ((b, b3, c, c3), (a, a3, c, c3), (a, a3, b, b3))
              for x in xs for y in ys),
            *(b | x for x in a2), *(a | x for x in b2))


def _mix(v: np.ndarray, kind: int) -> np.ndarray:
    """A 64-bit key; keys of different kinds meet only by chance."""
    v = v + np.uint64((kind + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, key)`` of unsigned fingerprints: all keys of each."""
    rows, out = [], []
    every = np.arange(len(fps))
    for kind, mask in enumerate(_masks()):
        rows.append(every)
        out.append(_mix(fps & np.uint64(mask), kind))
    for kind, shift in ((100, 0), (101, 23)):
        r, g = golay_keys(((fps >> np.uint64(shift)) & np.uint64((1 << 23) - 1)).astype(np.int64))
        rows.append(r)
        out.append(_mix((g.astype(np.uint64) << np.uint64(18)) | (fps[r] >> np.uint64(46)), kind))
    return np.concatenate(rows), np.concatenate(out)


def spanning_links(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between distinct fingerprints. Each
    found member leaves the open set at once, so a dense group costs little
    more than one pass over it."""
    left, right, unseen = [], [], fps
    while len(unseen):
        queue, unseen = [unseen[0]], unseen[1:]
        while queue and len(unseen):
            f = queue.pop()
            near = np.bitwise_count(unseen ^ f) <= max_bits
            if near.any():
                found = unseen[near]
                unseen = unseen[~near]
                queue.extend(found)
                left.append(np.full(len(found), f, np.uint64))
                right.append(found)
    none = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _bucket_links(batches, max_bits: int):
    """Links within each run of equal keys; rows come sorted by key."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    held: list[tuple[np.ndarray, np.ndarray]] = []  # rows of the key that is still open

    def closed(key, fp):
        edge = np.flatnonzero(np.diff(key)) + 1
        start = np.concatenate(([0], edge))
        size = np.diff(np.concatenate((start, [len(key)])))
        two = start[size == 2]
        a, b = fp[two], fp[two + 1]
        near = np.bitwise_count(a ^ b) <= max_bits
        out = [(a[near], b[near])]
        for s, n in zip(start[size > 2].tolist(), size[size > 2].tolist()):
            out.append(spanning_links(np.unique(fp[s:s + n]), max_bits))
        a, b = (np.concatenate(x) for x in zip(*out))
        pairs = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1), axis=0)
        return record(schema, [np.ascontiguousarray(pairs[:, i]).view(np.int64) for i in (0, 1)])

    for batch in batches:
        if not batch.num_rows:
            continue
        key = column(batch, "key").to_numpy()
        fp = column(batch, "fp").to_numpy().view(np.uint64)
        if key[0] == key[-1]:
            if held and held[0][0][0] != key[0]:
                yield closed(*(np.concatenate(x) for x in zip(*held)))
                held = []
            held.append((key, fp))
            continue
        last = int(np.searchsorted(key, key[-1]))
        held.append((key[:last], fp[:last]))
        yield closed(*(np.concatenate(x) for x in zip(*held)))
        held = [(key[last:], fp[last:])]
    if held:
        yield closed(*(np.concatenate(x) for x in zip(*held)))


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)``: enough links between distinct fingerprints ``fp`` to connect
    all that differ in at most ``max_bits`` bits."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the keys cover bit distances of 0 to 4")
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])

    def emit(batches):
        for b in batches:
            every = column(b, "fp").to_numpy().view(np.uint64)
            for at in range(0, len(every), 4096):
                fps = every[at:at + 4096]
                rows, ks = keys(fps)
                yield record(schema, [ks.view(np.int64), fps[rows].view(np.int64)])

    return (distinct.select("fp").mapInArrow(emit, "key long, fp long")
            .repartition("key").sortWithinPartitions("key")
            .mapInArrow(lambda it: _bucket_links(it, max_bits), "a long, b long").distinct())


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fp, root, component_id)``, one row for each row of ``docs``;
    ``root`` is a fingerprint that names the component."""
    prints = materialise(fingerprints(docs, shingle), "simhash")
    # copies of any number become one row before anything is shuffled by key
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = connected_components(links(distinct, max_bits))
    linked = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    linked = materialise(linked, "simhash")
    least = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    component = linked.join(least, "root").select("fp", "root", "component_id")
    return prints.join(component, "fp").select("doc_id", "fp", "root", "component_id")


def _with_text(batches, shingle: int):
    """``(doc_id, text, fp)`` of distinct texts."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("fp", pa.int64())])
    for b in batches:
        fps = np.array([fingerprint(t, shingle) for t in utf8(b, "text")], np.uint64)
        yield record(schema, [column(b, "doc_id"), column(b, "text"), fps.view(np.int64)])


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: of each component the row
    with the smallest id (of rows that share it, the one with the smallest
    text). A row without an id cannot be told from others and stays."""
    found = materialise(simhash_components(docs, shingle, max_bits), "simhash")
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti")
    # ids with several rows: what becomes of a row depends on its fingerprint
    again = materialise(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
                        .select("doc_id"), "simhash")
    if again.isEmpty():
        return kept.select(docs.columns)
    # such rows travel in one struct, so none of their columns can meet a name used here
    rows = docs.join(again, "doc_id", "left_semi").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.struct(*docs.columns).alias("row"))
    texts = rows.select("doc_id", "text").distinct()
    prints = texts.mapInArrow(functools.partial(_with_text, shingle=shingle), "doc_id long, text string, fp long")
    stays = found.where("doc_id = component_id").select("doc_id", "fp", "root").distinct()
    least = prints.join(stays, ["doc_id", "fp"]).groupBy("doc_id", "root").agg(F.min("text").alias("text"))
    # equal texts of one id become one row before the shuffle
    shared = (rows.join(least, ["doc_id", "text"], "left_semi")
              .groupBy("doc_id", "text").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*"))
    return kept.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(shared)


def query(spark, sf_dir: str) -> DataFrame:
    result = simhash_components(read_table(spark, sf_dir, "documents"))
    return result.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op10_simhash_near_dedup": query}
ORACLE = {}
