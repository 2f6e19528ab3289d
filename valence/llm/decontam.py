"""Benchmark decontamination through the CGK embedding.

Texts and benchmark items are normalised (ASCII lower case, whitespace runs to
one blank). Items longer than ``PIECE`` are cut into pieces of about that size,
so walks have a bounded length whatever the item's. Piece-sized windows start
at every word of a text and wherever a shared character 12-gram says that a
piece would begin, so text without blanks has windows too; those that share too
few 12-grams with the benchmark to be a likely copy are set aside. The CGK random
walk turns a window into a sequence in which a small edit distance is a small
Hamming distance, so keys of a few sampled positions, repeated over several
walks, meet the pieces' keys with a recall that is measured on edited items
when the keys are built. Every meeting is verified by the exact edit distance
of the whole item to its best place in the window's surroundings.

What the walks miss is found by parts: an item of n characters has n / 6 parts
of 6, and each edit spoils one of them at most, so a copy keeps a fifteenth of
n parts whole, none shifted against another by more than the edits. Every place
with so many parts of an item is verified likewise, so no copy is left out.

An item is found if the distance is at most a tenth of its length. Items of
``LEAST_CHARS`` to ``WALK_CHARS - 1`` characters are too short for 12-grams:
they are found where they stand unchanged, between word edges (within scripts
written without blanks, anywhere).

The benchmark goes to the tasks in blocks of at most ``BLOCK_BYTES`` of text;
a larger one is worked off block by block. Documents are never shuffled.

Defined cases: null and empty texts hold nothing; items that are null or
shorter than ``LEAST_CHARS`` after normalisation (single words that clean
texts hold as well) are no evidence and are ignored; equal items are all reported; repeated rows get equal results; a
document matching an item in several places reports the closest, then the
first; empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valence.llm.common import column, read_table, record, utf8

EDIT_RATE = 0.1
LEAST_CHARS = 5
WALK_CHARS = 24
PIECE = 256
GRAM = 12
RECALL = 0.95
CLASS_RATIO = 1.25  # item lengths within one class of windows
SAMPLES = 6  # positions in a key
KEYS = 8  # keys of one walk
MOST_WALKS = 12
BLOCK_BYTES = 4 << 20
BLOCK = 2048  # windows embedded at a time
FILTER_BITS = 22
SHARE = 10  # a window of the walks needs one shared gram for so many characters; a tenth edited at random leaves 2.8
ANCHORS = 1 << 14  # shared grams whose windows are listed at a time
PART = 6  # units of an item's parts
STRETCH = 1 << 16  # units of a text whose parts are met at a time


def normalise(text: bytes) -> str:
    return b" ".join(text.lower().split()).decode("utf-8", "replace")


def units(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-16-le", "surrogatepass"), "<u2")


def grams(u: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hash of the ``size`` code units from each position on."""
    if len(u) < size:
        return np.zeros(0, np.uint64)
    m = 0x9E3779B97F4A7C15
    powers = {}
    x, width, factor = u.astype(np.uint64), 1, m
    while width * 2 <= size:
        powers[width] = (x, factor)
        x = x[:-width] * np.uint64(factor) + x[width:]
        width, factor = width * 2, factor * factor % (1 << 64)
    # the hash of the widest power of two, then those of the rest's powers of two
    powers[width] = (x, factor)
    n, at, h = len(u) - size + 1, width, x
    h = h[:n]
    while at < size:
        w = 1 << ((size - at).bit_length() - 1)
        part, factor = powers[w]
        h = h * np.uint64(factor) + part[at:at + n]
        at += w
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def embed(windows: np.ndarray, steps: int, walk: int) -> np.ndarray:
    """CGK walk over rows of code units (0 beyond the end): at each step emit
    the unit under the pointer and move on if the bit hashed from (walk, step,
    unit) says so."""
    rows, at = np.arange(len(windows)), np.zeros(len(windows), np.int64)
    out = np.empty((steps, len(windows)), np.uint16)
    last = windows.shape[1] - 1
    factors = _mix(np.uint64(walk << 40) + np.arange(1, steps + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    for j in range(steps):
        out[j] = windows[rows, at]
        at += ((out[j].astype(np.uint64) + np.uint64(1)) * factors[j] >> np.uint64(63)).astype(np.int64)
        np.minimum(at, last, out=at)
    return out


def search(item: str, text: str, most: int) -> tuple[int, int, int] | None:
    """``(distance, start, end)`` of the best place of ``item`` in ``text`` if
    its edit distance is at most ``most`` (bit-parallel dynamic programme)."""
    at = text.find(item)
    if at >= 0:
        return 0, at, at + len(item)

    def columns(pattern, chars, free):
        n = len(pattern)
        full, top = (1 << n) - 1, 1 << (n - 1)
        where: dict = {}
        for i, c in enumerate(pattern):
            where[c] = where.get(c, 0) | 1 << i
        up, down, score = full, 0, n
        for c in chars:
            eq = where.get(c, 0)
            xv = eq | down
            xh = (((eq & up) + up) ^ up) | eq
            ph, mh = down | (full & ~(xh | up)), up & xh
            score += bool(ph & top) - bool(mh & top)
            ph = (ph << 1 | (not free)) & full
            mh = mh << 1 & full
            up, down = mh | (full & ~(xv | ph)), ph & xv
            yield score

    best, end = min(((s, i + 1) for i, s in enumerate(columns(item, text, True))), default=(most + 1, 0))
    if best > most:
        return None
    back = min((s, i + 1) for i, s in enumerate(columns(item[::-1], text[:end][::-1], False)))
    return best, end - back[1], end


@dataclass
class SizeClass:
    """Pieces of similar length: how far the walks go, where keys sample them,
    how many grams a window must share, and the pieces of each key."""

    low: int
    high: int
    need: int
    known: np.ndarray  # sorted gram hashes of the class's pieces, once for each place of a gram
    places: np.ndarray  # and those places
    samples: np.ndarray = None  # walks x KEYS x SAMPLES; none if they miss too many
    met: float = 0.0  # share of edited items that the walks found
    index: dict = field(default_factory=dict)  # key -> (item, place of the piece in the item)


@dataclass
class Parts:
    """The items' parts: sorted hashes, the item of each and its place there, and
    for each item how many parts a copy keeps and how far they may shift."""

    known: np.ndarray
    item: np.ndarray
    place: np.ndarray
    need: np.ndarray
    shift: np.ndarray
    marks: np.ndarray  # leading bits of the hashes


@dataclass
class Model:
    ids: list
    texts: list
    classes: list
    grams: list  # sorted gram hashes of each item
    marks: np.ndarray  # leading bits of all of them
    short: ahocorasick.Automaton | None  # items without walks
    parts: Parts

    def keys(self, c: SizeClass, windows: np.ndarray) -> np.ndarray:
        """``(key, window)``: 64-bit keys, different for each walk and sample."""
        out = []
        for w, places in enumerate(c.samples):
            e = embed(windows, int(c.samples.max()) + 1, w + 1).astype(np.uint64)
            for k, at in enumerate(places):
                h = np.full(len(windows), w * KEYS + k + 1, np.uint64)
                for j in at:
                    h = (h ^ e[j]) * np.uint64(0x9E3779B97F4A7C15)
                    h ^= h >> np.uint64(32)
                out.append(h)
        return np.stack(out)


def _member(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(x.shape, bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def _padded(rows: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.uint16)
    for i, r in enumerate(rows):
        out[i, :min(width - 1, len(r))] = r[:width - 1]
    return out


def _edited(u: np.ndarray, edits: int, rng) -> np.ndarray:
    out = u.tolist()
    for _ in range(edits):
        kind, at = rng.integers(3), rng.integers(len(out))
        if kind == 0:
            out[at] = 97 + int(rng.integers(26))
        elif kind == 1 and len(out) > 2:
            del out[at]
        else:
            out.insert(at, 97 + int(rng.integers(26)))
    return np.array(out, np.uint16)


def _pieces(u: np.ndarray) -> list[tuple[int, int]]:
    """``(start, end)`` of about equal pieces of PIECE units, cut at the last
    blank of a piece's last quarter where there is one."""
    n = max(1, round(len(u) / PIECE))
    cuts = [0]
    for k in range(1, n):
        end = k * len(u) // n
        blanks = np.flatnonzero(u[end - PIECE // 4:end] == 32)
        cuts.append(end - PIECE // 4 + int(blanks[-1]) + 1 if len(blanks) else end)
    return list(zip(cuts, [*cuts[1:], len(u)]))


def _part_table(texts: list[str], coded: list[np.ndarray]) -> Parts:
    starts, need, shift = [], [], []
    for s, u in zip(texts, coded):
        edits = int(EDIT_RATE * len(s))
        # a character of two units is not cut, so that an edit of it spoils one part only
        wide = u >> 10 == 0x37
        n = len(u) // (PART + bool(wide.any())) if len(u) >= WALK_CHARS else 0
        at = np.arange(n) * len(u) // max(1, n)
        starts.append(at + wide[at])
        need.append(n - edits)
        shift.append(edits * (1 + bool(wide.any())))
    item = np.repeat(np.arange(len(texts)), [len(at) for at in starts])
    place = np.concatenate([np.zeros(0, np.int64), *starts])
    known = np.concatenate([np.zeros(0, np.uint64), *(grams(u, PART)[at] for u, at in zip(coded, starts))])
    by = np.argsort(known, kind="stable")
    marks = np.zeros(1 << FILTER_BITS, bool)
    marks[known >> np.uint64(64 - FILTER_BITS)] = True
    return Parts(known[by], item[by], place[by], np.array(need, np.int64), np.array(shift, np.int64), marks)


def build(items: list[tuple[int, bytes | None]], recall: float = RECALL, seed: int = 11) -> Model:
    """Keys for one block of items; walks are added until the measured share
    of items found after a tenth of their characters was edited is ``recall``."""
    rows = [(i, s) for i, t in items if len(s := normalise(t or b"")) >= LEAST_CHARS]
    ids, texts = [i for i, _ in rows], [s for _, s in rows]
    coded = [units(s) for s in texts]
    rng = np.random.default_rng(seed)
    own_grams = [np.unique(grams(u)) for u in coded]
    marks = np.zeros(1 << FILTER_BITS, bool)
    same: dict = {}
    pieces = []  # (length, item, start)
    for i, u in enumerate(coded):
        if len(u) < WALK_CHARS:
            same.setdefault(texts[i], []).append(i)
            continue
        marks[own_grams[i] >> np.uint64(64 - FILTER_BITS)] = True
        pieces += [(b - a, i, a) for a, b in _pieces(u)]
    short = ahocorasick.Automaton() if same else None
    for text, equal in same.items():
        short.add_word(text, (len(text), equal))
    if short:
        short.make_automaton()
    model = Model(ids, texts, [], own_grams, marks, short, _part_table(texts, coded))
    pieces.sort()
    while pieces:
        low = pieces[0][0]
        part = [x for x in pieces if x[0] <= low * CLASS_RATIO]
        pieces = pieces[len(part):]
        cut = [coded[i][a:a + n] for n, i, a in part]
        g = [grams(u) for u in cut]
        known, places = np.concatenate(g), np.concatenate([np.arange(len(x)) for x in g])
        by = np.lexsort((places, known))
        known, places = known[by], places[by]
        new = np.concatenate(([True], (known[1:] != known[:-1]) | (places[1:] != places[:-1])))
        c = SizeClass(low, part[-1][0], max(3, low // SHARE), known[new], places[new])
        # twice as many steps as units read on average: all sampled places lie within the shortest piece
        c.samples = rng.integers(0, max(2, int(1.8 * low)), (MOST_WALKS, KEYS, SAMPLES))
        width = int(c.samples.max()) + 2
        own = model.keys(c, _padded(cut, width))
        trial = np.repeat(np.arange(len(part)), max(1, 200 // len(part)))
        changed = model.keys(c, _padded([_edited(cut[k], int(EDIT_RATE * len(cut[k])), rng) for k in trial], width))
        agree = (own[:, trial] == changed).reshape(MOST_WALKS, KEYS, -1).any(1)
        # an item is found by any of its pieces: the same trial of each counts once
        turn = np.arange(len(trial)) % max(1, 200 // len(part))
        _, whole = np.unique(np.stack(([part[k][1] for k in trial], turn)), axis=1, return_inverse=True)
        met = np.zeros((MOST_WALKS, whole.max() + 1), bool)
        for w in range(MOST_WALKS):
            np.logical_or.at(met[w], whole.ravel(), agree[w])
        met = np.logical_or.accumulate(met, axis=0).mean(1)
        model.classes.append(c)
        c.met = float(met[-1])
        if not (met >= recall).any():  # the walks miss too many: the items' parts find them all
            c.samples = None
            continue
        n = int(np.argmax(met >= recall)) + 1
        c.samples = c.samples[:n]
        for row in own[:n * KEYS]:
            for (_, i, a), k in zip(part, row.tolist()):
                c.index.setdefault(k, set()).add((i, a))
    return model


def _starts(c: SizeClass, at: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Where pieces of ``c`` would begin by each shared gram's place in them."""
    near = np.searchsorted(at, at + c.high) - np.searchsorted(at, at - c.high, "right") >= c.need
    at, g = at[near], g[near]
    out = [np.zeros(0, np.int64)]
    for b in range(0, len(at), ANCHORS):
        low = np.searchsorted(c.known, g[b:b + ANCHORS])
        n = np.searchsorted(c.known, g[b:b + ANCHORS], "right") - low
        of = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        out.append(np.unique(np.maximum(0, np.repeat(at[b:b + ANCHORS], n) - c.places[of])))
    return np.concatenate(out)


def _parted(a: str, b: str) -> bool:
    """Whether a word may end between two characters: one is no letter or
    digit, or belongs to a script that is written without blanks."""
    return not (a.isalnum() and b.isalnum()) or any(
        c >= "\u2e80" or "\u0e00" <= c <= "\u0eff" or "\u1000" <= c <= "\u109f" or "\u1780" <= c <= "\u17ff" for c in (a, b))


def _find_short(s: str, found: dict, model: Model) -> None:
    for last, (n, equal) in model.short.iter(s):
        a, b = last + 1 - n, last + 1
        if (a == 0 or _parted(s[a - 1], s[a])) and (b == len(s) or _parted(s[b - 1], s[b])):
            for i in equal:
                found.setdefault(i, (0, a, b))


def find(texts: list[bytes], model: Model) -> list[dict[int, tuple[int, int, int]]]:
    """For each text, the items it holds: index -> (distance, start, end)."""
    found: list[dict] = [{} for _ in texts]
    held = []  # texts with shared grams, and the running number of them
    coded = []
    for d, raw in enumerate(texts):
        s = normalise(raw)
        u = units(s)
        coded.append(u)
        if model.short:
            _find_short(s, found[d], model)
        g = grams(u)
        hit = model.marks[g >> np.uint64(64 - FILTER_BITS)] if len(g) else np.zeros(0, bool)
        at = np.flatnonzero(hit)
        if len(at):
            held.append((d, u, at, g[at], np.concatenate(([0], np.flatnonzero(u == 32) + 1))))
    for c in model.classes:
        if c.samples is None:
            continue
        index = np.array(sorted(c.index), np.uint64)
        waiting = []
        for d, u, all_at, all_g, words in held:
            own = _member(all_g, c.known)
            at, g = all_at[own], all_g[own]
            if len(at) >= c.need:
                starts = np.union1d(words, _starts(c, at, g))
                share = np.searchsorted(at, starts + c.high - GRAM + 1) - np.searchsorted(at, starts)
                waiting += [(d, u, all_at, all_g, p) for p in starts[share >= c.need].tolist()]
        width = int(c.samples.max()) + 2
        for b in range(0, len(waiting), BLOCK):
            block = waiting[b:b + BLOCK]
            keys = model.keys(c, _padded([u[p:p + width] for _, u, *_, p in block], width))
            for k, w in zip(*np.nonzero(_member(keys, index))):
                d, u, at, g, p = block[w]
                for i, a in c.index[int(keys[k, w])]:
                    _verify(found[d], i, model, c, u, at, g, max(0, p - a))
    for d, u in enumerate(coded):
        for i, p in _kept_parts(model, u):
            _look(found[d], i, model, u, p)
    return [{i: m for i, m in x.items() if not isinstance(i, tuple)} for x in found]


def _kept_parts(model: Model, u: np.ndarray) -> list[tuple[int, int]]:
    """``(item, place)``, each half an item from the next: where the text has as
    many parts of an item, shifted as little, as a copy keeps."""
    t, out = model.parts, []
    if not len(t.known):
        return out
    longest = max(map(len, model.texts)) * 4  # no copy has more units
    step = max(STRETCH, 2 * longest)
    g = grams(u, PART)
    marked = np.flatnonzero(t.marks[g >> np.uint64(64 - FILTER_BITS)])
    for s in range(0, len(u), step):  # a copy lies in one of the stretches, which overlap
        at = marked[np.searchsorted(marked, s):np.searchsorted(marked, s + step + longest)]
        low = np.searchsorted(t.known, g[at])
        n = np.searchsorted(t.known, g[at], "right") - low
        of = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        item, place = t.item[of], np.repeat(at, n) - t.place[of]
        many = np.bincount(item, minlength=len(t.need))[item] >= t.need[item]
        item, place = item[many], place[many]
        by = np.lexsort((place, item))
        item, place = item[by], place[by]
        span = len(u) + longest
        key = item * 2 * span + place + span  # a place is between -span and span, and a shift less than that
        enough = np.searchsorted(key, key + t.shift[item], "right") - np.arange(len(key)) >= t.need[item]
        half = np.array([len(x) // 2 for x in model.texts])[item[enough]]
        out += zip(item[enough].tolist(), (np.maximum(0, place[enough]) // half * half).tolist())
    return sorted(set(out))


def _verify(found: dict, i: int, model: Model, c: SizeClass, u, at, g, p: int) -> None:
    """:func:`_look`, if enough grams around ``p`` are the item's."""
    n = len(model.texts[i])
    a, b = np.searchsorted(at, (max(0, p - n // 2), p + 2 * n))
    if _member(g[a:b], model.grams[i]).sum() >= c.need:
        _look(found, i, model, u, p)


def _look(found: dict, i: int, model: Model, u: np.ndarray, p: int) -> None:
    """Look for item ``i`` around ``p`` and keep its best place in ``found``."""
    item, old = model.texts[i], found.get(i)
    n = len(item)
    if old and (old[0] == 0 or old[1] - n // 2 <= p < old[2]):
        return
    tried = found.setdefault(("tried", i), set())
    if p in tried:
        return
    tried.add(p)
    low, high = max(0, p - n // 2), p + 2 * n
    got = search(item, u[low:high].tobytes().decode("utf-16-le", "replace"), int(EDIT_RATE * n))
    if got:
        got = (got[0], low + got[1], low + got[2])
        found[i] = min(old, got) if old else got


def blocks(benchmark: DataFrame) -> list[list[tuple[int, bytes]]]:
    """The benchmark's rows in blocks of about BLOCK_BYTES of text."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    for i in range(n):
        part = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        rows = part.select("item_id", F.col("text").cast("binary").alias("text")).orderBy("item_id", "text").collect()
        yield [(r.item_id, r.text) for r in rows]


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, distance, start, end)`` for each document and item
    it holds; places are characters of the normalised text."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()),
                        ("start", pa.int64()), ("end", pa.int64())])
    spark = docs.sparkSession
    out = None
    for block in blocks(benchmark):
        shared = spark.sparkContext.broadcast(build(block))

        def run(batches, shared=shared):
            for b in batches:
                got = find(utf8(b, "text"), shared.value)
                ids = column(b, "doc_id").to_pylist()
                rows = [(i, shared.value.ids[k], *m) for i, x in zip(ids, got) for k, m in sorted(x.items())]
                yield record(schema, zip(*rows) if rows else [[]] * 5)

        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            run, "doc_id long, item_id long, distance int, start long, end long")
        out = part if out is None else out.union(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item."""
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(build(block))

        def run(batches, shared=shared):
            for b in batches:
                got = find(utf8(b, "text"), shared.value)
                yield b.filter(pa.array([not x for x in got], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def query(spark, sf_dir: str) -> DataFrame:
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {"op7_decontamination": query}
ORACLE = {}
