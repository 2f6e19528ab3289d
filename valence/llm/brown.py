"""LM scoring with Brown class-based n-grams.

Every token belongs to a unit: each of the most frequent words is one, and all
other words share units by their last letters, so the units are few but cover
every token. Exchange clustering assigns the units to classes: each unit in
turn moves to the class that raises the likelihood of all adjacent pairs most.
Then all other words of PLACED_LEAST occurrences or more leave their shared
units: each moves by the same gain, from the counts of the classes beside it, to
a class of its own choice. The tasks know the less frequent ones by a hash.
Both steps keep only moves that raise the likelihood of the training part.
A word's probability is the smoothed transition from the class before it times
its emission from its own class; with even transitions this is the smoothed
word frequency (the base score).

Counts of words and of adjacent units run over the whole training part. The
most frequent words go to the tasks in one bounded table; all other tokens
meet their counts in a join by word.

Defined cases: null text is empty, and an empty text is one end token; without
training rows every token is unknown and the base score is 0; repeated rows
are scored each; rows with a null id train and are scored like others; very
long texts take one pass; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valence.llm.common import column, fold, largest, materialise, read_table, record, utf8

END = b""  # no word is empty
CORE = 767  # words that are units of their own
FORMS = 256  # units shared by other words
UNITS = 1 + CORE + FORMS
PLACED = 1 << 14  # further words whose contexts are counted in one table; those of the others are dealt out by word
PLACED_LEAST = 10  # occurrences such a word needs
SUFFIX = 3
CLASSES = 40
SWEEPS = 8
PULL = 10.0  # pseudo-counts of the class frequency in each transition
HEAD = 1 << 17  # words whose counts go to every task
HELD_WORDS = 300_000  # distinct words a task holds before it sends them on
HELD_PLACES = 1 << 22  # neighbours of words a task holds before it sends them on


def words(text: bytes) -> list[bytes]:
    return text.lower().split()


def word_counts(train: DataFrame) -> DataFrame:
    """``(word, n)`` over all texts, the end token included."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches):
        held: Counter = Counter()
        for b in batches:
            for t in utf8(b, "text"):
                held.update(words(t))
                held[END] += 1
                if len(held) > HELD_WORDS:
                    yield record(schema, [list(held), list(held.values())])
                    held.clear()
        yield record(schema, [list(held), list(held.values())])

    return train.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def form(word: bytes) -> int:
    return 1 + CORE + zlib.crc32(word[-SUFFIX:]) % FORMS


def units(text: bytes, known: dict[bytes, int]) -> list[int]:
    """Units of the words and of the end; ``known`` has those of frequent words."""
    ws = words(text)
    return [form(w) if (u := known.get(w, -1)) < 0 else u for w in ws] + [0]


@dataclass
class Rare:
    """Words whose units follow each other from ``first`` on, by sorted hashes."""

    hashes: np.ndarray
    first: int

    def find(self, ws: list[bytes]) -> np.ndarray:
        """Units of the words, those of their forms for words that are not among these."""
        if not len(self.hashes):
            return np.fromiter(map(form, ws), np.int64, len(ws))
        h = np.fromiter(map(xxhash.xxh64_intdigest, ws, repeat(42)), np.uint64, len(ws))
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        out = self.first + at
        other = np.flatnonzero(self.hashes[at] != h)
        out[other] = [form(ws[i]) for i in other.tolist()]
        return out


NO_WORDS = Rare(np.zeros(0, np.uint64), UNITS)


def sequences(batches, known: dict[bytes, int], rare: Rare, size: int = 1 << 19):
    """Units of successive tokens, end tokens at both ends, about ``size`` at a time."""
    def filled():
        out = np.array(seq, np.int64)
        other = np.flatnonzero(out < 0)
        out[other] = rare.find([held[i] for i in other.tolist()])
        return out

    for b in batches:
        seq, held = [0], [END]
        for t in utf8(b, "text"):
            ws = words(t)
            seq.extend(map(known.get, ws, repeat(-1)))
            seq.append(0)
            held += ws
            held.append(END)
            if len(seq) > size:
                yield filled()
                seq, held = [0], [END]
        yield filled()


def tally(train: DataFrame, known: dict[bytes, int], size: int, places, rare: Rare = NO_WORDS) -> np.ndarray:
    """How often each of ``size`` places is hit over all texts; ``places`` maps
    the units of successive tokens to places."""
    schema = pa.schema([("place", pa.int32()), ("n", pa.int64())])
    shared = train.sparkSession.sparkContext.broadcast((known, rare))

    def run(batches):
        total = np.zeros(size, np.int64)
        for u in sequences(batches, *shared.value):
            total += np.bincount(places(u), minlength=size)
        at = np.flatnonzero(total)
        for s in range(0, len(at), 1 << 17):
            part = at[s:s + (1 << 17)]
            yield record(schema, [part.astype(np.int32), total[part]])

    rows = (train.select("text").mapInArrow(run, "place int, n long")
            .groupBy("place").agg(F.sum("n").alias("n")).toArrow())  # size rows at most
    out = np.zeros(size)
    out[rows["place"].to_numpy()] = rows["n"].to_numpy()
    return out


def unit_pairs(train: DataFrame, known: dict[bytes, int]) -> np.ndarray:
    """Counts of adjacent units over all texts, UNITS x UNITS."""
    return tally(train, known, UNITS * UNITS, lambda u: u[:-1] * UNITS + u[1:]).reshape(UNITS, UNITS)


def class_pairs(train: DataFrame, known: dict[bytes, int], of: np.ndarray, classes: int, rare: Rare = NO_WORDS) -> np.ndarray:
    """Counts of adjacent classes over all texts."""
    return tally(train, known, classes * classes, lambda u: of[u[:-1]] * classes + of[u[1:]], rare).reshape(classes, classes)


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(table: np.ndarray) -> float:
    """What the class pairs add to the log-likelihood of the training part."""
    return _h(table).sum() - _h(table.sum(0)).sum() - _h(table.sum(1)).sum()


def best_class(table: np.ndarray, after: np.ndarray, before: np.ndarray, own: float, a: int) -> int:
    """The class to which a unit adds most; ``table`` is without it, ``a`` its
    class up to now, ``own`` how often it follows itself."""
    rows, cols = _h(table + after) - _h(table), _h(table + before[:, None]) - _h(table)
    d = np.diagonal(table)
    gain = (rows.sum(1) - np.diagonal(rows) + cols.sum(0) - np.diagonal(cols)
            + _h(d + after + before + own) - _h(d))
    # its neighbours' classes follow or lead it wherever it goes
    left, right = table.sum(1) + before, table.sum(0) + after
    gain -= (_h(left + after.sum() + own) - _h(left) + _h(right + before.sum() + own) - _h(right))
    b = int(np.argmax(gain))
    return a if gain[b] <= gain[a] + 1e-9 * abs(gain[a]) else b


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit, by exchange: the gain of a move is the change of
    the sum of h(pair counts) less h(class counts), h(x) = x log x."""
    n = len(pairs)
    order = np.argsort(-pairs.sum(0), kind="stable")
    of = np.empty(n, np.int64)
    of[order] = np.arange(n) % classes
    join = np.eye(classes)[of]
    table = join.T @ pairs @ join
    out, into = pairs.sum(1), pairs.sum(0)
    for _ in range(sweeps):
        moved = 0
        for w in order:
            if not out[w] and not into[w]:
                continue
            own = pairs[w, w]
            after = np.bincount(of, pairs[w], classes)
            before = np.bincount(of, pairs[:, w], classes)
            a = of[w]
            after[a] -= own
            before[a] -= own
            table[a] -= after
            table[:, a] -= before
            table[a, a] -= own
            b = best_class(table, after, before, own, a)
            table[b] += after
            table[:, b] += before
            table[b, b] += own
            of[w] = b
            moved += a != b
        if not moved:
            break
    return of


def place_words(table: np.ndarray, beside: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Class of each further word, from the classes ``beside`` it and the one
    it shares at the ``start``; all meet the same table. :func:`best_class` of
    many words at a time."""
    out = start.copy()
    for s in range(0, len(start), 128):
        after, before = beside[s:s + 128, 0], beside[s:s + 128, 1]
        a, r = start[s:s + 128], np.arange(len(after))
        rest = np.repeat(table[None], len(a), 0)
        rest[r, a] -= after
        rest[r, :, a] -= before
        h = _h(np.maximum(rest, 0, out=rest))
        rows, cols = _h(rest + after[:, None]) - h, _h(rest + before[:, :, None]) - h
        inner = lambda x: np.diagonal(x, axis1=1, axis2=2)
        gain = (rows.sum(2) - inner(rows) + cols.sum(1) - inner(cols)
                + _h(inner(rest) + after + before) - inner(h))
        left, right = rest.sum(2) + before, rest.sum(1) + after
        gain -= (_h(left + after.sum(1, keepdims=True)) - _h(left)
                 + _h(right + before.sum(1, keepdims=True)) - _h(right))
        b = gain.argmax(1)
        own = gain[r, a]
        out[s:s + 128] = np.where(gain[r, b] <= own + 1e-9 * np.abs(own), a, b)
    return out


def place_all(train: DataFrame, known: dict[bytes, int], rare: Rare, of: np.ndarray, table: np.ndarray) -> np.ndarray:
    """:func:`place_words` for all words whose unit is UNITS or more: ``of``, with
    their new classes. The tasks count the classes beside the ``known`` ones in
    a table, and send a byte for each class beside one of the ``rare``; both are
    dealt out by word."""
    classes, dense = len(table), rare.first - UNITS
    code = np.min_scalar_type(2 * classes - 1)
    shared = train.sparkSession.sparkContext.broadcast((known, rare, of))
    near = pa.schema([("word", pa.int32()), ("near", pa.binary())])

    def packed(word, ends, values):
        ends = pa.py_buffer(ends.astype(np.int32))
        return record(near, [word.astype(np.int32), pa.Array.from_buffers(pa.binary(), len(word), [None, ends, pa.py_buffer(values)])])

    def sent(word, beside):
        by = np.argsort(word, kind="stable")
        word, beside = word[by], beside[by]
        new = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, np.int64)
        return packed(word[new], np.append(new, len(word)) * code.itemsize, beside)

    def contexts(batches):
        known, rare, of = shared.value
        total, held, size = np.zeros((dense, 2 * classes), np.int64), [], 0
        for u in sequences(batches, known, rare):
            c, word = of[u].astype(code), u - UNITS
            first, second = word[:-1] >= 0, word[1:] >= 0
            word = np.concatenate((word[:-1][first], word[1:][second]))
            beside = np.concatenate((c[1:][first], c[:-1][second] + code.type(classes)))
            many = word < dense
            total += np.bincount(word[many] * 2 * classes + beside[many], minlength=total.size).reshape(total.shape)
            held.append((word[~many], beside[~many]))
            size += len(held[-1][0])
            if size > HELD_PLACES:
                yield sent(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if held:
            yield sent(*map(np.concatenate, zip(*held)))
        met = np.flatnonzero(total.any(1))
        yield packed(met, np.arange(len(met) + 1) * total.itemsize * 2 * classes, total[met])

    chosen = pa.schema([("word", pa.int32()), ("c", pa.int32())])

    def choose(batches):
        for b in batches:
            word, lists = column(b, "word").to_numpy(), column(b, "near")
            parts = lists.flatten()
            row = np.repeat(np.arange(len(word)), lists.value_lengths().to_numpy())
            many = word[row] < dense
            codes = parts.filter(pa.array(~many))
            row_of = np.repeat(row[~many], pc.binary_length(codes).to_numpy(zero_copy_only=False) // code.itemsize)
            at = row_of * 2 * classes + np.frombuffer(b"".join(codes.to_pylist()), code)
            beside = np.bincount(at, minlength=len(word) * 2 * classes).reshape(-1, 2 * classes)
            sums = np.frombuffer(b"".join(parts.filter(pa.array(many)).to_pylist()), np.int64).reshape(-1, 2 * classes)
            np.add.at(beside, row[many], sums)
            c = place_words(table, beside.reshape(-1, 2, classes).astype(float), shared.value[2][UNITS + word])
            yield record(chosen, [word, c.astype(np.int32)])

    got = (train.select("text").mapInArrow(contexts, "word int, near binary")
           .groupBy("word").agg(F.collect_list("near").alias("near"))
           .mapInArrow(choose, "word int, c int").toArrow())  # a row for each word
    out = of.copy()
    out[UNITS + got["word"].to_numpy()] = got["c"].to_numpy()
    return out


@dataclass
class Model:
    head: dict  # frequent word -> row of head_n and head_unit
    head_n: np.ndarray
    head_unit: np.ndarray
    rare: Rare  # words placed on their own that are known by hashes
    of: np.ndarray  # class of each unit, the words placed on their own included
    step: np.ndarray  # log10 of transition over class mass, by class before and class
    unknown: np.ndarray  # log10 probability of an unknown word, by class before
    end_n: int
    total: int
    types: int

    @property
    def base_mass(self) -> float:
        return self.total + 0.5 * (self.types + 1)


def rare_words(counts: DataFrame, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and the forms of all words of PLACED_LEAST occurrences or
    more that are not ``known``. Of words with equal hashes one is taken."""
    got = (counts.where((F.col("n") >= PLACED_LEAST) & (F.col("word") != F.lit(END)))
           .select(F.xxhash64("word").alias("h"), (F.crc32(F.substring("word", -SUFFIX, SUFFIX)) % FORMS).cast("int").alias("f"))
           .toArrow())  # twelve bytes for each such word
    h, at = np.unique(got["h"].to_numpy().view(np.uint64), return_index=True)
    f = 1 + CORE + got["f"].to_numpy().astype(np.int64)[at]
    new = ~np.isin(h, np.fromiter(map(xxhash.xxh64_intdigest, known, repeat(42)), np.uint64, len(known)))
    return h[new], f[new]


def fit(train: DataFrame, counts: DataFrame, classes: int = CLASSES) -> Model:
    total, types = counts.agg(F.sum("n"), F.count("*")).first()
    total, types = total or 0, types or 0
    end = counts.where(F.col("word") == F.lit(END)).select("n").first()
    head = (largest(counts.where(F.col("word") != F.lit(END)), "n", HEAD).toArrow().to_pandas()  # HEAD rows at most
            .sort_values(["n", "word"], ascending=[False, True], ignore_index=True))
    names = [bytes(w) for w in head.word]
    unit = np.array([1 + i if i < CORE else form(w) for i, w in enumerate(names)], np.int64)
    known = {w: int(u) for w, u in zip(names[:CORE], unit)}
    pairs = unit_pairs(train, known)
    of = exchange(pairs, classes)
    join = np.eye(classes)[of]
    table = join.T @ pairs @ join
    some = [i for i in range(CORE, min(len(names), CORE + PLACED)) if head.n[i] >= PLACED_LEAST]
    rare, forms = NO_WORDS, np.zeros(0, np.int64)
    if some:
        more = known | {names[i]: UNITS + k for k, i in enumerate(some)}
        others, their_forms = rare_words(counts, more)
        least = Rare(others, UNITS + len(some))
        wide = place_all(train, more, least, np.concatenate((of, of[unit[some]], of[their_forms])), table)
        after = class_pairs(train, more, wide, classes, least)
        if likelihood(after) > likelihood(table):
            known, of, table, rare, forms = more, wide, after, least, their_forms
            unit[some] = UNITS + np.arange(len(some))
            unit[CORE + len(some):] = rare.find(names[CORE + len(some):])
    # types of each class: the words known one by one, and the others by form
    by_form = (counts.where(F.col("word") != F.lit(END))
               .groupBy((F.crc32(F.substring("word", -SUFFIX, SUFFIX)) % FORMS).cast("int").alias("f"))
               .agg(F.count("*").alias("n")).collect())  # FORMS rows at most
    unit_types = np.zeros(len(of))
    for r in by_form:
        unit_types[1 + CORE + r.f] = r.n
    for w, u in known.items():
        unit_types[form(w)] -= 1
        unit_types[u] = 1
    np.subtract.at(unit_types, forms, 1)
    unit_types[rare.first:rare.first + len(forms)] = 1
    unit_types[0] = 1 if end else 0
    class_types = np.bincount(of, unit_types, classes)
    spare = (class_types + 1) / (class_types.sum() + classes)  # how classes share the one unknown type
    mass = table.sum(0) + 0.5 * class_types + 0.5 * spare
    step = (table + PULL * mass / mass.sum()) / (table.sum(1, keepdims=True) + PULL)
    return Model({w: i for i, w in enumerate(names)}, head.n.to_numpy(np.float64), unit, rare, of,
                 np.log10(step / mass), np.log10((step * (0.5 * spare / mass)).sum(1)),
                 end.n if end else 0, total, types)


def score(docs: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, n_tokens, n_known, base_score, score)`` for each row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    schema = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("word", pa.binary()), ("tf", pa.int64()),
                        ("known", pa.int64()), ("base", pa.float64()), ("step", pa.float64()), ("unknown", pa.float64())])

    def run(batches):
        from pyspark import TaskContext

        m, uid = shared.value, TaskContext.get().partitionId() << 40
        end_class, log_n = m.of[0], np.log10(m.head_n + 0.5)
        for b in batches:
            rows = []
            for doc_id, t in zip(column(b, "doc_id").to_pylist(), utf8(b, "text")):
                uid += 1
                ws = words(t)
                at = np.fromiter((m.head.get(w, -1) for w in ws), np.int64, len(ws))
                tail = np.flatnonzero(at < 0)
                cls = np.empty(len(ws) + 1, np.int64)
                cls[:-1] = m.of[m.head_unit[at]] if len(m.head_unit) else 0
                if len(tail):
                    cls[tail] = m.of[m.rare.find([ws[i] for i in tail.tolist()])]
                cls[-1] = end_class
                before = np.concatenate(([end_class], cls[:-1]))
                steps = m.step[before, cls]
                logs = log_n[at[at >= 0]].sum()
                # the end token is known whenever a row was trained on; without one it is unknown like all others
                base = logs + np.log10(m.end_n + 0.5)
                model_sum = logs + steps.sum() - steps[tail].sum()
                model_sum += np.log10(m.end_n + 0.5) if m.end_n else m.unknown[before[-1]] - steps[-1]
                rows.append((uid, doc_id, b" %d" % uid, len(ws) + 1, len(ws) - len(tail) + (m.end_n > 0), base, model_sum, None))
                found: dict = {}
                for i, s, x in zip(tail.tolist(), steps[tail].tolist(), m.unknown[before[tail]].tolist()):
                    old = found.get(w := ws[i])
                    found[w] = (old[0] + 1, old[1] + s, old[2] + x) if old else (1, s, x)
                rows += [(uid, None, w, n, None, None, s, x) for w, (n, s, x) in found.items()]
            yield record(schema, zip(*rows) if rows else [[]] * len(schema))

    parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "uid long, doc_id long, word binary, tf long, known long, base double, step double, unknown double")
    # one row for each document (its key, led by a blank, meets no word) and one for each of its rare words
    joined = parts.join(counts.withColumnRenamed("n", "c"), "word", "left")
    is_doc, logs = F.col("known").isNotNull(), F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    return (joined.select(
        "uid", "doc_id", F.when(is_doc, F.col("tf")).alias("n_tokens"),
        F.when(is_doc, F.col("known")).when(F.col("c").isNotNull(), F.col("tf")).otherwise(0).alias("n_known"),
        F.when(is_doc, F.col("base")).otherwise(logs).alias("base"),
        F.when(is_doc, F.col("step")).when(F.col("c").isNotNull(), logs + F.col("step")).otherwise(F.col("unknown")).alias("score"))
        .groupBy("uid").agg(F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"),
                            F.sum("n_known").alias("n_known"), F.sum("base").alias("base"), F.sum("score").alias("score"))
        .select("doc_id", "n_tokens", "n_known",
                (F.col("base") - F.col("n_tokens") * F.lit(float(np.log10(model.base_mass)))).alias("base_score"), "score"))


def brown_scores(train: DataFrame, docs: DataFrame) -> tuple[DataFrame, Model]:
    counts = materialise(word_counts(train), "brown")
    model = fit(train, counts)
    return score(docs, counts, model), model


def query(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    got, model = brown_scores(docs.where(fold("doc_id", 5) != 1), docs)
    return got.select("doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known",
                      F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score",
                      F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


QUERIES = {"op9_lm_scoring": query}
ORACLE = {}
