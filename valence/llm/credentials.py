"""Secret scans by grammar inference.

Three patterns give the base spans. Their values are the labelled credentials:
for each kind a prefix tree of them is folded into a probabilistic automaton by
merging states whose symbol frequencies agree within Hoeffding's bound, each
new state joining the compatible one that makes its symbols likeliest. Further
runs of credential characters are candidates. A candidate becomes a span of
kind ``format`` if its likelihood as a credential exceeds that as ordinary text
by ``LEAST_GAIN`` nats and is no lower, symbol by symbol, than that of all but
``ATYPICAL`` of the labelled credentials which the automaton has not seen.
Ordinary text is a chain of its symbols, counted over all documents.

An automaton is fitted on at most ``FIT_VALUES`` distinct values of its kind,
taken by hash from all documents; the chain, base spans, candidates and scores
cover every whole text.

Defined cases: null and empty texts have no spans; a row without an id is
scanned like any other; repeated rows get equal results and their values count
once; kinds with fewer than ``LEAST_VALUES`` values have no automaton; values
over ``LONGEST`` code points are scored but not learned from; ties between
automata go to the kind listed first; columns of ``docs`` other than ``doc_id``
and ``text`` are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import string
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valence.llm.common import column, materialise, read_table, record, utf8

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_CHARS = 6
# runs of 20 and 24: a maximal run that is shorter fails as a whole
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "format")  # the order of spans that start together

RUN_CHARS = 16
RUN = re.compile(r"[A-Za-z0-9+/_.-]{%d,}={0,2}" % RUN_CHARS)
_IN_RUN = (string.ascii_letters + string.digits + "+/_.-").encode()
_SPLIT = bytes(c if c in _IN_RUN else 32 for c in range(256))  # everything but run characters becomes a blank

FIT_VALUES = 2_000
LEAST_VALUES = 20
LONGEST = 256
ALPHA = 0.01  # of the Hoeffding bound
SMOOTH = 1.0  # symbols of each state that are spread over the classes it has seen
#: Symbols that stand for each other where few have been seen; any others are each a class of their own or, outside runs, one together.
CLASSES = (string.digits, string.ascii_lowercase, string.ascii_uppercase, *"+/_.=-")
OTHERS = 64  # symbols that the class of all others is taken to have
LEAST_GAIN = 12.0
ATYPICAL = 0.02
HELD_VALUES = 50_000  # a task sends its distinct values on beyond so many


_CLASS = {c: i for i, chars in enumerate(CLASSES) for c in chars}
_SIZES = [*map(len, CLASSES), OTHERS]


def _class(symbol: str) -> int:
    return _CLASS.get(symbol, len(CLASSES))


def smoothed(counts: Counter) -> tuple[dict[str, float], list[float]]:
    """Log probabilities of the symbols counted, and of one not counted in each
    class; SMOOTH symbols are spread over the classes as those counted are."""
    n, per = counts.total(), [1 / len(_SIZES)] * len(_SIZES)
    for c, k in counts.items():
        per[_class(c)] += k
    spread = [SMOOTH * k / (n + 1) / size for k, size in zip(per, _SIZES)]
    return ({c: math.log((k + spread[_class(c)]) / (n + SMOOTH)) for c, k in counts.items()},
            [math.log(x / (n + SMOOTH)) for x in spread])


@dataclass(frozen=True)
class Automaton:
    """States as ``symbol -> (log probability, next state)``; a symbol that a
    state has not seen has its class's entry in ``unseen``, which leads where
    most symbols of the class do, or back to the state. Lengths have a
    histogram of their own, since merged states forget how long a format is."""
    steps: list[dict[str, tuple[float, int]]]
    unseen: list[list[tuple[float, int]]]
    lengths: dict[int, float]
    no_length: float

    def score(self, value: str) -> float:
        """Log-likelihood of the value."""
        total, state = self.lengths.get(len(value), self.no_length), 0
        for c in value:
            cost, state = self.steps[state].get(c) or self.unseen[state][_class(c)]
            total += cost
        return total


@dataclass(frozen=True)
class Chain:
    """Ordinary text: the log probability of each symbol after the one before;
    a blank stands before and after every run."""
    after: dict[str, tuple[dict[str, float], list[float]]]

    def score(self, value: str) -> float:
        total, before = 0.0, " "
        for c in value + " ":
            seen, unseen = self.after.get(before) or self.after.setdefault(before, smoothed(Counter()))
            total += seen[c] if c in seen else unseen[_class(c)]
            before = c
        return total


def chain(pairs: dict[str, int]) -> Chain:
    """The chain of counted pairs of symbols."""
    after: dict[str, Counter] = {}
    for (before, c), n in pairs.items():
        after.setdefault(before, Counter())[c] += n
    return Chain({c: smoothed(k) for c, k in after.items()})


class _Tree:
    """Prefix tree with counts, folded in place."""

    def __init__(self, values: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.counts: list[Counter] = [Counter()]
        for v in values:
            at = 0
            for c in v:
                self.counts[at][c] += 1
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.counts.append(Counter())
                at = self.children[at][c]

    def agree(self, p: int, q: int) -> bool:
        """Whether the states, and those reached from them by equal symbols,
        have frequencies within the bound; q is the root of a tree."""
        width = math.sqrt(0.5 * math.log(2 / ALPHA))
        stack = [(p, q)]
        while stack:
            p, q = stack.pop()
            cp, cq = self.counts[p], self.counts[q]
            np_, nq = cp.total(), cq.total()
            if not np_ or not nq:
                continue
            most = width * (1 / math.sqrt(np_) + 1 / math.sqrt(nq))
            if most < 1 and any(abs(cp[c] / np_ - cq[c] / nq) > most for c in cp.keys() | cq.keys()):
                return False
            down = self.children[q]
            stack.extend((n, down[c]) for c, n in self.children[p].items() if c in down)
        return True

    def fit(self, p: int, q: int) -> float:
        """Log-likelihood of q's next symbols in state p."""
        seen, unseen = smoothed(self.counts[p])
        return sum(k * (seen[c] if c in seen else unseen[_class(c)]) for c, k in self.counts[q].items())

    def fold(self, p: int, q: int) -> None:
        """Add the tree below q to state p."""
        stack = [(p, q)]
        while stack:
            p, q = stack.pop()
            self.counts[p].update(self.counts[q])
            up = self.children[p]
            for c, n in self.children[q].items():
                if c in up:
                    stack.append((up[c], n))
                else:
                    up[c] = n


def infer(values: list[str]) -> Automaton:
    """The automaton of a list of values."""
    tree = _Tree(values)
    states, known = [0], {0}
    while True:
        # the most frequent state that is reached from a kept one and not kept itself
        fringe = [(tree.counts[p][c], -p, c) for p in states for c, n in tree.children[p].items() if n not in known]
        if not fringe:
            break
        _, p, c = max(fringe)
        q = tree.children[-p][c]
        same = [s for s in states if tree.agree(s, q)]
        if same:
            best = max(same, key=lambda s: tree.fit(s, q))
            tree.children[-p][c] = best
            tree.fold(best, q)
        else:
            states.append(q)
            known.add(q)
    place = {s: i for i, s in enumerate(states)}
    steps, unseen = [], []
    for s in states:
        seen, others = smoothed(tree.counts[s])
        steps.append({c: (p, place[tree.children[s][c]]) for c, p in seen.items()})
        to: list[Counter] = [Counter() for _ in others]
        for c, k in tree.counts[s].items():
            to[_class(c)][place[tree.children[s][c]]] += k
        unseen.append([(p, max(t, key=lambda x: (t[x], -x)) if t else place[s]) for p, t in zip(others, to)])
    lengths, n = Counter(map(len, values)), len(values) + 1
    return Automaton(steps, unseen, {k: math.log((v + 1 / LONGEST) / n) for k, v in lengths.items()}, math.log(1 / LONGEST / n))


@dataclass(frozen=True)
class Model:
    """For each kind its automaton and the least likelihood of a symbol, and
    ordinary text."""
    kinds: tuple[tuple[str, Automaton, float], ...]
    ordinary: Chain

    def gain(self, value: str) -> float:
        """By how much a credential automaton explains a value better than
        ordinary text does; minus infinity if the value is typical of none."""
        fits = [s for s, least in ((a.score(value), least) for _, a, least in self.kinds) if s >= least * len(value)]
        return max(fits) - self.ordinary.score(value) if fits else -math.inf


def _fitted(values: list[str]) -> tuple[Automaton, float]:
    """Automaton of four fifths of the values, and the likelihood of a symbol
    that all but ATYPICAL of the others reach."""
    held = [zlib.crc32(v.encode()) % 5 == 0 for v in values]
    kept = [v for v, h in zip(values, held) if not h]
    model = infer(kept)
    others = [v for v, h in zip(values, held) if h] or kept
    return model, float(np.quantile([model.score(v) / len(v) for v in others], ATYPICAL))


def fit_model(labelled: dict[str, list[str]], pairs: dict[str, int]) -> Model:
    """Automata of the labelled values by kind, and ordinary text by its pairs."""
    return Model(tuple((k, *_fitted(v)) for k, v in labelled.items() if len(v) >= LEAST_VALUES), chain(pairs))


def base_spans(text: str, raw: bytes) -> tuple[list[tuple[int, int, int, str]], int]:
    """``(start, kind, end, value)`` of the base patterns, in order, and the
    length of the longest run of credential characters in the text."""
    found = []
    lower = raw.lower()
    if any(w.encode() in lower for w in WORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    longest = max(map(len, raw.translate(_SPLIT).split()), default=0)
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    if longest >= 24:
        found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found), longest


def candidates(text: str, base: list, longest: int) -> list[tuple[int, int, str]]:
    """``(start, end, value)`` of the runs that no base span touches."""
    if longest < RUN_CHARS:
        return []
    out, i, reach = [], 0, 0
    for m in RUN.finditer(text):
        while i < len(base) and base[i][0] < m.end():
            reach = max(reach, base[i][2])
            i += 1
        if m.start() >= reach:
            out.append((m.start(), m.end(), m[0]))
    return out


def pair_counts(raw: bytes) -> np.ndarray:
    """How often each pair of run characters or blanks follows in the bytes,
    by ``first * 256 + second``; two blanks are no pair."""
    x = np.frombuffer(b" " + raw.translate(_SPLIT) + b" ", np.uint8).astype(np.uint16)
    out = np.bincount(x[:-1] << 8 | x[1:], minlength=1 << 16)
    out[32 << 8 | 32] = 0
    return out


def values(docs: DataFrame) -> DataFrame:
    """``(kind, value, n)``: the distinct labelled values, and the pairs of
    symbols of all texts as kind ``text``."""
    schema = pa.schema([("kind", pa.string()), ("value", pa.string()), ("n", pa.int64())])

    def run(batches):
        held: set = set()
        pairs = np.zeros(1 << 16, np.int64)
        for b in batches:
            for raw in utf8(b, "text"):
                text = raw.decode()
                pairs += pair_counts(raw)
                held.update((KINDS[k], v) for _, k, _, v in base_spans(text, raw)[0] if len(v) <= LONGEST)
                if len(held) > HELD_VALUES:
                    yield record(schema, [*zip(*held), [1] * len(held)])
                    held.clear()
        if held:
            yield record(schema, [*zip(*held), [1] * len(held)])
        seen = np.flatnonzero(pairs)
        yield record(schema, [["text"] * len(seen), [chr(p >> 8) + chr(p & 255) for p in seen.tolist()], pairs[seen]])

    return (docs.select("text").mapInArrow(run, "kind string, value string, n long")
            .groupBy("kind", "value").agg(F.sum("n").alias("n")))


def learn(docs: DataFrame, fit_values: int = FIT_VALUES) -> Model:
    """The model of the documents' own credentials."""
    found = materialise(values(docs), "credentials")
    labelled = {k: sorted(r.value for r in found.where(F.col("kind") == k).orderBy(F.xxhash64("value"), "value")
                          .limit(fit_values).collect()) for k in KINDS[:3]}
    # at most the square of the 69 run characters and the blank
    return fit_model(labelled, {r.value: r.n for r in found.where("kind = 'text'").collect()})


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, spans)``: all spans of each row as ``(kind, start, end,
    gain)``, by start and then kind; ``gain`` is null for base spans."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("gain", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])

    def run(batches):
        for b in batches:
            rows = []
            for raw in utf8(b, "text"):
                text = raw.decode()
                base, longest = base_spans(text, raw)
                found = [(s, k, e, None) for s, k, e, _ in base]
                for s, e, v in candidates(text, base, longest):
                    gain = model.gain(v)
                    if gain >= LEAST_GAIN:
                        found.append((s, 3, e, gain))
                found.sort(key=lambda x: x[:3])
                rows.append([{"kind": KINDS[k], "start": s, "end": e, "gain": g} for s, k, e, g in found])
            yield record(schema, [column(b, "doc_id"), pa.array(rows, type=pa.list_(span))])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, spans array<struct<kind: string, start: long, end: long, gain: double>>")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def digest(found: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s.kind != KINDS[3])
    number = {k: F.size(F.expr(f"filter(spans, s -> s.kind = '{k}')")).cast("long") for k in KINDS[:3]}
    return found.select(
        "doc_id", *(n.alias(f"n_{k}") for k, n in number.items()),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(scan(docs, learn(docs)))


QUERIES = {"op11_secret_scan": query}
ORACLE = {}
