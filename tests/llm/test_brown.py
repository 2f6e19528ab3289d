import math
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
from helpers import docs  # noqa: E402

from valence.llm import brown as B  # noqa: E402


def likelihood(pairs, of):
    k = of.max() + 1
    t = np.zeros((k, k))
    np.add.at(t, (of[:, None], of[None, :]), pairs)
    h = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
    return h(t) - h(t.sum(0)) - h(t.sum(1))


def test_exchange_ends_where_no_single_move_gains():
    rng = np.random.default_rng(1)
    pairs = rng.poisson(1.0, (14, 14)).astype(float)
    of = B.exchange(pairs, 3, 50)
    best = likelihood(pairs, of)
    for w in range(14):
        for c in range(3):
            other = of.copy()
            other[w] = c
            assert likelihood(pairs, other) <= best + 1e-9


def slow(rows, train, model):
    """Base and class scores of each row by their formulas, word by word."""
    c = Counter()
    for _, t in train:
        c.update(B.words((t or "").encode()) + [B.END])
    n, v = sum(c.values()), len(c)
    known = {w: u for w, i in model.head.items() if (u := int(model.head_unit[i])) != B.form(w)}
    out = []
    for i, t in rows:
        ws = B.words((t or "").encode()) + [B.END]
        cls = [int(model.of[u]) for u in B.units((t or "").encode(), known)]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        score = sum(math.log10(c[w] + 0.5) + model.step[p, k] if c[w] else model.unknown[p]
                    for w, p, k in zip(ws, [int(model.of[0]), *cls], cls))
        out.append((str(i), len(ws), sum(c[w] > 0 for w in ws), round(base, 6), round(score, 6)))
    return sorted(out)


def test_scores_by_formula_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(B, "HEAD", 20)  # most words go through the join
    rng = random.Random(3)
    vocabulary = ["w%d" % i for i in range(150)] + ["É", "the", "The"]
    make = lambda n: " ".join(rng.choice(vocabulary[:20 + rng.randint(0, 130)]) for _ in range(n))
    train = [(i, make(rng.randint(0, 30))) for i in range(60)] + [(None, make(5)), (70, None)]
    rows = train + [(80, ""), (81, "unseen words w1"), train[0], train[0], (None, "w2"), (82, make(20_000))]
    t, d = docs(spark, train), docs(spark, rows).selectExpr("*", "1 as word", "2 as n", "3 as uid")
    got, model = B.brown_scores(t, d)
    have = sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in got.collect())
    assert have == slow(rows, train, model)
    # the probabilities of all known words and the unknown one sum to one after every class
    mass = np.zeros(len(model.unknown))
    counts = {bytes(r.word): r.n for r in B.word_counts(t).collect()}
    for w, n in counts.items():
        at = model.head.get(w)
        unit = 0 if w == B.END else int(model.head_unit[at]) if at is not None else B.form(w)
        mass += (n + 0.5) * 10 ** model.step[:, model.of[unit]]
    assert np.allclose(mass + 10 ** model.unknown, 1)


def test_nothing_to_learn_from_and_empty(spark):
    got, _ = B.brown_scores(docs(spark, []), docs(spark, [(1, "a b"), (2, None)]))
    assert [(r.n_tokens, r.n_known, round(r.base_score, 9), round(r.score, 9)) for r in got.orderBy("doc_id").collect()] == [(3, 0, 0, 0), (1, 0, 0, 0)]
    got, _ = B.brown_scores(docs(spark, [(1, "a")]), docs(spark, []))
    assert got.count() == 0


def test_words_beyond_the_units_have_classes_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(B, "PLACED_LEAST", 3)
    rng = random.Random(5)
    # two kinds of words in turn, with endings that say nothing of the kind
    pick = lambda kind: "%s%dx%d" % (kind, (n := rng.randrange(1200)), n % 7)
    train = [(i, " ".join(pick("pq"[j % 2]) for j in range(200))) for i in range(120)]
    t = docs(spark, train)
    got, model = B.brown_scores(t, t)
    have = sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in got.collect())
    assert have == slow(train, train, model)
    assert len(model.of) > B.UNITS + 1000  # words placed on their own
    mass = np.zeros(len(model.unknown))
    counts = {bytes(r.word): r.n for r in B.word_counts(t).collect()}
    for w, n in counts.items():
        mass += (n + 0.5) * 10 ** model.step[:, model.of[0 if w == B.END else model.head_unit[model.head[w]]]]
    assert np.allclose(mass + 10 ** model.unknown, 1)


def test_each_word_is_placed_where_it_adds_most():
    rng = np.random.default_rng(8)
    beside = rng.poisson(3.0, (6, 2, 4)).astype(float)
    start = rng.integers(0, 4, 6)
    table = rng.poisson(9.0, (4, 4)).astype(float)
    for (after, before), a in zip(beside, start):
        table[a] += after
        table[:, a] += before
    got = B.place_words(table, beside, start)
    for w, ((after, before), a) in enumerate(zip(beside, start)):
        found = []
        for c in range(4):
            t = table.copy()
            t[a] -= after
            t[:, a] -= before
            t[c] += after
            t[:, c] += before
            found.append(likelihood(t, np.arange(4)))
        assert found[got[w]] >= max(found) - 1e-9


def test_every_frequent_word_has_a_class_of_its_own_choice(spark, monkeypatch):
    """No number of words is the limit, neither that of one table nor that of the head."""
    monkeypatch.setattr(B, "PLACED", 300)
    monkeypatch.setattr(B, "HEAD", 1500)
    monkeypatch.setattr(B, "HELD_PLACES", 1000)
    rng = random.Random(6)
    pick = lambda kind: "%s%dx%d" % (kind, (n := rng.randrange(1200)), n % 7)
    train = [(i, " ".join(pick("pq"[j % 2]) for j in range(400))) for i in range(120)]
    t = docs(spark, train)
    counts = B.word_counts(t)
    got, model = B.brown_scores(t, t)
    n = {bytes(r.word): r.n for r in counts.collect()}
    frequent = [w for w in n if w != B.END and n[w] >= B.PLACED_LEAST]
    beyond = [w for w in frequent if w not in model.head]
    units = dict(zip(beyond, model.rare.find(beyond))) | {w: model.head_unit[i] for w, i in model.head.items()}
    assert len(beyond) > 500 and len({units[w] for w in frequent}) == len(frequent)
    assert len(model.of) == B.UNITS + len(frequent) - B.CORE
    # by formula, with these units
    total, types = sum(n.values()), len(n)
    want = {}
    for i, text in train:
        ws = B.words(text.encode()) + [B.END]
        cls = [int(model.of[units[w]]) if w in units else int(model.of[B.form(w)]) for w in ws[:-1]] + [int(model.of[0])]
        want[i] = sum(math.log10(n[w] + 0.5) + model.step[p, k] for w, p, k in zip(ws, [int(model.of[0]), *cls], cls))
    assert all(abs(r.score - want[r.doc_id]) < 1e-6 for r in got.collect())
    mass = sum((n[w] + 0.5) * 10 ** model.step[:, model.of[0 if w == B.END else units.get(w, B.form(w))]] for w in n)
    assert np.allclose(mass + 10 ** model.unknown, 1)
    # the choice is that of one word after the other
    rng = np.random.default_rng(9)
    beside, table = rng.poisson(2.0, (300, 2, 5)).astype(float), rng.poisson(900.0, (5, 5)).astype(float)
    start = rng.integers(0, 5, 300)
    for w, b in enumerate(B.place_words(table, beside, start)):
        rest, a = table.copy(), start[w]
        rest[a] -= beside[w, 0]
        rest[:, a] -= beside[w, 1]
        assert b == B.best_class(rest, *beside[w], 0.0, a)
