import math
import random
import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
from helpers import docs  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from valence.llm import toxicity as T  # noqa: E402
from valence.llm.common import fold  # noqa: E402


def slow_segments(scores, at=0):
    """By definition: the best segment, then the same left and right of it."""
    best = max(((sum(scores[i:j]), i - j, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)
                if all(sum(scores[i:k]) > 0 for k in range(i + 1, j + 1))), default=(0,), key=lambda x: (round(x[0], 9), -x[2] + 0 * x[1]) if len(x) > 1 else (0, 0))
    if best[0] <= 0:
        return []
    _, _, i, j = best
    return slow_segments(scores[:i], at) + [(at + i, at + j)] + slow_segments(scores[j:], at + j)


def test_maximal_segments_by_definition():
    rng = random.Random(9)
    for _ in range(300):
        s = [rng.choice((-1, 1)) * (rng.randint(1, 9) + i / 97) for i in range(rng.randint(0, 12))]
        assert [(a, b) for a, b, _ in T.maximal_segments(s)] == slow_segments(s)


def corpus(rng):
    rows, labels = [], []
    for i in range(240):
        words = [rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(60)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(20, 40)] = rng.choice(("scumword", "Trashword!"))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark):
    rows, labels = corpus(random.Random(2))
    odd = [(500, None), (501, ""), (502, "alpha " * 100_000 + "scumword"), rows[0], rows[0], (None, rows[0][1])]
    lab = spark.createDataFrame([*labels, (0, 1, None), (None, 1, 1), (0, 1, 1)], "doc_id long, quality int, toxic int")
    df = docs(spark, rows + odd).selectExpr("*", "0 as score", "1 as label", "2 as token")
    model = T.fit(T.training_rows(df, lab, fold("doc_id", 5) != 0))
    got = T.score(df, model).withColumn("held", fold("doc_id", 5) == 0).collect()
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.held and r.doc_id in truth]
    assert held and all((r.score >= 0.5) == bool(truth[r.doc_id]) for r in held)
    assert len(got) == len(rows + odd) and len({r.score for r in got if r.doc_id in (500, 501)}) == 1
    top = next(r for r in got if r.doc_id == 0)
    words = T.tokens(rows[0][1].encode())
    assert any(w in (b"scumword", b"trashword") for w in words[top.seg_start:top.seg_end])


def test_without_labels_or_rows(spark):
    df = docs(spark, [(1, "a b"), (2, "c")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    for lab in (none, one):
        model = T.fit(T.training_rows(df, lab, F.lit(True)))
        assert len({r.score for r in T.score(df, model).collect()}) == 1
        assert T.score(docs(spark, []), model).count() == 0


def slow_fit(rows, weights):
    """Rate, K and curve from every token of the rows, by their definitions."""
    split = [(T.tokens((t or "").encode()), label) for t, label in rows]
    clean = [ws for ws, label in split if label == 0]
    law = Counter(weights.get(w, T.DRIFT) for ws in clean for w in ws)
    total = sum(law.values())
    value = lambda rate: sum(n * math.exp(rate * s) for s, n in law.items()) / total
    low, high = 1e-6, 8.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 1 else (low, mid)

    def found(ws):
        scores = [weights.get(w, T.DRIFT) for w in ws]
        return [sum(scores[a:b]) for a, b in slow_segments(scores)]

    best = [max(found(ws), default=0.0) for ws in clean]
    chance = len(clean) / sum(len(ws) * math.exp(-high * b) for ws, b in zip(clean, best))
    return high, chance, found


def test_chance_law_and_score_by_definition(spark):
    rng = random.Random(6)
    # mild words stand in clean texts too, now and then in a row; harsh ones almost never
    def text(toxic):
        words = [rng.choice("alpha beta gamma delta".split()) for _ in range(25)]
        for _ in range(rng.choice((0, 0, 0, 2)) + 4 * toxic):
            words[rng.randrange(25)] = rng.choice(("mild", "mild", "harsh") if toxic else ("mild",))
        return " ".join(words)

    rows = [(text(i % 3 == 0), int(i % 3 == 0)) for i in range(240)] + [("once seen", 0), (None, 0), ("", 1)]
    train = spark.createDataFrame(rows, "text string, label int")
    weights = T.lexicon(train)
    # Dirichlet log-odds of every token, singletons included in the totals
    n1, n0 = (Counter(w for t, y in rows if y == k for w in set(T.tokens((t or "").encode()))) for k in (1, 0))
    t1, t0, types = sum(n1.values()), sum(n0.values()), len(set(n1) | set(n0))
    a1, a0 = (T.PRIOR * 2 * t / (t1 + t0) for t in (t1, t0))
    want = {}
    for w in set(n1) | set(n0):
        k1, k0 = n1[w] + a1, n0[w] + a0
        odds = math.log(k1 / (t1 + a1 * types - k1)) - math.log(k0 / (t0 + a0 * types - k0))
        if abs(odds) / math.sqrt(1 / k1 + 1 / k0) >= T.LEAST_Z:
            want[w] = odds
    assert {b"mild", b"harsh"} <= set(weights) == set(want)
    assert all(abs(weights[w] - want[w]) < 1e-9 for w in want)
    model = T.fit(train)
    rate, chance, found = slow_fit(rows, weights)
    assert abs(model.rate - rate) < 1e-6 * rate and abs(model.chance - chance) < 1e-6 * chance
    df = docs(spark, [(i, t) for i, (t, _) in enumerate(rows)])
    got = {r.doc_id: r.score for r in T.score(df, model).collect()}
    for i, (t, _) in enumerate(rows):
        ws = T.tokens((t or "").encode())
        x = min(50.0, sum(max(0.0, rate * s - math.log(chance * max(len(ws), 1))) for s in found(ws)))
        assert abs(got[i] - 1 / (1 + math.exp(-(model.offset + model.slope * x)))) < 1e-5
