import random
import sys
from pathlib import Path

import numpy as np
import xxhash

sys.path.insert(0, str(Path(__file__).parent))
from helpers import components, docs  # noqa: E402

from valence.llm import simhash as S  # noqa: E402


def slow_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text).encode().split()
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint_by_definition():
    for t in ("", " \n", "One", "a B c", "a b c d", "Ä b\tc d\ne f g " * 5, "x x x x x x x"):
        assert S.fingerprint(t.encode()) == slow_fingerprint(t)


def test_chunks_do_not_change_the_fingerprint(monkeypatch):
    text = " ".join(str(i % 97) for i in range(500)).encode()
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "CHUNK", 7)
    assert S.fingerprint(text) == whole


def test_golay_words_within_two_bits_share_an_index():
    rng = random.Random(1)
    for _ in range(300):
        v = rng.getrandbits(23)
        w = v
        for b in rng.sample(range(23), 2):
            w ^= 1 << b
        _, k = S.golay_keys(np.array([v]))
        _, m = S.golay_keys(np.array([w]))
        assert set(k) & set(m) and len(k) <= 6


def test_every_pair_within_four_bits_shares_a_key():
    rng = random.Random(2)
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            b ^= 1 << bit
        rows, ks = S.keys(np.array([a, b], np.uint64))
        assert set(ks[rows == 0]) & set(ks[rows == 1])


def test_components_match_brute_force(spark):
    rng = random.Random(3)
    words = ["w%d" % i for i in range(300)]
    rows = []
    for g in range(25):
        base = [rng.choice(words) for _ in range(150)]
        for _ in range(rng.randint(1, 5)):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(150)] = rng.choice(words)
            rows.append((len(rows) * 3 % 101, " ".join(t)))
    rows += [(200, None), (201, ""), (202, " "), (203, "one"), rows[0], rows[0], (None, rows[1][1]), (None, "zz yy")]
    fps = {}
    for i, t in rows:
        fps.setdefault(slow_fingerprint(t or ""), set()).add(i)
    root = components(sorted(fps), lambda x, y: (x ^ y).bit_count() <= 4)
    low = {}
    for f, r in root.items():
        low.setdefault(r, set()).update(x for x in fps[f] if x is not None)
    want = sorted(((i, slow_fingerprint(t or ""), min(low[root[slow_fingerprint(t or "")]], default=None)) for i, t in rows), key=str)
    got = S.simhash_components(docs(spark, rows).selectExpr("*", "1 as fp", "2 as key", "3 as a")).collect()
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=str) == want
    assert len(set(low)) < len(fps)


def test_dense_family_and_empty_table(spark):
    fps = [(1 << i) | (1 << j) for i in range(64) for j in range(i)]
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    cc = S.connected_components(S.links(df))
    assert cc.count() == len(fps) and cc.select("root").distinct().count() == 1
    assert S.simhash_components(docs(spark, [])).count() == 0


def test_groups_that_share_their_smallest_id_keep_a_row_each(spark):
    rng = random.Random(9)
    one, two, three = (" ".join("w%d" % rng.randrange(10**6) for _ in range(60)) for _ in range(3))
    rows = [(3, one), (5, one), (5, two), (7, two), (8, three), (8, two), (8, three), (9, three), (None, one)]
    kept = S.one_of_each(docs(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("3", one), ("5", two), ("8", three), ("None", one)])
    both = S.one_of_each(docs(spark, [(1, one), (1, two), (2, one), (2, two)])).collect()
    assert sorted((r.doc_id, r.text) for r in both) == sorted([(1, one), (1, two)])


def test_names_used_inside_pass_through(spark):
    rng = random.Random(10)
    one, two = (" ".join("w%d" % rng.randrange(10**6) for _ in range(60)) for _ in range(2))
    own = {n: n + "!" for n in ("_fp", "_id", "_group", "_print", "_nth", "fp", "root", "nth", "row", "component_id")}
    df = docs(spark, [(1, one), (1, two), (2, one), (2, two), (2, None), (3, None)]).selectExpr(
        "*", *(f"'{v}' as {k}" for k, v in own.items()))
    kept = S.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, str(r.text)) for r in kept.collect()) == sorted([(1, one), (1, two), (2, "None")])
    assert all(r[k] == v for r in kept.collect() for k, v in own.items())
