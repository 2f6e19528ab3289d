import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
from helpers import docs  # noqa: E402

from valence.llm import decontam as D  # noqa: E402


def slow_search(item, text):
    """Smallest edit distance of item to any part of text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, d in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (d != c)))
        row = new
        best = min(best, row[-1])
    return best


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_search_by_definition():
    rng = random.Random(1)
    for _ in range(200):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(4, 9)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 15)))
        want, got = slow_search(item, text), D.search(item, text, 3)
        assert (got is None) == (want > 3)
        if got:
            assert got[0] == want == slow_search(item, text[got[1]:got[2]])


def test_finds_edited_items_and_nothing_else(spark):
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randint(8, 40))) for i in range(40)]
    rows, want = [], set()
    for i, t in items:
        u = D.units(D.normalise(t.encode()))
        import numpy as np
        near = D._edited(u, len(u) // 25, np.random.default_rng(i)).tobytes().decode("utf-16-le")
        rows += [(i, prose(rng, 60) + " " + t.upper().replace(" ", " \n") + ". " + prose(rng, 30)),
                 (100 + i, prose(rng, 30) + " " + near + " " + prose(rng, 60)), (200 + i, prose(rng, 120))]
        want |= {(i, i), (100 + i, i)}
    rows += [(500, None), (501, ""), (502, prose(rng, 30_000) + " " + items[3][1]), rows[0], (None, items[4][1])]
    want |= {(502, 3), (None, 4)}
    bench = spark.createDataFrame([*items, (900, None), (901, "too short"), (902, items[0][1])], "item_id long, text string")
    df = docs(spark, rows).selectExpr("*", "1 as item_id", "2 as start")
    got = D.leaks(df, bench).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert (0, 902) in found and {x for x in found if x[1] != 902} <= want
    assert len(found & want) >= 0.95 * len(want) and {(i, i) for i, _ in items} <= found
    assert all(r.distance <= 0.1 * len(items[r.item_id % 902][1]) for r in got)
    assert sum(1 for r in got if (r.doc_id, r.item_id) == (0, 0)) == 2  # a repeated row
    left = D.clean(df, bench)
    assert left.columns == df.columns
    assert {r.doc_id for r in left.collect()} == {r[0] for r in rows} - {x[0] for x in found}


def test_blocks_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_BYTES", 60)
    rng = random.Random(3)
    items = [(i, prose(rng, 8)) for i in range(5)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs(spark, [(i, "pre " + t + " post") for i, t in items] + [(9, "clean words here")])
    assert {(r.doc_id, r.item_id) for r in D.leaks(df, bench).collect()} == {(i, i) for i in range(5)}
    assert [r.doc_id for r in D.clean(df, bench).collect()] == [9]
    none = bench.limit(0)
    assert D.leaks(df, none).count() == 0 and D.clean(df, none).count() == 6 and D.leaks(docs(spark, []), bench).count() == 0


def test_edited_items_are_found_at_any_length():
    import numpy as np

    rng = random.Random(7)
    items, i = [], 0
    for words in (30, 45, 60, 110, 220):
        for _ in range(30):
            items.append((i, prose(rng, words).encode()))
            i += 1
    model = D.build(items)
    found, close = {}, {}
    for i, t in items:
        u = D.units(t.decode())
        near = D._edited(u, int(0.1 * len(u)), np.random.default_rng(i)).tobytes().decode("utf-16-le")
        text = prose(rng, rng.randint(0, 90)) + " " + near + " " + prose(rng, rng.randint(0, 90))
        if D.search(t.decode(), text, int(D.EDIT_RATE * len(u))):
            got = D.find([text.encode()], model)[0]
            close.setdefault(i // 30, []).append(model.ids.index(i) in got)
    assert all(len(x) >= 25 and np.mean(x) >= 0.9 for x in close.values()), {k: np.mean(x) for k, x in close.items()}


def unspaced(rng, n):
    return "".join(chr(rng.randint(0x4E00, 0x4E00 + 2500)) for _ in range(n))


def test_items_in_text_without_blanks():
    import numpy as np

    rng = random.Random(8)
    items = [(i, (unspaced(rng, n) if i % 2 else prose(rng, n).replace(" ", "")[:n]).encode())
             for i, n in enumerate([60, 120, 240, 700] * 15)]
    model = D.build(items)
    missed = {False: 0, True: 0}
    for edited in (False, True):
        for i, t in items:
            u = D.units(t.decode())
            if edited:
                u = D._edited(u, int(0.05 * len(u)), np.random.default_rng(i))
            text = unspaced(rng, 150) + u.tobytes().decode("utf-16-le") + unspaced(rng, 80)
            got = D.find([text.encode()], model)[0]
            missed[edited] += model.ids.index(i) not in got
            assert set(got) <= {model.ids.index(i)}
    assert missed[False] == 0 and missed[True] <= 0.1 * len(items), missed


def test_short_items_stand_between_word_edges():
    items = [(1, b"Plain Words"), (2, b"kiwis"), (3, "東京都庁前".encode()), (4, b"kiwi"), (5, b"plain words")]
    model = D.build(items)
    held = lambda t: {model.ids[k] for k in D.find([t.encode()], model)[0]}
    assert model.ids == [1, 2, 3, 5]
    assert held("some plain  WORDS, kiwis.") == {1, 2, 5} and held("plain\nwords") == {1, 5}
    assert held("explain words") == set() == held("plain wordsmith kiwi xkiwis kiwis2") == held("")
    assert held("昨日東京都庁前で") == {3} and D.find([b"a kiwis"], model)[0] == {1: (0, 2, 7)}


def test_walks_of_long_items_stay_short():
    rng = random.Random(9)
    item = prose(rng, 4_000)
    model = D.build([(1, item.encode()), (2, prose(rng, 50).encode())])
    assert all(c.high <= 2 * D.PIECE for c in model.classes)
    found = D.find([(prose(rng, 40) + " " + item + " " + prose(rng, 20)).encode(), prose(rng, 4_000).encode()], model)
    assert [set(x) for x in found] == [{0}, set()] and found[0][0][0] == 0


def test_no_copy_within_the_distance_is_left_out():
    """Edits spread so that no 12 characters in a row stay, and edits at random."""
    import numpy as np

    rng = random.Random(10)
    items = [(i, (unspaced(rng, n) if i % 5 == 4 else prose(rng, n)[:n - 1] + "x").encode())
             for i, n in enumerate([24, 29, 30, 47, 60, 81, 100, 175, 260, 400, 900] * 5)]
    model = D.build(items)
    tried = 0
    for k, (i, t) in enumerate(items):
        u, most = D.units(t.decode()), int(0.1 * len(t.decode()))
        spread = u.copy()
        spread[[(2 * j + 1) * len(u) // (2 * most) for j in range(most)]] = ord("#")
        for near in (spread, D._edited(u, most, np.random.default_rng(k))):
            text = prose(rng, rng.randint(0, 60)) + " " + near.tobytes().decode("utf-16-le") + " " + prose(rng, rng.randint(0, 60))
            if D.search(t.decode(), D.normalise(text.encode()), most):
                got = D.find([text.encode()], model)[0]
                assert set(got) == {k}, (len(t), set(got))
                tried += 1
    assert tried > 1.8 * len(items)


def test_characters_of_two_units_and_long_texts(monkeypatch):
    monkeypatch.setattr(D, "STRETCH", 64)
    rng = random.Random(11)
    items = [(i, ("".join(chr(0x1F600 + rng.randint(0, 60)) + rng.choice("abcdef") * (i % 3) for _ in range(30))).encode()) for i in range(6)]
    model = D.build(items)
    for k, (_, t) in enumerate(items):
        s = list(t.decode())
        most = int(0.1 * len(s))
        for j in range(most):
            s[(2 * j + 1) * len(s) // (2 * most)] = "\U0001F680"
        got = D.find([(prose(rng, 300) + " " + "".join(s) + " " + prose(rng, 90)).encode()], model)[0]
        assert set(got) == {k} and got[k][0] <= most
