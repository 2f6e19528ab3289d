import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import docs
from valence.llm import spelling as S

LOWER = {i: i + 32 for i in range(65, 91)}


def _near(a, b):
    """Exactly one inserted, deleted or replaced code point, by definition."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _rows(counts):
    """Expected rows by comparing all pairs of words."""
    near = defaultdict(list)
    words = list(counts)
    for i, a in enumerate(words):
        for b in words[i + 1:]:
            if _near(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def _words(rows):
    import regex

    out = Counter()
    for doc, text in rows:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def _corpus(seed, letters="abcdeé", documents=40, words=120):
    rng = random.Random(seed)
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(60)]

    def word():
        w = list(rng.choice(stems))
        for _ in range(rng.choice((0, 0, 0, 1, 1, 2))):
            at, kind = rng.randrange(len(w)), rng.randrange(3)
            w[at:at + (kind > 0)] = [] if kind == 2 and len(w) > 4 else [rng.choice(letters)]
        return "".join(w)

    return [(i, " ".join(word() for _ in range(words))) for i in range(documents)]


def test_words_and_deletions(spark):
    rows = _corpus(1) + [(None, "Ärger Ärger ärger ÄRGER x×y÷z ×÷×÷× ×÷×÷× ×÷×÷×"), (3, None), (4, ""), (9, "ab1cd_ef"),
                         (-5, "Hello hello HELLO hello"), (77, "Ⅷ日本語 ſtrasse ſtrasse ſtrasse")]
    got = {r.word: r.n for r in S.vocabulary(docs(spark, rows)).collect()}
    assert got == _words(rows)
    assert got["Ärger"] == 3 and got["×÷×÷×"] == 3
    assert sum(zlib.crc32(f"{i}:{w}".encode()) % 97 == 0 for i, t in rows[:40] for w in set(t.split())) > 5


@pytest.mark.parametrize("cell_rows", [S.CELL_ROWS, 60, 1])
def test_variants_against_all_pairs(spark, cell_rows):
    # small limits deal cells out by all levels and cut the last ones into tiles
    rows = _corpus(2, letters="abeé" if cell_rows < 100 else "abcdeé", documents=25)
    words = S.vocabulary(docs(spark, rows)).collect()
    table = spark.createDataFrame(words, "word string, n long")
    got = [tuple(r) for r in S.variants(table, cell_rows).collect()]
    expected = _rows({r.word: r.n for r in words})
    assert len(got) == len(set(got)) and set(got) == expected
    assert sum(r[4] for r in got) >= 40 and any(r[1] is not None for r in got)


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert {tuple(r) for r in S.query(spark, sf).collect()} == _rows(_words(rows))


def test_same_group_letters_ties_and_long_words(spark):
    long = "".join(random.Random(3).choice("abcdefgh") for _ in range(3000))
    counts = {"jazzy": 3, "jaxzy": 9, "jaqzy": 9, "wolves": 4, "folves": 5,  # letters of one group replace each other
              "aaaaa": 3, "aaaaaa": 7, "aaaaaaa": 14, "baaaa": 6,
              long: 3, long[:1500] + "z" + long[1500:]: 6, long[:7] + "z" + long[8:]: 6,
              "abcde": 3, "abced": 30, "bacde": 30,  # transposed letters are two edits
              "\xe0\xe1\xe2\xe3\xe4": 3, "\xe0\xe1\xe2\xe3\xe5": 6}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {tuple(r) for r in S.variants(table).collect()}
    assert got == _rows(counts)
    assert {r[0]: r[1] for r in got}["jazzy"] == "jaqzy"  # of equal counts the smaller word


def test_empty(spark):
    for rows in ([], [(1, None), (None, None), (2, "")]):
        assert S.variants(S.vocabulary(docs(spark, rows))).collect() == []


def test_near_is_the_definition():
    rng = random.Random(5)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) for _ in range(150)]
    a = S.Words(words)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    expected = [_near(words[p], words[q]) and len(words[p]) <= len(words[q]) for p, q in zip(i, j)]
    assert S.near(a, i, a, j).tolist() == expected
