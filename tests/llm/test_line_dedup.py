import hashlib
import random
import sys
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
from helpers import docs  # noqa: E402

from valence.llm import line_dedup as L  # noqa: E402

BLANK = " \t\n\x0b\x0c\r"


def brute(rows, min_chars, min_docs):
    key = lambda s: "".join(c.lower() if c.isascii() else c for c in s.strip(BLANK))
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                held[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        big = lambda k: max((x for x in held[k] if x is not None), default=None)
        kept = [x for x in lines if not (len(held.get(key(x), ())) >= min_docs and big(key(x)) != i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_matches_brute_force_with_odd_rows(spark):
    rng = random.Random(5)
    pool = ["line %d é" % i for i in range(6)] + ["", " \t", "LINE 1 é\r", " line 2 é", "x"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 9)))) for i in range(40)]
    rows += [(None, "line 1 é\nown"), (None, "line 2 é"), (7, "line 1 é\nother"), rows[3], rows[3],
             (90, None), (91, ""), (92, "\n"), (93, "z" * 200_000 + "\nline 1 é")]
    got = L.digest(L.line_dedup(docs(spark, rows), 5, 3)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 5, 3)


def test_empty_table_and_clashing_names(spark):
    assert L.line_dedup(docs(spark, [])).count() == 0
    df = docs(spark, [(1, "a\nb")]).selectExpr("*", "'x' as n_lines", "'y' as line", "1 as pos")
    row = L.line_dedup(df).first()
    assert (row.n_lines, row.line, row.pos, row.text) == (2, "y", 1, "a\nb")


def test_names_used_inside_pass_through(spark):
    own = {"_gone": "a", "_all": "b", "_r1": "c", "_r2": "d", "_row": "e", "_h1": "f", "_key": "g"}
    df = docs(spark, [(i, "line one\nown %d" % i) for i in range(6)]).selectExpr("*", *(f"'{v}' as {k}" for k, v in own.items()))
    got = L.line_dedup(df, 5, 3)
    assert got.columns == [*df.columns, "n_lines", "n_dropped"]
    rows = {r.doc_id: r for r in got.collect()}
    assert all(rows[i].text == (f"line one\nown {i}" if i == 5 else f"own {i}") and all(rows[i][k] == v for k, v in own.items())
               for i in range(6))
