import random
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
from helpers import components  # noqa: E402

from valence.llm import neighbours as N  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int"


def fixture(rng, dim=16):
    rows = []
    for _ in range(60):
        base = rng.standard_normal(dim)
        for _ in range(rng.integers(1, 5)):
            v = base + rng.standard_normal(dim) * rng.choice((0.0, 0.02, 0.1, 0.2))
            rows.append((len(rows) * 7 % 1009, v.astype(np.float32).tolist(), int(rng.integers(0, 2))))
    return rows


def brute(rows, cosine):
    vec = [(i, np.array(v, float), c) for i, v, c in rows if v and c is not None and None not in v
           and np.isfinite(v).all() and np.any(v)]
    unit = {i: (v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()), c) for i, v, c in vec}
    near = lambda a, b: a in unit and b in unit and a != b and unit[a][1] == unit[b][1] and len(unit[a][0]) == len(unit[b][0]) \
        and float(unit[a][0] @ unit[b][0]) >= cosine
    ids = sorted(i for i, *_ in rows)
    root = components(ids, near)
    return sorted((i, sum(near(i, j) for j in ids), root[i], root[i] == i) for i in ids)


def test_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = fixture(rng)
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [float("nan")] * 16, 1), (2004, [None] * 16, 1),
             (2005, [float("inf")] + [1.0] * 15, 1), (2006, rows[0][1], None), (2007, rows[0][1][:8], rows[0][2]),
             *((3000 + i, rows[1][1], rows[1][2]) for i in range(30)), (2008, [1e38] * 16, 1), (2009, [1e-30] * 16, 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as key", "2 as copies", "3 as home")
    for cosine in (0.98, 0.9):
        got = sorted(tuple(r) for r in N.near_duplicates(df, cosine).collect())
        assert got == brute(rows, cosine)


def test_hot_cells_are_tiled(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = rng.standard_normal(16)
    rows = [(i, (base + rng.standard_normal(16) * 0.08).astype(np.float32).tolist(), 3) for i in range(150)]
    monkeypatch.setattr(N, "TILE", 16)
    got = sorted(tuple(r) for r in N.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute(rows, 0.98) and max(r[1] for r in got) > 16


def test_rows_without_id_and_empty(spark):
    got = N.near_duplicates(spark.createDataFrame([(None, [1.0, 2.0], 1), (4, [1.0, 2.0], 1)], SCHEMA)).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == [("4", 0, "4"), ("None", 0, "None")]
    assert N.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_labels_of_any_type_link_only_when_equal(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    for kind, (a, b) in {"double": (1.2, 1.7), "string": ("cat", "dog"), "long": (1, 1 + 2**32), "boolean": (True, False)}.items():
        df = spark.createDataFrame([(1, v, a), (2, v, b), (3, v, a), (4, v, None), (5, v, None)],
                                   f"vec_id long, embedding array<float>, label {kind}")
        got = {r.vec_id: (r.n_links, r.component_id) for r in N.near_duplicates(df).collect()}
        assert got == {1: (1, 1), 2: (0, 2), 3: (1, 1), 4: (0, 4), 5: (0, 5)}, kind
