import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
from helpers import docs  # noqa: E402

import corpus_pipeline as C  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    before = spark.read.parquet(f"{SF}/documents.parquet")
    df = before
    names = [n for n, _ in C.STAGES]
    assert len(names) == 5
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == before.columns and out.dtypes == before.dtypes, name
        df = spark.createDataFrame(out.collect(), out.schema)
    kept = {r.doc_id for r in df.select("doc_id").collect()}
    assert {r.doc_id for r in C.run(spark, SF).collect()} == kept
    assert 0.8 * before.count() < len(kept) < before.count()


def test_stages_on_odd_and_empty_tables(spark):
    rng = random.Random(2)
    text = lambda: " ".join(rng.choice("the and of with words text".split()) + str(rng.randint(0, 99)) for _ in range(80))
    rows = [(i, text(), "en", "s") for i in range(10)]
    rows += [(20, None), (21, ""), (22, "123"), rows[0], rows[0], (None, rows[1][1]), (None, None), (3, text())]
    for make in (rows, []):
        df = docs(spark, make).selectExpr("*", "1 as fp", "2 as component_id", "'x' as n_lines", "3 as rate")
        for _, stage in C.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == df.columns
            df = spark.createDataFrame(out.collect(), out.schema)
        ids = [r.doc_id for r in df.collect()]
        # id 3 stands on two unlike texts, so each of its groups keeps a row
        assert sorted(x for x in ids if x is not None) == (sorted([*range(10), 3]) if make else [])
        assert C.STAGES[-1][1](spark, df, SF).count() == len(ids)
