import __spark_entry__ as E


def test_oracle_keys_are_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["label", "prediction", "n"]
    assert sum(r.n for r in rows) > 0


def test_reference_queries_stand_alone(monkeypatch):
    monkeypatch.setattr(E, "_llm", lambda: (None, None))
    assert "clean_text" in E.queries() and "pipeline" not in E.queries()
