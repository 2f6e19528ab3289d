from pyspark.sql import functions as F

from valence.session import scratch_path
from valence.sources.csv import read_labelled_csv, read_labelled_csv_strings, write_csv
from conftest import SF_SMALL

ODD = ["", None, " ", "a\nb", "a\r\nb\r", 'say "x", y', '"', "\\", "\\N", "null", ",", "\t x ", "#", "'"]


def test_every_text_comes_back(spark):
    rows = [(i, t, None if i % 5 == 0 else i / 4 - 1) for i, t in enumerate(ODD)]
    path = scratch_path(spark, "csv-test")
    write_csv(spark.createDataFrame(rows, "Id long, Tweet string, Polarity double"), path)
    got = read_labelled_csv(spark, path, "Id LONG, Tweet STRING, Polarity DOUBLE").orderBy("Id").collect()
    assert [tuple(r) for r in got] == rows
    labels = {int(r.Id): r.label for r in read_labelled_csv_strings(spark, path).collect()}
    assert labels == {i: 0 if p is not None and p < 0 else 1 for i, _, p in rows}


def test_documents_come_back(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    path = scratch_path(spark, "csv-test")
    write_csv(docs, path)
    back = read_labelled_csv(spark, path, "doc_id LONG, text STRING")
    assert back.exceptAll(docs).count() == 0 and docs.exceptAll(back).count() == 0
    assert back.where(F.col("text").contains("\n")).count() > 0
