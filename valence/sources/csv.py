"""CSV sources and sink.

Writer and readers share one dialect that loses nothing: quotes are doubled,
line breaks may stand in quoted values, blanks around values are kept, and a
null is written as ``NULL_MARK``, so that it differs from an empty string.

Every read takes an explicit schema: schema inference costs an extra pass
over the files and can change with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from valence.functions.text import binarise_polarity

# Two characters that no text holds by accident: start and end of text.
NULL_MARK = "\x02\x03"
DIALECT = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "nullValue": NULL_MARK,
           "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
           "lineSep": "\n"}


def read_labelled_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Header row, explicit schema."""
    return spark.read.schema(schema).options(**DIALECT).csv(path)


def read_labelled_csv_strings(spark: SparkSession, path: str,
                              polarity_col: str = "Polarity") -> DataFrame:
    """All columns as strings, the polarity compared late through
    ``try_cast`` so unparsable values give label 1 as in the reference."""
    raw = spark.read.options(**DIALECT).csv(path)
    return raw.withColumn("label", binarise_polarity(polarity_col))


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header, overwrite. ``single_file`` funnels the rows through one
    task (the reference's ``coalesce(1)``); leave it off for large tables."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**DIALECT, quoteAll=True).csv(path)
