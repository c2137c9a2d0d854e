"""Rows every operator is tried on, as fixtures."""

from pathlib import Path

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                          T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                          T.StructField("n_chars", T.LongType())])

needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and very long texts, ties, repeated rows, white space and characters beyond ASCII."""
    prose = "The quick brown fox jumps over the lazy dog while eleven other foxes sleep near a quiet river bank."
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    rows = [(1, prose), (2, prose), (2, prose), (3, prose + " Again."), (4, None), (5, None), (6, ""), (7, " \t\n "), (8, long),
            (9, "a"), (10, "a b"), (None, prose), (None, None), (11, "É é KKſ İ ß"), (12, "x " * 60), (13, "one\ntwo\none\n\n \ntwo"),
            (14, "\x00nul\x00 and\x0bvertical\x0cfeed"), (15, long + " tail"), (16, prose.upper())]
    return [(i, t, None if i == 3 else "en", None if i in (4, 9) else f"s{(i or 0) % 3}", None) for i, t in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_texts):
    return spark.createDataFrame(odd_texts, DOCUMENTS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


def as_rows(df):
    return [r.asDict() for r in df.collect()]


def ordered(rows):
    return sorted(rows, key=repr)
