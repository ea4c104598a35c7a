"""Fixtures of this folder's tests."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty and long texts, repeated rows and signs."""
    long = " ".join(f"word{i % 997} and" for i in range(30_000))
    rows = [
        (1, None, "en", "a", None),
        (2, "", None, None, 0),
        (3, " \n\t ", "en", "a", 4),
        (None, "a text without an id, but with some words in it", "en", None, None),
        (None, None, None, None, None),
        (4, long, "en", "a", len(long)),
        (5, "twice the same row", "en", "a", 18),
        (5, "twice the same row", "en", "a", 18),
        (6, "the same id", "en", "a", 11),
        (6, "with another text", "fr", "b", 17),
        (7, "12345 !!! ###", "de", "a", 13),
        (8, "é ü \x1c 🙂 ß İ Σ password: hunter2hunter2 é", "de", "a", 30),
        (9, long, "en", "b", len(long)),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def labelled(spark):
    rows = [(1, 1, 0), (2, None, None), (None, 1, 1), (4, 1, 0), (5, 0, 1), (6, 0, 0), (9, 1, 1), (9, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def clash(df):
    """Further columns whose names are those the operators use inside, or differ by case."""
    names = ["words", "score", "fp", "rank", "n", "label", "held_out", "chunk", "host", "copy", "n_words"]
    out = df.select("*", *[F.lit(1).alias(n) for n in names if n not in df.columns])
    return out.select("*", F.lit("x").alias("TEXT"), F.lit("x").alias("Doc_Id"))


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        path = f"{SF}/{name}.parquet"
        path = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"create view {name} as select * from '{path}'")
    return con

