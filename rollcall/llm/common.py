"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **types: str) -> DataFrame:
    """The named columns only, cast to the given types.

    Columns are matched by exact name and position, so any further column,
    also one whose name differs by case alone, neither clashes nor survives.
    """
    names = df.columns
    if not any(n.lower() == m.lower() and n != m for n in types for m in names) and len({*names}) == len(names):
        return df.select(*[F.col(f"`{n}`").cast(t).alias(n) for n, t in types.items()])
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"c{names.index(n)}").cast(t).alias(n) for n, t in types.items()])


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of a documents table; a null text counts as empty."""
    return pick(docs, doc_id="bigint", text="string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def documents(docs: DataFrame) -> DataFrame:
    """The five columns of a documents table and no others."""
    return pick(docs, doc_id="bigint", text="string", lang="string", source="string", n_chars="bigint")


def fold_is(column: str, folds: int, fold: int) -> Column:
    """Whether crc32(column as text) mod ``folds`` is ``fold``; false for null."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds == fold, F.lit(False))


def bounded_examples(docs: DataFrame, chosen: DataFrame, key: str, label: str, limit: int) -> DataFrame:
    """(doc_id, text, label) of at most ``limit`` labelled documents.

    ``chosen`` holds the doc_id and label that may be learned from. The ids
    with the smallest hashes are taken. Their number being known, a bound on
    the hash leaves about twice as many for the top-k, however many tasks
    there are. The result of at most ``limit`` rows is then broadcast to the
    scan of the texts. ``limit`` is the documented bound of the fit; nothing
    else is sampled.
    """
    ids = chosen.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("doc_id")).agg(F.max(label).alias("label"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    share = min(1.0, 2 * limit / max(1, ids.count()))
    ids = ids.filter(place < F.lit(int(share * (1 << 40)))).orderBy(place, "doc_id").limit(limit)
    found = texts(docs).filter(F.col("doc_id").isNotNull()).join(F.broadcast(ids), "doc_id")
    # Repeated rows of one document count once; of several texts the one with the smallest hash.
    one = found.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("at"), "text", "label")).alias("x"))
    return one.select("doc_id", "x.text", "x.label")


def learned(rows: DataFrame, learn: Callable, otherwise):
    """What ``learn`` makes of the rows, which meet in one task: for rows whose
    number has a documented bound. ``otherwise`` if there are none.

    ``learn`` takes the batches of rows (pandas) and returns any object.
    """

    def work(batches):
        yield pd.DataFrame({"model": [pickle.dumps(learn(batches))]})

    found = rows.repartition(1).mapInPandas(work, "model binary").first()
    return pickle.loads(found["model"]) if found else otherwise


def small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that few texts are Python strings at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


class Memo(dict):
    """word -> value, computed once; emptied when it holds ``limit`` words, so
    that its memory stays bounded whatever the vocabulary."""

    def __init__(self, compute: Callable, limit: int = 150_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.compute(word)
        return value
