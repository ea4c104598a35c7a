"""Keep-first duplicate removal on the normalised email, and top-k per key.

Dedupe never gathers a duplicate group into one task: the first row of each
email is found with a partially aggregated ``min(struct(_gen, _ord))``
(map-side combine shrinks a hot email to one row per map task), and the
later copies are picked out by an equi-join of the narrow key table with
the groups that have copies, where emails with more rows than one task
should hold are split over several tasks (``operators.skew``).
Blank emails are exempt and never enter the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions import norm_email
from rollcall.operators.skew import hot_keys, rows_per_task, split_hot_join

DUP = "_dup"


def duplicate_rows(rows: DataFrame, key: str, materialize=None) -> DataFrame:
    """``rows(key, _gen, _ord)`` with blank keys removed -> ``(_gen, _ord, _dup)``
    for every row that is not the first of its key. ``materialize`` is applied
    to the groups with copies, which are used three times."""
    pos = F.struct(S.GEN, S.ORD)
    groups = (
        rows.groupBy(key)
        .agg(F.min(pos).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
    )
    groups = materialize(groups) if materialize else groups
    hot = hot_keys(groups, [key], "_n", rows_per_task(rows))
    return (
        split_hot_join(rows, groups.select(key, "_first"), [key], hot, [S.GEN, S.ORD])
        .filter(pos != F.col("_first"))
        .select(S.GEN, S.ORD, F.lit(True).alias(DUP))
    )


def dedupe_email(df: DataFrame) -> DataFrame:
    """Drop later rows whose normalised email repeats an earlier row's;
    order is ``(_gen, _ord)``; blank emails are kept."""
    e = "_dedupe_e"
    keyed = df.withColumn(e, norm_email(S.EMAIL))
    rows = keyed.filter(F.col(e) != "").select(e, S.GEN, S.ORD)
    return keyed.join(duplicate_rows(rows, e), [S.GEN, S.ORD], "left_anti").drop(e)


def topk_per_key(df: DataFrame, key: str | list[str], order: list, k: int, rank_col: str = "rank") -> DataFrame:
    """First ``k`` rows per ``key`` by ``order``. ``row_number() <= k`` is
    planned with a partial WindowGroupLimit before the shuffle, so a hot key
    ships at most ``k`` rows per map task."""
    w = Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
