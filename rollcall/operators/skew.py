"""Splitting hot keys across tasks (salting), for joins of a big side with
many rows per key against a side with one row per key.

A key whose row count exceeds ``rows_per_task`` is split into
``ceil(count / rows_per_task)`` salts: each big-side row of that key gets
salt ``pmod(xxhash64(row id), salts)``, and the one small-side row of the
key is replicated once per salt; every other key keeps salt 0. The join on
``(key, salt)`` then gives exactly the rows of the plain join, with no task
holding more than about ``rows_per_task`` rows of one key.

The hot-key table is broadcast: it has at most ``total rows /
rows_per_task`` entries, a bound that holds whatever the data. Counts come
from aggregates the plans compute anyway (partially aggregated, so a hot
key is one row per map task before its shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Session conf for the per-task row bound of one key (default one million).
ROWS_PER_TASK_CONF = "spark.rollcall.hotKeyRowsPerTask"
DEFAULT_ROWS_PER_TASK = 1_000_000

SALTS, SALT = "_salts", "_salt"


def rows_per_task(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(ROWS_PER_TASK_CONF, str(DEFAULT_ROWS_PER_TASK)))


def hot_keys(counts: DataFrame, keys: list[str], n_col: str, per_task: int) -> DataFrame:
    """Keys with more than ``per_task`` rows and their salt count."""
    return counts.filter(F.col(n_col) > per_task).select(
        *keys, F.ceil(F.col(n_col) / F.lit(per_task)).cast("int").alias(SALTS)
    )


def split_hot_join(
    big: DataFrame, small: DataFrame, keys: list[str], hot: DataFrame, row_id: list[str], how: str = "inner"
) -> DataFrame:
    """``big JOIN small USING keys`` (``inner`` or ``left_semi``) with hot keys
    spread over several tasks. ``small`` must hold one row per key."""
    h = F.broadcast(hot)
    salt = F.coalesce(F.pmod(F.xxhash64(*row_id), F.col(SALTS)).cast("int"), F.lit(0))
    b = big.join(h, keys, "left").withColumn(SALT, salt).drop(SALTS)
    reps = F.sequence(F.lit(0), F.coalesce(F.col(SALTS), F.lit(1)) - 1)
    s = small.join(h, keys, "left").withColumn(SALT, F.explode(reps)).drop(SALTS)
    return b.join(s, [*keys, SALT], how).drop(SALT)
