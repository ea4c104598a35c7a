"""Dense positions of rows in the table's order.

Rows are dealt into ranges of ``(_gen, _ord)`` and written with the number of their
range; the ranges' counts, one row per range, are summed up in order, and a row's
position is the sum before its range plus its place in it. No task sees more than
a range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall import schema as S

POSITION = "position"
RANGE = "_range"


def with_position(df: DataFrame, materialize, ranges: int | None = None) -> DataFrame:
    """Adds ``position``: 0 to n-1 in ``(_gen, _ord)`` order.

    ``materialize`` (``session.written_table``) fixes the ranges, whose bounds
    Spark samples anew each time it plans them. ``ranges`` is the number of
    them, by default ``spark.sql.shuffle.partitions``."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = materialize(df.repartitionByRange(n, S.GEN, S.ORD).withColumn(RANGE, F.spark_partition_id()))
    # One row per range, of which there are `n` at most.
    counts = dealt.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(counts.select(RANGE, before.alias("_before")))
    place = F.row_number().over(Window.partitionBy(RANGE).orderBy(S.GEN, S.ORD))
    return dealt.withColumn("_place", place).join(offsets, RANGE).withColumn(POSITION, F.col("_before") + F.col("_place") - 1).drop(RANGE, "_place", "_before")
