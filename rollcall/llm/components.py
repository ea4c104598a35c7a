"""Connected components of a graph held in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.skew import hot_keys, rows_per_task, split_hot_join
from rollcall.session import written_table


def tied(edges: DataFrame, keep) -> DataFrame:
    """The edges (a, b) with ``m``: the smallest of a and all its b. A node with
    very many edges is split over tasks."""
    least = keep(edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")))
    hot = hot_keys(least, ["a"], "n", rows_per_task(edges))
    return split_hot_join(edges, least.select("a", F.least("a", "m").alias("m")), ["a"], hot, ["b"])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node that an edge (a, b) touches; the
    component is its smallest node.

    Each round every node points at the smallest node among its neighbours
    and itself ("large star"), then the neighbours not above it are joined to
    the smallest of them ("small star"). The edges of a round are written to
    the session's shared folder, which cuts the lineage; the loop ends when a
    round changes nothing. A hub's neighbours are only ever reduced to their
    minimum by a partial aggregate, and joined back to it in several tasks.
    """
    spark = edges.sparkSession
    held = written_table(spark, name)
    now = held(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = None
    while True:
        keep = written_table(spark, name)
        both = now.union(now.select("b", "a"))
        large = keep(tied(both.select("a", "b"), keep).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        small = tied(large, keep)
        now = keep(small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").union(small.select("a", F.col("m").alias("b"))).distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("bigint")), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        held.cleanup()  # this round's edges are written: the last round's go
        held = keep
        if state == before:
            break
        before = state
    star = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return star.union(star.select("component", "component").distinct())
