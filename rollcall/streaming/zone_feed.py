"""Zone rosters as a stream: each published run is one zone run, in order.

The reference is run by hand once per zone; here a run's tabs land as parquet
in folders of its own,

    <landing>/runs/<run>/roster/ and, if there is one, .../add/
    <landing>/manifest/<run>.json

and its manifest is written last, in one step. The stream reads manifests
only, so a run is seen when all of it is there, however many files it has
and whenever they came. ``foreachBatch`` applies the runs of a micro-batch in
the order of their ids with ``plans.jobs.run_zone`` (one distributed job per
run, never per row). Ids must be published in order.

Exactly once: the run's id is part of the commit of the version it makes
(``sources.snapshots``). A replayed micro-batch skips the runs whose id is in
a commit and applies the rest.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from rollcall import schema as S
from rollcall.plans.jobs import run_zone
from rollcall.sources import snapshots

MANIFEST = "run string, zone string, has_add boolean"


def _tab(landing: str, run: str, tab: str) -> str:
    return f"{landing.rstrip('/')}/runs/{run}/{tab}"


def land(df: DataFrame, landing: str, run: str, tab: str) -> None:
    """Write one tab (``roster`` or ``add``) of a run, or more rows of it."""
    cols = [S.qcol(c).cast("bigint" if c == S.ORD else "string").alias(c) for c in df.columns]
    df.select(*cols).write.mode("append").parquet(_tab(landing, run, tab))


def publish(spark: SparkSession, landing: str, run: str, zone: str | None) -> None:
    """Announce a run whose tabs have landed. A run is published once."""
    fs, jvm = snapshots._fs(spark, landing)
    has_add = fs.exists(jvm.org.apache.hadoop.fs.Path(_tab(landing, run, "add")))
    text = json.dumps({"run": run, "zone": zone, "has_add": bool(has_add)})
    if not snapshots.write_once(spark, f"{landing.rstrip('/')}/manifest/{run}.json", text):
        raise ValueError(f"run {run} is published already")


def apply_batch(spark: SparkSession, landing: str, base: str, batch: DataFrame, clean: str = "auto") -> list:
    """Apply the runs of one micro-batch of manifests; returns the results."""
    results = []
    for m in batch.orderBy("run").toLocalIterator():
        if snapshots.version_of_run(spark, base, m.run) is not None:
            continue
        roster = spark.read.parquet(_tab(landing, m.run, "roster"))
        add = spark.read.parquet(_tab(landing, m.run, "add")) if m.has_add else None
        results.append(run_zone(spark, base, roster, add, zone=m.zone, clean=clean, run_id=m.run))
    return results


def start(spark: SparkSession, landing: str, base: str, checkpoint: str, clean: str = "auto", once: bool = False):
    """Start the stream. ``once=True`` processes what has been published and
    stops (``availableNow``); otherwise it keeps watching."""
    manifests = spark.readStream.schema(MANIFEST).option("maxFilesPerTrigger", 100).json(f"{landing.rstrip('/')}/manifest")
    writer = manifests.writeStream.foreachBatch(lambda df, epoch: apply_batch(spark, landing, base, df, clean) and None).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")
    return writer.start()
