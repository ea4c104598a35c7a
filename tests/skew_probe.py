"""Run as a script with an event-log folder: zone run and diagnosis over people
of whom a third share one email, and a roster of whom a third share one local
part. Broadcasts are off and no partitions are merged, so that the log shows
what each task read."""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PEOPLE, BOUND, PARTITIONS = 40_000, 1_000, 64


def main(log: str) -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from rollcall import schema as S
    from rollcall.operators import match, skew
    from rollcall.plans import diagnose as diag
    from rollcall.plans.reconcile import reconcile_zone
    from rollcall.session import written_table

    conf = {
        "spark.master": "local[4]",
        "spark.ui.enabled": "false",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": f"file://{log}",
        "spark.eventLog.rolling.enabled": "false",
        "spark.eventLog.compress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(dir=log),
        "spark.sql.shuffle.partitions": str(PARTITIONS),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        skew.ROWS_PER_TASK_CONF: str(BOUND),
    }
    spark = SparkSession.builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    i, hot = F.col("id"), F.col("id") % 3 == 0
    text = lambda p: F.concat(F.lit(p), i.cast("string"))
    people = spark.range(PEOPLE).select(
        F.lit("EUR").alias(S.ZONE),
        text("").alias(S.GLOBAL_ID),
        F.when(hot, "hot@x.com").otherwise(F.concat(text("u"), F.lit("@x.com"))).alias(S.EMAIL),
        F.lit("").alias(S.STATUS),
        i.alias(S.ORD),
    )
    roster = spark.range(PEOPLE).select(
        text("g").alias(S.GLOBAL_ID),
        F.when(hot, F.concat(F.lit("hot@"), text("y"))).when(i % 3 == 1, "HOT@x.com").otherwise(F.concat(text("u"), F.lit("@x.com"))).alias(S.EMAIL),
        F.lit("ok").alias(S.ACTION),
        i.alias(S.ORD),
    )
    keep = written_table(spark, "probe")
    run = reconcile_zone(people, roster, None, zone="EUR", materialize=keep)
    keys = [match.TIER, match.KEY]
    hot_winners = skew.hot_keys(run.probe_n, keys, match.N, BOUND)
    skew.split_hot_join(run.winners, run.exists_n, keys, hot_winners, [match.RID]).write.format("noop").mode("overwrite").save()
    run.table.write.format("noop").mode("overwrite").save()
    found = diag.diagnose(people.withColumn(S.GEN, F.lit(0)), roster, materialize=keep)
    found.email_clues.write.format("noop").mode("overwrite").save()
    spark.stop()


def largest_reads(log: str) -> list[int]:
    """The largest number of shuffled rows that a task read, by stage."""
    most: dict[int, int] = {}
    for name in os.listdir(log):
        path = os.path.join(log, name)
        if os.path.isfile(path) and not name.startswith("."):
            for line in open(path, errors="replace"):
                if '"SparkListenerTaskEnd"' in line:
                    e = json.loads(line)
                    rows = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                    most[e["Stage ID"]] = max(most.get(e["Stage ID"], 0), rows)
    return sorted(most.values())


if __name__ == "__main__":
    main(sys.argv[1])
