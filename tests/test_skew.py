"""A third of the userbase shares one email: results stay exact and the hot
key is split across tasks (salted join), not gathered into one."""

import bruteforce

from rollcall import schema as S
from rollcall.plans.reconcile import reconcile_zone
from rollcall.session import conf_scope


def _rows(n):
    ub, ros = [], []
    for i in range(n):
        hot = i % 3 == 0
        ub.append(dict(ord=i, zone="EUR" if i % 2 else "APAC", gid=str(1000 + i), lid=f"L{i}",
                       email="hot@x.com" if hot else f"u{i}@x.com", status=""))
    for j in range(n // 10):
        ros.append(dict(ord=j, gid=str(1000 + 7 * j), lid="", email="HOT@x.com" if j % 3 == 0 else f"r{j}@y.com",
                        action="ok" if j % 4 else "remove"))
    return ub, ros


def _frame(spark, rows, cols):
    names = {"zone": S.ZONE, "gid": S.GLOBAL_ID, "lid": S.LOCAL_ID, "email": S.EMAIL,
             "status": S.STATUS, "action": "Action", "ord": S.ORD}
    schema = ", ".join(f"`{names[c]}` {'bigint' if c == 'ord' else 'string'}" for c in cols)
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema).repartition(4)


def split_counts(run):
    from pyspark.sql import functions as F

    from rollcall.operators import skew

    n = run.keys_u.groupBy("_tier", "_key").count().withColumnRenamed("count", "_n")
    hot = skew.hot_keys(n, ["_tier", "_key"], "_n", 50).filter(F.col("_key") == "hot@x.com")
    return hot.first()["_salts"]


def test_hot_email_is_exact_and_split(spark):
    ub, ros = _rows(3000)
    want_rows, want_counts = bruteforce.run(ub, ros, [], "EUR")
    with conf_scope(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__rollcall__hotKeyRowsPerTask="50",
    ):
        run = reconcile_zone(
            _frame(spark, ub, ["zone", "gid", "lid", "email", "status", "ord"]),
            _frame(spark, ros, ["gid", "lid", "email", "action", "ord"]),
            None,
            zone="EUR",
        )
        got = sorted((r[S.GEN], r[S.ORD], r[S.STATUS], r[S.ZONE], r[S.GLOBAL_ID], r[S.EMAIL]) for r in run.table.collect())
        plan = run.table._jdf.queryExecution().executedPlan().toString()
        counts = run.summary.first().asDict()
        # The hot email (1,000 userbase rows) is spread over 20 salts.
        hot = split_counts(run)
    assert got == sorted(want_rows)
    counts.pop("zone")
    for k in ("validated", "not_found", "removed", "dedupe_removed", "blank_actions"):
        assert counts[k] == want_counts[k], k
    assert "_salt" in plan
    assert hot == 20


def test_no_task_gathers_a_hot_key(tmp_path):
    """Rows read by each task, from the event log: 13,000 rows share one email,
    and as many roster rows one local part, with a bound of 1,000 a task."""
    import subprocess
    import sys

    import skew_probe

    subprocess.run([sys.executable, skew_probe.__file__, str(tmp_path)], check=True, timeout=900, capture_output=True)
    reads = skew_probe.largest_reads(str(tmp_path))
    even = 2 * skew_probe.PEOPLE / skew_probe.PARTITIONS  # two keys a row
    assert reads and reads[-1] <= 3 * skew_probe.BOUND + 2 * even, reads[-10:]
