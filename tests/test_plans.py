"""Plan shape: no pair-producing joins, no Python, pushdown reaches the scan."""

from conftest import SF_SMALL

from rollcall.operators.clean import clean_export
from rollcall.plans.diagnose import diagnose
from rollcall.plans.reconcile import reconcile_zone
from rollcall.session import conf_scope
from rollcall.sources import derived


def _plan(df):
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _inputs(spark):
    return derived.userbase(spark, SF_SMALL), derived.roster(spark, SF_SMALL), derived.add_list(spark, SF_SMALL)


def test_reconcile_has_no_cartesian_or_python(spark):
    run = reconcile_zone(*_inputs(spark), zone="AMERICA")
    for df in (run.table, run.summary):
        p = _plan(df)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "ArrowEvalPython"):
            assert bad not in p, bad


def test_diagnose_has_no_cartesian(spark):
    d = diagnose(*_inputs(spark))
    for df in (d.report, d.summary):
        p = _plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_clean_pushes_email_filter_and_prunes_columns(spark, tmp_path):
    path = str(tmp_path / "export")
    derived.export(spark, SF_SMALL).write.parquet(path)
    cleaned = clean_export(spark.read.parquet(path))
    with conf_scope(spark, spark__sql__maxMetadataStringLength=10000):
        p = _plan(cleaned)
    pushed = p.split("PushedFilters: ")[1].split("\n")[0]
    read_schema = p.split("ReadSchema: ")[1].split("\n")[0]
    assert "StringContains(`Employee Email`,@)" in pushed, pushed
    assert "Segment Code" not in read_schema and "Nation Key" not in read_schema, read_schema


def test_blank_keys_never_reach_a_shuffle(spark):
    run = reconcile_zone(*_inputs(spark), zone="AMERICA")
    assert run.keys_u.filter("_key = ''").count() == 0


def _exchanged(plan: str) -> list[str]:
    return [line for line in plan.split("\n") if "Exchange" in line and "BroadcastExchange" not in line]


def test_keys_meet_the_probe_before_they_are_shuffled(spark):
    """Rows of the userbase's keys that are counted and joined follow the probe."""
    from rollcall.operators import match
    from rollcall.operators.prefilter import near

    ub, ros, add = _inputs(spark)
    few = ros.filter("_ord % 20 = 1")
    run = reconcile_zone(ub, few, None, zone="AMERICA")
    keys = ["_tier", "_key"]
    kept = near(run.keys_u, run.probe_n, keys)
    assert kept.count() <= run.probe_n.count() + 5 < run.keys_u.count() / 5
    assert kept.join(run.probe_n, keys, "left_semi").count() == run.keys_u.join(run.probe_n, keys, "left_semi").count()
    # One slot makes all keys neighbours: nothing may be lost by it.
    assert near(run.keys_u, run.probe_n, keys, slots=1).count() == run.keys_u.count()
    plan = _plan(match.key_counts(kept))
    before_shuffle = plan[: plan.index("Exchange hashpartitioning")] if "Exchange hashpartitioning" in plan else plan
    assert "_slot" in plan and "LeftSemi" in plan and before_shuffle


def test_one_clue_index(spark):
    """One scan of the userbase and one shuffle of candidates for all kinds of clues."""
    from rollcall.plans.diagnose import clue_index, unmatched_roster
    from rollcall.session import written_table

    ub, _, _ = _inputs(spark)
    hook = written_table(spark, "clue-test")
    stored = hook(ub)
    un = hook(unmatched_roster(stored, derived.roster_near_miss(spark, SF_SMALL)))
    found = clue_index(stored, un, {"email_domain": 3, "gid_zeros": 3, "name": 2})
    with conf_scope(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "Zone" not in line and "_gen" in line and "_rid" not in line]
    windows = [line for line in plan.split("\n") if " Window [" in line]
    assert len(scans) == 1 and len(windows) == 1, plan
    hook.cleanup()
