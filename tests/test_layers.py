"""Versions kept as layers of changes over a whole table."""

import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.plans import jobs
from rollcall.plans.reconcile import reconcile_zone
from rollcall.session import scratch_path, written_table
from rollcall.sources import derived, files, snapshots


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def _bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def _whole_runs(spark, runs):
    """The same runs, each from and to a whole table."""
    table, out = derived.userbase(spark, SF_SMALL), []
    hook = written_table(spark, "whole-runs")
    for gen, (roster, add, zone) in enumerate(runs, 1):
        table = hook(reconcile_zone(table, roster, add, zone=zone, gen=gen, materialize=hook).table)
        out.append(_rows(table))
    return out


def test_versions_read_from_layers_equal_whole_tables(spark, monkeypatch):
    monkeypatch.setattr(snapshots, "MAX_LAYERS", 2)
    base = scratch_path(spark, "layers")
    jobs.ingest(spark, base, derived.userbase(spark, SF_SMALL))
    roster, second, add = derived.roster(spark, SF_SMALL), derived.roster_second_zone(spark, SF_SMALL), derived.add_list(spark, SF_SMALL)
    # The later runs bring further people, one of them twice, and touch a row that a layer appended.
    more = add.withColumns({S.EMAIL: F.concat(F.lit("more"), F.floor(F.col(S.ORD) / 2).cast("string"), F.lit("@corp.com")), S.GLOBAL_ID: F.concat(F.lit("7"), S.ORD), S.LOCAL_ID: F.lit("")})
    again = more.limit(3).withColumn(S.ACTION, F.lit("Left"))
    runs = [(roster, add, "AMERICA"), (second, None, "EUROPE"), (second, more, "ASIA"), (again, None, "ASIA"), (roster, add, "AMERICA")]
    found = jobs.accumulate_zones(spark, base, runs)
    want = _whole_runs(spark, runs)
    for v, rows in enumerate(want, 1):
        assert _rows(snapshots.read_snapshot(spark, base, v)) == rows, v
    assert _rows(found[-1].table) == want[-1]
    chains = [len(snapshots.read_commit(spark, base, v).chain) for v in range(6)]
    assert chains == [1, 2, 3, 1, 2, 3] and all(snapshots.read_commit(spark, base, v).unique_emails for v in range(1, 6))
    assert found[2].summary["dedupe_removed"] > 0


def test_a_layer_is_as_large_as_its_changes(spark):
    base = scratch_path(spark, "small-layer").replace("file://", "")
    jobs.ingest(spark, base, derived.userbase(spark, "/root/testdata/sf0.01"))
    few = derived.roster(spark, "/root/testdata/sf0.01").limit(5)
    jobs.run_zone(spark, base, few, None, zone="NOWHERE")
    path = snapshots.snapshot_path(spark, base, 1)
    assert _bytes(path) < _bytes(snapshots.snapshot_path(spark, base, 0)) / 4
    status = spark.read.parquet(f"{path}/status")
    assert status.columns == [S.GEN, S.ORD, S.STATUS] and status.count() <= 10


def test_of_two_layers_one_commits(spark):
    base = scratch_path(spark, "layer-writers")
    jobs.ingest(spark, base, derived.userbase(spark, SF_SMALL))
    nothing = spark.createDataFrame([], f"{S.GEN} int, {S.ORD} bigint, {S.STATUS} string")
    layer = snapshots.Layer(nothing, nothing.drop(S.STATUS), None)
    snapshots.write_layer(spark, layer, base, 1, "a")
    with pytest.raises(ValueError):
        snapshots.write_layer(spark, layer, base, 1, "b")
    assert snapshots.version_of_run(spark, base, "a") == 1 and snapshots.version_of_run(spark, base, "b") is None
    assert _rows(snapshots.read_snapshot(spark, base)) == _rows(derived.userbase(spark, SF_SMALL))


def test_unique_emails_need_no_full_dedupe(spark):
    """With unique emails the dedupe sees appended emails only, and finds the same copies."""
    hook = written_table(spark, "unique")
    ub = hook(reconcile_zone(derived.userbase(spark, SF_SMALL), derived.roster(spark, SF_SMALL), None, zone="AMERICA", materialize=hook).table)
    add = derived.add_list(spark, SF_SMALL)
    args = (ub, derived.roster_second_zone(spark, SF_SMALL), add)
    full = reconcile_zone(*args, zone="EUROPE", gen=2, materialize=hook)
    quick = reconcile_zone(*args, zone="EUROPE", gen=2, materialize=hook, unique_emails=True)
    assert _rows(quick.dups) == _rows(full.dups) and full.dups.count() > 0
    assert _rows(quick.table) == _rows(full.table) and quick.summary.first() == full.summary.first()
    hook.cleanup()


def test_positions_are_dense_and_in_order(spark):
    from rollcall.operators.order import with_position

    rows = [(g, o * 7919 % 1000 + (o << 40) % 3, f"{g}-{o}") for g in (0, 1, 5) for o in range(200)]
    df = spark.createDataFrame(rows, f"{S.GEN} int, {S.ORD} bigint, v string").repartition(5)
    for ranges in (1, 3, 40):
        hook = written_table(spark, "positions-test")
        got = {r["v"]: r["position"] for r in with_position(df, hook, ranges).collect()}
        assert got == {v: i for i, (_, _, v) in enumerate(sorted(rows))}
        hook.cleanup()
    assert with_position(df.limit(0), written_table(spark, "positions-test")).count() == 0


def test_a_version_as_delimited_text(spark):
    base, path = scratch_path(spark, "export-base"), scratch_path(spark, "export-text")
    jobs.ingest(spark, base, derived.userbase(spark, SF_SMALL))
    jobs.export_delimited(spark, base, path)
    parts = sorted(f for f in os.listdir(path.replace("file://", "")) if f.endswith(".csv"))
    with open(os.path.join(path.replace("file://", ""), parts[0]), "rb") as f:
        assert f.read(3) == b"\xef\xbb\xbf"
    back = files.read_userbase(spark, path)
    want = snapshots.read_snapshot(spark, base)
    assert back.columns[:-2] == [c for c in want.columns if c not in (S.GEN, S.ORD)]
    assert _rows(back.drop(S.GEN, S.ORD)) == _rows(want.drop(S.GEN, S.ORD))


def test_keys_are_stored_once_and_follow_the_layers(spark, monkeypatch):
    """The second zone reads the keys that the first one stored, with the rows
    that went and came since, and does not scan the userbase for keys."""
    from rollcall.plans import reconcile

    base = scratch_path(spark, "keys")
    jobs.ingest(spark, base, derived.userbase(spark, SF_SMALL))
    roster, second, add = derived.roster(spark, SF_SMALL), derived.roster_second_zone(spark, SF_SMALL), derived.add_list(spark, SF_SMALL)
    assert snapshots.stored_keys(spark, base, snapshots.read_commit(spark, base, 0)) is None
    jobs.run_zone(spark, base, roster, add, zone="AMERICA")
    scans, row_keys = [], reconcile.row_keys
    monkeypatch.setattr(reconcile, "row_keys", lambda ub: scans.append(ub) or row_keys(ub))
    jobs.run_zone(spark, base, second, add.limit(3), zone="EUROPE")
    jobs.run_zone(spark, base, roster, add, zone="AMERICA")
    assert scans == []
    for v in (1, 2, 3):
        commit = snapshots.read_commit(spark, base, v)
        keys = snapshots.stored_keys(spark, base, commit)
        assert commit.keys_at == 1 and commit.keys == commit.chain[1]
        assert _rows(keys) == _rows(row_keys(snapshots.read_snapshot(spark, base, v))), v
        plan = keys._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan  # few rows went: they are broadcast


def test_counters_taken_while_writing_equal_the_summary(spark):
    """Observed counters against the summary as a job of its own, with and
    without an add list, unique emails, and rows that match nothing."""
    base = scratch_path(spark, "counters")
    jobs.ingest(spark, base, derived.userbase(spark, SF_SMALL))
    roster, second, add = derived.roster(spark, SF_SMALL), derived.roster_second_zone(spark, SF_SMALL), derived.add_list(spark, SF_SMALL)
    nobody = roster.limit(0)
    runs = [(roster, add, "AMERICA"), (nobody, None, "ASIA"), (second, add, "EUROPE")]
    for v, (r, a, z) in enumerate(runs):
        hook = written_table(spark, "counters-test")
        want = reconcile_zone(hook(snapshots.read_snapshot(spark, base, v)), r, a, zone=z, gen=v + 1, materialize=hook).summary.first().asDict()
        assert jobs.run_zone(spark, base, r, a, zone=z).summary == want, v
        hook.cleanup()


def test_a_run_that_fails_leaves_no_attempt(spark, monkeypatch):
    base = scratch_path(spark, "failing").replace("file://", "")
    jobs.ingest(spark, base, derived.userbase(spark, SF_SMALL))

    def fails(*args, **kwargs):
        raise RuntimeError("lost")

    before = os.listdir(f"{base}/data")
    monkeypatch.setattr(snapshots, "write_layer", fails)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.run_zone(spark, base, derived.roster(spark, SF_SMALL), None, zone="AMERICA")
    assert os.listdir(f"{base}/data") == before
