"""Readers, tab tables, snapshots, jobs and the streaming feed."""

import importlib

import pytest
from conftest import SF_SMALL

import oracle_check
from rollcall import schema as S
from rollcall.plans import jobs
from rollcall.session import conf_scope, scratch_path
from rollcall.sources import csv_records, derived, files, snapshots, tabs
from rollcall.streaming import zone_feed

E = importlib.import_module("__spark_entry__")


def test_csv_ordinal_is_file_order_across_splits(spark):
    path = scratch_path(spark, "csv-order")
    ub = derived.userbase(spark, "/root/testdata/sf0.01")
    # Several part files, each split into many small splits at read time.
    ub.repartitionByRange(3, S.ORD).sortWithinPartitions(S.ORD).drop(S.GEN, S.ORD) \
        .write.option("header", True).csv(path)
    with conf_scope(spark, spark__sql__files__maxPartitionBytes=4096, spark__sql__files__openCostInBytes=1024):
        df = files.read_userbase(spark, path)
        rows = df.select(S.LOCAL_ID, S.ORD).collect()
        assert df.rdd.getNumPartitions() > 6
    ords = [r[S.ORD] for r in rows]
    assert len(set(ords)) == len(ords) == 1500
    by_ord = [int(r[S.LOCAL_ID][2:]) for r in sorted(rows, key=lambda r: r[S.ORD])]
    assert by_ord == sorted(by_ord)


def test_csv_reads_blanks_as_empty_text(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("﻿Zone,Employee Email,Global Employee ID\nEUR,,00123\n,a@b,NA\n", encoding="utf-8")
    rows = files.read_delimited(spark, str(p)).orderBy(S.ORD).collect()
    assert [(r[S.ZONE], r[S.EMAIL], r[S.GLOBAL_ID]) for r in rows] == [("EUR", "", "00123"), ("", "a@b", "NA")]


def test_select_tabs_rules():
    names = ["Roster", "Notes", "To Add", "add more"]
    assert tabs.select_tabs(names) == ("Roster", "To Add")
    assert tabs.select_tabs(names, roster_tab=" notes ") == ("Notes", "To Add")
    assert tabs.select_tabs(names, add_tab="ADD MORE") == ("Roster", "add more")
    assert tabs.select_tabs(["Only"]) == ("Only", None)
    with pytest.raises(ValueError):
        tabs.select_tabs(names, roster_tab="missing")
    with pytest.raises(ValueError):
        tabs.select_tabs([])


def test_snapshots_are_versioned_and_immutable(spark):
    base = scratch_path(spark, "snap")
    ub = derived.userbase(spark, SF_SMALL)
    snapshots.write_snapshot(ub, base, 0)
    assert snapshots.versions(spark, base) == [0]
    with pytest.raises(Exception):
        snapshots.write_snapshot(ub, base, 0)
    assert snapshots.read_snapshot(spark, base).count() == ub.count()


def test_clean_decision():
    assert jobs.should_clean(["Zone"], "auto") is True
    assert jobs.should_clean(["Zone", "status"], "auto") is False
    assert jobs.should_clean(["Zone", "status"], "force") is True
    assert jobs.should_clean(["Zone"], "never") is False
    with pytest.raises(ValueError):
        jobs.should_clean([], "sometimes")


def _rows(df):
    return oracle_check.rows_of(df.columns, [tuple(r) for r in df.collect()])


def test_stream_equals_sequential_runs(spark):
    """Run 001 lands as 150 files, its add list after the stream first looked."""
    base, landing, ckpt = (scratch_path(spark, n) for n in ("stream-base", "landing", "stream-ckpt"))
    jobs.ingest(spark, base, derived.userbase(spark, SF_SMALL))

    def drain():
        zone_feed.start(spark, landing, base, ckpt, once=True).awaitTermination(600)

    zone_feed.land(derived.roster(spark, SF_SMALL).repartition(150), landing, "001", "roster")
    zone_feed.land(derived.roster_second_zone(spark, SF_SMALL), landing, "002", "roster")
    spark.sparkContext._jvm.java.io.File(landing.replace("file:", "") + "/manifest").mkdirs()
    drain()
    assert snapshots.versions(spark, base) == [0]  # nothing is published
    zone_feed.land(derived.add_list(spark, SF_SMALL), landing, "001", "add")
    zone_feed.publish(spark, landing, "001", "AMERICA")
    drain()
    zone_feed.publish(spark, landing, "002", "EUROPE")
    drain()
    assert snapshots.versions(spark, base) == [0, 1, 2]
    got = E.short(snapshots.read_snapshot(spark, base), E.FINAL)
    con = oracle_check.duck(SF_SMALL)
    rel = con.execute(E.oracle_sql()["accumulate_zones"])
    assert _rows(got) == oracle_check.rows_of([c[0] for c in rel.description], rel.fetchall())
    # A replayed batch does not apply a run twice, and a run is published once.
    batch = spark.read.schema(zone_feed.MANIFEST).json(f"{landing}/manifest")
    assert batch.count() == 2 and zone_feed.apply_batch(spark, landing, base, batch) == []
    with pytest.raises(ValueError):
        zone_feed.publish(spark, landing, "001", "AMERICA")


def test_duplicate_headers_keep_the_first(spark, tmp_path):
    p = tmp_path / "dup.csv"
    p.write_text("Zone,Employee Email,Zone,\"Global Employee ID\"\nEUR,a@b,APAC,7\n", encoding="utf-8")
    df = files.read_delimited(spark, str(p))
    assert df.columns[:4] == ["Zone", "Employee Email", "Zone.1", "Global Employee ID"]
    r = df.first()
    assert (r["Zone"], r["Zone.1"], r["Global Employee ID"]) == ("EUR", "APAC", "7")
    assert files.dedupe_names(["a", "a", "a.1", "a"]) == ["a", "a.2", "a.1", "a.3"]


def test_diagnose_zone_job(spark):
    base = scratch_path(spark, "diag-base")
    jobs.ingest(spark, base, derived.userbase(spark, SF_SMALL))
    d = jobs.diagnose_zone(spark, base, derived.roster_near_miss(spark, SF_SMALL), derived.add_list(spark, SF_SMALL))
    got = E.short(d.report)
    con = oracle_check.duck(SF_SMALL)
    rel = con.execute(E.oracle_sql()["nearmiss_report"])
    want = oracle_check.rows_of([c[0] for c in rel.description], rel.fetchall())
    assert oracle_check.rows_of(got.columns, [tuple(r) for r in got.collect()]) == want
    assert snapshots.versions(spark, base) == [0]


def test_crashed_run_is_applied_after_another_one(spark, monkeypatch):
    """A run that dies before its commit leaves no trace; another run takes
    its version, and the feed still applies it."""
    base, landing = scratch_path(spark, "crash-base"), scratch_path(spark, "crash-landing")
    jobs.ingest(spark, base, derived.userbase(spark, SF_SMALL))
    zone_feed.land(derived.roster(spark, SF_SMALL), landing, "001", "roster")
    zone_feed.publish(spark, landing, "001", "AMERICA")
    batch = spark.read.schema(zone_feed.MANIFEST).json(f"{landing}/manifest")

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(snapshots, "write_once", dies)
        with pytest.raises(RuntimeError):
            zone_feed.apply_batch(spark, landing, base, batch)
    assert snapshots.versions(spark, base) == [0] and snapshots.version_of_run(spark, base, "001") is None
    jobs.run_zone(spark, base, derived.roster_second_zone(spark, SF_SMALL), None, zone="EUROPE")
    assert [r.version for r in zone_feed.apply_batch(spark, landing, base, batch)] == [2]
    assert snapshots.version_of_run(spark, base, "001") == 2
    assert zone_feed.apply_batch(spark, landing, base, batch) == []


def test_of_two_writers_one_commits(spark):
    base = scratch_path(spark, "writers")
    df = spark.range(3)
    snapshots.write_snapshot(df, base, 0)
    assert not snapshots.write_once(spark, snapshots._commit_path(base, 0), "{}")
    with pytest.raises(ValueError):
        snapshots.write_snapshot(df, base, 0, "x")


def test_csv_quotes_breaks_and_spaces(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text('Zone,Employee Name,"Employee\nEmail",Global Employee ID\nEUR,"Smith, ""Bob"", Jr",a@b,1\n EUR ,"two\nlines"," x\\",2\n', encoding="utf-8")
    rows = files.read_delimited(spark, str(p)).orderBy(S.ORD).collect()
    assert [tuple(r)[:4] for r in rows] == [("EUR", 'Smith, "Bob", Jr', "a@b", "1"), (" EUR ", "two\nlines", " x\\", "2")]


def test_csv_round_trip_keeps_values(spark):
    values = [("\" mailto:A@x \"", " a,b ", 0), ("", 'q"q', 1), (" ", "\\", 2), ("é\u00a0", "'", 3)]
    path = scratch_path(spark, "round-trip")
    files.write_delimited(spark.createDataFrame(values, f"a string, b string, {S.ORD} bigint"), path)
    back = files.read_delimited(spark, path).orderBy(S.ORD).collect()
    assert [(r.a, r.b) for r in back] == [v[:2] for v in values]


def _table(rng, n):
    """Rows whose values hold breaks, quotes, separators and blanks, some of them long."""
    kinds = ["plain", "", " ", "two\nlines", "a,b", 'q"q', '"', "\n\n", "x\r\ny", ',"', '",\n"', "é\u2028", "long " * 40 + "\n" + "tail " * 30, "\n".join("many" * 9 for _ in range(40))]
    return [[str(i), *(rng.choice(kinds) for _ in range(3))] for i in range(n)]


@pytest.mark.parametrize(("ending", "split"), [("\n", 300), ("\r\n", 1024)])
def test_csv_breaks_in_quotes_across_splits(spark, tmp_path, ending, split):
    """Equal to pandas' rows, in file order, on files of very many splits."""
    import csv
    import random

    import pandas as pd

    want = []
    for k in range(3):
        rows = _table(random.Random(k), 60) if k < 2 else [[str(i), "x", "y", 'z "z"'] for i in range(60)]
        with open(tmp_path / f"{k} é%+[a].csv", "w", newline="", encoding="utf-8") as f:
            f.write("\ufeff" if k == 0 else "")
            w = csv.writer(f, lineterminator=ending)
            w.writerows([["id", "a b", "b", "c"], *rows])
        found = pd.read_csv(tmp_path / f"{k} é%+[a].csv", dtype=str, keep_default_na=False, encoding="utf-8-sig")
        want += [tuple(r) for r in found.itertuples(index=False)]
        assert [list(r) for r in want[-60:]] == rows
    with conf_scope(spark, spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes=1):
        df = files.read_delimited(spark, str(tmp_path))
        got = [tuple(r)[:4] for r in sorted(df.collect(), key=lambda r: r[S.ORD])]
        parts = df.rdd.getNumPartitions()
    assert got == want and parts > 10


def test_csv_states_of_splits(spark):
    """The prefix over splits against walking through them."""
    import itertools

    kinds = [(0, 1), (1, 0), (0, 0), (1, 1)]
    rows, want = [], {}
    for k, effects in enumerate(itertools.product(kinds, repeat=4)):
        state = 0
        for i, (a, b) in enumerate(effects):
            rows.append((str(k), i * 10, a, b))
            want[str(k), i * 10] = state
            state = (a, b)[state]
    df = csv_records.split_states(spark.createDataFrame(rows, "path string, start bigint, after_outside int, after_inside int"))
    assert {(r["path"], r["start"]): r["state"] for r in df.collect()} == want


def test_csv_quotes_amid_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n5" pipe,x\n"in\nside",7"\n\n   \n"last\n\nline",\n"open\nend,1\n')
    rows = files.read_delimited(spark, str(tmp_path)).orderBy(S.ORD).collect()
    assert [(r.a, r.b) for r in rows][:3] == [('5" pipe', "x"), ("in\nside", '7"'), ("last\n\nline", "")] and len(rows) == 4
    assert csv_records.ends_inside('"a', False, ",") and csv_records.ends_inside('a;"b""', False, ";")
    assert not csv_records.ends_inside('a"b', False, ",") and not csv_records.ends_inside('x"', True, ",") and csv_records.ends_inside('x","', True, ",")


def test_csv_record_longer_than_splits(spark, tmp_path):
    """One value over very many splits, most of which hold no quote."""
    long = "line of a long value\n" * 3000
    (tmp_path / "a.csv").write_text(f'a,b\n1,"{long}"\n2,x\n"{long}",3\n')
    with conf_scope(spark, spark__sql__files__maxPartitionBytes=4096, spark__sql__files__openCostInBytes=1):
        rows = files.read_delimited(spark, str(tmp_path)).orderBy(S.ORD).collect()
    assert [(r.a, r.b) for r in rows] == [("1", long), ("2", "x"), (long, "3")]


def test_csv_other_encodings(spark, tmp_path):
    for name in ("latin-1", "utf-16"):
        p = tmp_path / f"{name}.csv"
        p.write_text('a,b\n"é\nü",1\n', encoding=name)
        assert [(r.a, r.b) for r in files.read_delimited(spark, str(p), encoding={"latin-1": "ISO-8859-1"}.get(name, name)).collect()] == [("é\nü", "1")]


def test_csv_headers_with_breaks_are_checked(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"Zone\nname",b\n"x\ny",1\n')
    (tmp_path / "b.csv").write_text('"Zone\nname",b\n"z\n",2\n')
    assert {tuple(r)[:2] for r in files.read_delimited(spark, str(tmp_path)).collect()} == {("x\ny", "1"), ("z\n", "2")}
    (tmp_path / "c.csv").write_text('b,"Zone\nname"\n2,"z\n"\n')
    with pytest.raises(Exception, match="CSV header"):
        files.read_delimited(spark, str(tmp_path)).collect()


def test_csv_files_with_other_columns_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Zone,Employee Email\nEUR,a@b\n")
    (tmp_path / "b.csv").write_text("Employee Email,Zone\nc@d,APAC\n")
    with pytest.raises(Exception, match="CSV header"):
        files.read_delimited(spark, str(tmp_path)).collect()


def test_packed_splits_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Zone\nEUR\n")
    with conf_scope(spark, spark__sql__files__maxPartitionNum=1), pytest.raises(ValueError, match="maxPartitionNum"):
        files.read_delimited(spark, str(tmp_path))


def test_zones_csv_is_the_roster(spark, tmp_path):
    p = tmp_path / "zones.csv"
    p.write_text("Employee Email,Global Employee ID,Action\na@b,1,ok\n")
    zt = tabs.read_zone_csv(spark, str(p))
    assert zt.add is None and zt.add_name is None
    assert [r[S.EMAIL] for r in zt.roster.collect()] == ["a@b"] and S.ORD in zt.roster.columns


def test_shared_folder_is_needed_on_a_cluster():
    from types import SimpleNamespace

    from rollcall.session import shared_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context))
