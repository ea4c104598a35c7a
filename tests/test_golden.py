"""The golden fixture: statuses, order and all nine counters."""

from fixture_rows import frames

from rollcall import schema as S
from rollcall.plans.diagnose import diagnose
from rollcall.plans.reconcile import reconcile_zone


def test_reconcile_golden(spark):
    ub, roster, add = frames(spark)
    run = reconcile_zone(ub, roster, add, zone="EUR")
    rows = run.table.orderBy(S.GEN, S.ORD).collect()
    got = [(r[S.GEN], r[S.ORD], r[S.STATUS]) for r in rows]
    assert got == [
        (0, 0, "validated"), (0, 2, "validated"), (0, 3, "validated"), (0, 4, "not found in zone"),
        (0, 5, "validated"), (0, 6, ""), (0, 9, "not found in zone"), (0, 10, ""),
        (0, 11, "not found in zone"), (1, 0, "newly added"), (1, 3, "newly added"),
    ]
    appended = {r[S.ORD]: r for r in rows if r[S.GEN] == 1}
    assert appended[0][S.ZONE] == "EUR" and appended[0][S.GLOBAL_ID] == "201"
    assert appended[3][S.ZONE] == "APAC"
    s = run.summary.first().asDict()
    assert s == {
        "zone": "EUR", "validated": 4, "not_found": 3, "removed": 2, "newly_added": 3,
        "skipped_existing": 1, "dedupe_removed": 2, "bad_roster_emails": 2, "bad_add_emails": 1,
        "blank_actions": 1,
    }


def test_reconcile_zone_from_roster_column(spark):
    ub, roster, add = frames(spark)
    from pyspark.sql import functions as F

    roster = roster.withColumn(S.ZONE, F.lit(" EUR "))
    run = reconcile_zone(ub, roster, add)
    assert run.zone == "EUR"


def test_diagnose_golden(spark):
    ub, roster, add = frames(spark)
    d = diagnose(ub.withColumn(S.GEN, __import__("pyspark.sql.functions", fromlist=["lit"]).lit(0)), roster, add)
    assert [r["_rid"] for r in d.unmatched.collect()] == [7]
    rep = sorted((r.kind, r.rank, r.detail) for r in d.report.collect())
    assert rep == [
        ("email_domain", 1, "lee@x.com"),
        ("gid_zeros", 1, "00111"),
        ("name", 1, "0:11|lee@x.com|00111|EUR-12"),
    ]
    s = d.summary.first().asDict()
    assert s == {"userbase_rows": 12, "roster_rows": 10, "add_rows": 5, "invalid_roster_emails": 2, "unmatched": 1}
