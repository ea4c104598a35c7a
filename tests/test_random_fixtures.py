"""Random small fixtures with colliding keys: the Spark plan against the
brute-force statement, plus the row-count invariant."""

import random

import bruteforce
import pytest

from rollcall import schema as S
from rollcall.plans.reconcile import reconcile_zone

EMAILS = ["a@x", "A@X ", " mailto:a@x", "b@x", "noemail@x", "", None, "c@y", "<b@x>", "d@x", "noat"]
GIDS = ["1", "1.0", "001", "2", "", None, "3", "3.0"]
LIDS = ["L1", " l1 ", "L2", "", None, "l3"]
ZONES = ["EUR", "eur ", "APAC", "", None]
ACTIONS = ["ok", " OK ", "", None, "remove", "Left"]


def _fixture(rnd):
    ub = [dict(ord=i, zone=rnd.choice(ZONES), gid=rnd.choice(GIDS), lid=rnd.choice(LIDS),
               email=rnd.choice(EMAILS), status=rnd.choice(["", "validated", None]))
          for i in range(rnd.randint(0, 12))]
    ros = [dict(ord=i, gid=rnd.choice(GIDS), lid=rnd.choice(LIDS), email=rnd.choice(EMAILS),
                action=rnd.choice(ACTIONS)) for i in range(rnd.randint(1, 9))]
    add = [dict(ord=i, zone=rnd.choice(ZONES), gid=rnd.choice(GIDS), lid=rnd.choice(LIDS),
                email=rnd.choice(EMAILS)) for i in range(rnd.randint(0, 5))]
    return ub, ros, add


def _frame(spark, rows, cols):
    names = {"zone": S.ZONE, "gid": S.GLOBAL_ID, "lid": S.LOCAL_ID, "email": S.EMAIL,
             "status": S.STATUS, "action": "Action", "ord": S.ORD}
    schema = ", ".join(f"`{names[c]}` {'bigint' if c == 'ord' else 'string'}" for c in cols)
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)


@pytest.mark.parametrize("seed", range(10))
def test_random_fixture_matches_bruteforce(spark, seed):
    rnd = random.Random(seed)
    ub, ros, add = _fixture(rnd)
    want_rows, want_counts = bruteforce.run(ub, ros, add, "EUR")
    run = reconcile_zone(
        _frame(spark, ub, ["zone", "gid", "lid", "email", "status", "ord"]),
        _frame(spark, ros, ["gid", "lid", "email", "action", "ord"]),
        _frame(spark, add, ["zone", "gid", "lid", "email", "ord"]),
        zone="EUR",
    )
    got = sorted(
        (r[S.GEN], r[S.ORD], r[S.STATUS], r[S.ZONE], r[S.GLOBAL_ID], r[S.EMAIL]) for r in run.table.collect()
    )
    assert got == sorted(want_rows)
    counts = run.summary.first().asDict()
    counts.pop("zone")
    assert counts == want_counts
    # rows out = rows in - removed + newly added - dedupe removed
    assert len(got) == len(ub) - counts["removed"] + counts["newly_added"] - counts["dedupe_removed"]


def test_result_independent_of_partitioning_and_row_order(spark):
    from pyspark.sql import functions as F

    from rollcall.functions import norm_email
    from rollcall.sources import derived

    sf = "/root/testdata/sf0.001"
    ub, ros, add = derived.userbase(spark, sf), derived.roster(spark, sf), derived.add_list(spark, sf)

    def result(u, r, a):
        run = reconcile_zone(u, r, a, zone="AMERICA")
        return sorted(tuple(x) for x in run.table.collect()), run

    base, run = result(ub, ros, add)
    shuffled, _ = result(
        ub.repartition(7).orderBy(F.rand(3)), ros.repartition(5).orderBy(F.rand(4)), add.repartition(3)
    )
    assert base == shuffled
    t = run.table.withColumn("_e", norm_email(S.EMAIL)).filter("_e != ''")
    assert t.groupBy("_e").count().filter("count > 1").count() == 0
    assert run.decided.filter("_val AND _del").count() == 0
