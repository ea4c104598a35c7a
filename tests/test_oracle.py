"""Every registered query against its DuckDB oracle (driver's gate, run here
at sf0.001 so the suite stays quick; the driver runs sf0.01)."""

import importlib

import pytest
from conftest import SF_SMALL

import oracle_check

E = importlib.import_module("__spark_entry__")


@pytest.fixture(scope="module")
def con():
    return oracle_check.duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems, _ = oracle_check.compare(spark, con, E, name, SF_SMALL)
    assert not problems, problems


def test_fixture_counts(spark):
    """FIXTURES.md section 3 numbers at sf0.001 and sf0.01."""
    from rollcall.plans.reconcile import reconcile_zone
    from rollcall.sources import derived

    for sf, rows, val, nf, rem in (("/root/testdata/sf0.001", 131, 63, 15, 19), ("/root/testdata/sf0.01", 1298, 637, 122, 187)):
        run = reconcile_zone(derived.userbase(spark, sf), derived.roster(spark, sf), derived.add_list(spark, sf), zone="AMERICA")
        s = run.summary.first()
        assert (run.table.count(), s.validated, s.not_found, s.removed) == (rows, val, nf, rem)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["zone", "country", "gid", "lid", "name", "email", "status", "gen", "ord"]
