"""Schema preconditions and edge cases of a zone run."""

import pytest
from fixture_rows import frames
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.operators.zone import resolve_zone
from rollcall.plans.reconcile import reconcile_zone


def test_missing_required_columns(spark):
    ub, roster, add = frames(spark)
    with pytest.raises(ValueError, match="Userbase: no column named Zone"):
        reconcile_zone(ub.drop(S.ZONE), roster, add, zone="EUR")
    with pytest.raises(ValueError, match="roster tab: no column named Employee Email"):
        reconcile_zone(ub, roster.drop(S.EMAIL), add, zone="EUR")
    with pytest.raises(ValueError, match="add tab: no column named Global Employee ID"):
        reconcile_zone(ub, roster, add.drop(S.GLOBAL_ID), zone="EUR")


def test_empty_add_list_without_columns_is_no_add(spark):
    ub, roster, add = frames(spark)
    empty = add.drop(S.GLOBAL_ID).filter(F.lit(False))
    run = reconcile_zone(ub, roster, empty, zone="EUR")
    assert run.summary.first().newly_added == 0


def test_zone_resolution(spark):
    ub, roster, _ = frames(spark)
    with pytest.raises(ValueError, match="has no column 'Zone'"):
        reconcile_zone(ub, roster, None)
    with pytest.raises(ValueError, match="names no zone"):
        reconcile_zone(ub, roster.withColumn(S.ZONE, F.lit(" ")), None)
    two = roster.withColumn(S.ZONE, F.when(F.col(S.ORD) % 2 == 0, "EUR").otherwise("APAC"))
    with pytest.raises(ValueError, match=r"names 2 zones \(APAC, EUR\)"):
        reconcile_zone(ub, two, None)
    many = spark.range(70).select(F.concat(F.lit("Z"), F.col("id")).alias(S.ZONE))
    with pytest.raises(ValueError, match=r"names 70 zones \(Z0, .* and 20 more\)"):
        resolve_zone(many)
    # A whitespace-only explicit zone resolves to '' and matches blank-zone rows.
    assert reconcile_zone(ub, roster, None, zone="  ").zone == ""


def test_no_action_column_validates_everything(spark):
    ub, roster, _ = frames(spark)
    run = reconcile_zone(ub, roster.drop("Action"), None, zone="EUR")
    s = run.summary.first()
    assert s.removed == 0 and s.blank_actions == 0
    # rows 0 and 8 (email), 1 (gid), 2 (local id), 3, 5 and 7 (email); row 7 of the roster matches nothing
    assert s.validated == 7 and s.not_found == 3 and s.dedupe_removed == 1


def test_action_column_found_case_insensitively(spark):
    ub, roster, _ = frames(spark)
    run = reconcile_zone(ub, roster.withColumnRenamed("Action", " ACTION "), None, zone="EUR")
    assert run.summary.first().removed == 2


def test_schema_helpers():
    assert S.find_action_column(["a", " action ", "Action"]) == " action "
    assert S.find_action_column(["a"]) is None
    assert S.is_prepared(["Zone", "status"]) and not S.is_prepared(["Zone", "Status"])
    assert S.missing_keep_columns(S.KEEP_COLUMNS[1:]) == ["Zone"]
