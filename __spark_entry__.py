"""

``entry(spark)`` runs the flagship query (one zone reconcile) on sf0.001;
query over the given tables; ``oracle_sql()`` holds the DuckDB twin of each
(see ``oracle_sql.py``). Inputs are derived by Spark from ``customer``,
``nation``, ``region`` and ``supplier`` (``rollcall.sources.derived``), so
every query's work grows with those tables. Columns carry short aliases.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_sql as _oracle  # noqa: E402
from rollcall import schema as S  # noqa: E402
from rollcall.functions import (  # noqa: E402
    action_class,
    email_local_part,
    fold_name,
    in_zone,
    norm_email,
    norm_id_of,
    norm_local,
    strip,
    strip_leading_zeros,
    valid_email,
)
from rollcall.operators import clean, match, skew  # noqa: E402
from rollcall.operators.dedupe import dedupe_email, topk_per_key  # noqa: E402
from rollcall.operators.order import with_position  # noqa: E402
from rollcall.operators.zone import resolve_zones  # noqa: E402
from rollcall.plans import diagnose as diag  # noqa: E402
from rollcall.plans import jobs  # noqa: E402
from rollcall.plans.reconcile import reconcile_zone  # noqa: E402
from rollcall.session import scratch_path, written_table  # noqa: E402
from rollcall.sources import derived, files, snapshots, tabs  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"
ZONE = derived.TEST_ZONE

SHORT = {
    S.ZONE: "zone",
    "Country": "country",
    S.GLOBAL_ID: "gid",
    S.LOCAL_ID: "lid",
    S.NAME: "name",
    S.EMAIL: "email",
    S.STATUS: "status",
    "Employee Status": "emp_status",
    S.ACTION: "action",
    S.GEN: "gen",
    S.ORD: "ord",
    match.RID: "rid",
    match.ACT: "act",
    match.TIER: "tier",
    match.KEY: "key",
    match.V: "v",
    match.D: "d",
}
FINAL = ["zone", "country", "gid", "lid", "name", "email", "status", "gen", "ord"]


def short(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    cols = [F.col(c).alias(SHORT.get(c, c)) for c in df.columns]
    out = df.select(*cols)
    return out.select(*keep) if keep else out


def _inputs(spark, sf):
    return derived.userbase(spark, sf), derived.roster(spark, sf), derived.add_list(spark, sf)


# Materialisation points of a zone run, in the order the plan reaches them.
_STAGES = ("keyed", "probe", "probe_n", "exists_n", "hits", "row_flags", "groups", "dups")


def _run(spark, sf, materialize: str | None = "dups"):
    """The zone run over the derived inputs, writing the narrow fan-in tables
    (as the jobs do) up to and including ``materialize`` so no part of the
    plan a query needs is computed twice; later ones stay lazy."""
    ub, ros, add = _inputs(spark, sf)
    upto = _STAGES.index(materialize) + 1 if materialize else 0
    written = written_table(spark, "zone-run")
    seen = [0]

    def hook(df):
        seen[0] += 1
        return written(df) if seen[0] <= upto else df

    return reconcile_zone(ub, ros, add, zone=ZONE, materialize=hook)


def _diag(spark, sf, materialize: bool = False):
    ub, _, add = _inputs(spark, sf)
    ros = derived.roster_near_miss(spark, sf)
    hook = written_table(spark, "diagnose") if materialize else None
    return diag.diagnose(ub, ros, add, materialize=hook)


# ---- sources / sinks -------------------------------------------------------

def q_read_userbase(spark, sf):
    path = scratch_path(spark, "userbase-csv")
    files.write_delimited(derived.userbase(spark, sf), path)
    return short(files.read_userbase(spark, path), ["zone", "country", "gid", "lid", "name", "email", "status"])


def q_read_export(spark, sf):
    path = scratch_path(spark, "export-csv")
    files.write_delimited(derived.export(spark, sf), path)
    return short(files.read_export(spark, path), ["zone", "country", "gid", "lid", "name", "emp_status", "email"])


def _zone_workbook(spark, sf):
    base = scratch_path(spark, "workbooks")
    region = derived.table(spark, sf, "region")
    tabs.write_workbook(
        spark, base, "zones",
        [("Current users", derived.roster(spark, sf, everyone=True)), ("Info", region), ("to ADD", derived.add_list(spark, sf))],
    )
    return base


def q_read_tabs(spark, sf):
    zt = tabs.read_zone_tabs(spark, _zone_workbook(spark, sf), "zones")
    pick = lambda df, name: df.select(F.lit(name).alias("tab"), S.ORD, S.GLOBAL_ID, S.EMAIL)
    return short(pick(zt.roster, zt.roster_name).unionByName(pick(zt.add, zt.add_name)))


def q_read_export_sheet(spark, sf):
    base = scratch_path(spark, "export-book")
    tabs.write_workbook(
        spark, base, "export", [("Sheet1", derived.export(spark, sf)), ("Sheet2", derived.table(spark, sf, "nation"))]
    )
    first = clean.clean_export(tabs.read_first_tab(spark, base, "export"))
    return short(first, ["zone", "country", "gid", "lid", "name", "emp_status", "email"])


def q_write_snapshot(spark, sf):
    base = scratch_path(spark, "snapshots")
    snapshots.write_snapshot(derived.userbase(spark, sf), base, 0)
    run = _run(spark, sf)
    snapshots.write_snapshot(run.table, base, 1)
    return short(snapshots.read_snapshot(spark, base), FINAL)


def q_retain_previous(spark, sf):
    base = scratch_path(spark, "snapshots")
    jobs.ingest(spark, base, derived.userbase(spark, sf))
    _, ros, add = _inputs(spark, sf)
    jobs.run_zone(spark, base, ros, add, zone=ZONE)
    return short(snapshots.retain_previous(spark, base, 0), FINAL)


# ---- projections / predicates / scalars --------------------------------------

CLEAN = ["zone", "country", "gid", "lid", "name", "emp_status", "email", "gen", "ord"]


def q_project_required(spark, sf):
    return short(clean.project_required(derived.export(spark, sf)), CLEAN)


def q_clean_export(spark, sf):
    return short(clean.clean_export(derived.export(spark, sf)), CLEAN)


def _tagged(spark, sf, fn):
    ub, ros, add = _inputs(spark, sf)
    return fn(ub, "userbase").unionByName(fn(ros, "roster")).unionByName(fn(add, "add"))


def q_valid_email(spark, sf):
    return _tagged(spark, sf, lambda df, s: df.select(
        F.lit(s).alias("src"), F.col(S.ORD).alias("ord"), F.col(S.EMAIL).alias("email"),
        valid_email(S.EMAIL).alias("valid")))


def q_invalid_rows(spark, sf):
    ros, add = derived.roster(spark, sf, everyone=True), derived.add_list(spark, sf)
    pick = lambda df, s: clean.invalid_rows(df).select(
        F.lit(s).alias("src"), F.col(S.ORD).alias("ord"), F.col(S.EMAIL).alias("email"))
    return pick(ros, "roster").unionByName(pick(add, "add"))


def q_action_class(spark, sf):
    ros = derived.roster(spark, sf, everyone=True)
    return ros.select(F.col(S.ORD).alias("ord"), F.col(S.ACTION).alias("action"),
                      action_class(S.ACTION).alias("action_class"))


def q_in_zone(spark, sf):
    ub = derived.userbase(spark, sf)
    return ub.select(F.col(S.ORD).alias("ord"), F.col(S.ZONE).alias("zone"), in_zone(S.ZONE, ZONE).alias("in_zone"))


def _norm_query(col, fn):
    def q(spark, sf):
        return _tagged(spark, sf, lambda df, s: df.select(
            F.lit(s).alias("src"), F.col(S.ORD).alias("ord"), F.col(col).alias("raw"), fn(df, col).alias("norm")))
    return q


q_norm_id = _norm_query(S.GLOBAL_ID, norm_id_of)
q_norm_email = _norm_query(S.EMAIL, lambda df, c: norm_email(c))
q_norm_local = _norm_query(S.LOCAL_ID, lambda df, c: norm_local(c))


def q_strip(spark, sf):
    ros = derived.roster(spark, sf, everyone=True)
    out = None
    for c, name in ((S.EMAIL, "email"), (S.LOCAL_ID, "lid"), (S.ACTION, "action")):
        part = ros.select(F.lit(name).alias("col"), F.col(S.ORD).alias("ord"), F.col(c).alias("raw"),
                          strip(c).alias("stripped"))
        out = part if out is None else out.unionByName(part)
    return out


def q_email_local_part(spark, sf):
    ub = derived.userbase(spark, sf).select(S.ORD, norm_email(S.EMAIL).alias("email_norm"))
    return ub.filter(F.col("email_norm") != "").select(
        F.col(S.ORD).alias("ord"), "email_norm", email_local_part("email_norm").alias("local_part"))


def q_strip_leading_zeros(spark, sf):
    ub = derived.userbase(spark, sf)
    g = norm_id_of(ub, S.GLOBAL_ID)
    return ub.select(F.col(S.ORD).alias("ord"), g.alias("gid_norm"), strip_leading_zeros(g).alias("gid_nozeros"))


def q_fold_name(spark, sf):
    ros = derived.roster(spark, sf, everyone=True)
    return ros.select(F.col(S.ORD).alias("ord"), F.col(S.NAME).alias("name"), fold_name(S.NAME).alias("folded"))


# ---- joins -------------------------------------------------------------------

def q_key_index(spark, sf):
    ub = derived.userbase(spark, sf)
    return short(match.key_index(match.with_norm_keys(ub), S.GEN, S.ORD))


def q_cascade_match(spark, sf):
    return short(_run(spark, sf, "hits").winners)


def q_roster_match(spark, sf):
    run = _run(spark, sf, "hits")
    keys = [match.TIER, match.KEY]
    hot = skew.hot_keys(run.probe_n, keys, match.N, skew.rows_per_task(run.winners))
    sized = skew.split_hot_join(run.winners, run.exists_n.withColumnRenamed(match.N, "n_hits"), keys, hot, [match.RID])
    return short(sized.select(match.RID, *keys, "n_hits"))


def q_add_new_only(spark, sf):
    return short(_run(spark, sf, "hits").add_new, ["ord", "gid", "email"])


def q_add_existing(spark, sf):
    return short(_run(spark, sf, "hits").add_existing, ["ord", "gid", "email"])


def q_unmatched_roster(spark, sf):
    un = _diag(spark, sf).unmatched
    return un.select(F.col(match.RID).alias("rid"), F.col(S.EMAIL).alias("email"), F.col(S.GLOBAL_ID).alias("gid"),
                     F.col(S.LOCAL_ID).alias("lid"), F.col(match.E).alias("e"), F.col(match.G).alias("g"),
                     F.col(match.L).alias("l"))


def q_nearmiss_email(spark, sf):
    return short(_diag(spark, sf).email_clues)


def q_nearmiss_gid(spark, sf):
    return short(_diag(spark, sf).gid_clues)


def q_nearmiss_name(spark, sf):
    return short(_diag(spark, sf).name_clues)


# ---- aggregations / updates ---------------------------------------------------

def q_resolve_zone(spark, sf):
    return resolve_zones(derived.zone_rosters(spark, sf), "workbook")


def q_row_flags(spark, sf):
    return short(_run(spark, sf, "row_flags").row_flags, ["gen", "ord", "v", "d"])


def q_reconcile_summary(spark, sf):
    return _run(spark, sf).summary


def q_diagnose_summary(spark, sf):
    return _diag(spark, sf, materialize=True).summary


def q_removal_wins(spark, sf):
    d = _run(spark, sf, "row_flags").decided
    return d.filter("_ref").select(F.col(S.GEN).alias("gen"), F.col(S.ORD).alias("ord"),
                                   F.col("_val").alias("validated"), F.col("_del").alias("removed"))


def q_not_found(spark, sf):
    d = _run(spark, sf, "row_flags").decided
    return short(d.filter("_nf"), ["gen", "ord", "zone"])


def q_apply_status(spark, sf):
    from rollcall.operators.update import apply_status

    return short(apply_status(_run(spark, sf, "row_flags").decided), ["gen", "ord", "status"])


def q_remove_rows(spark, sf):
    from rollcall.operators.update import remove_rows

    return short(remove_rows(_run(spark, sf, "row_flags").decided), ["gen", "ord", "email"])


def q_append_new(spark, sf):
    return short(_run(spark, sf, "hits").appended, FINAL)


def q_dedupe_email(spark, sf):
    return short(dedupe_email(derived.userbase(spark, sf)), ["gen", "ord", "email"])


def q_topk_per_key(spark, sf):
    ub = derived.userbase(spark, sf)
    g = ub.select(norm_id_of(ub, S.GLOBAL_ID).alias("value")).filter(F.col("value") != "").distinct()
    g = g.withColumn("key", strip_leading_zeros("value"))
    return topk_per_key(g, "key", [F.col("value")], 3).select("key", "rank", "value")


def q_stable_order(spark, sf):
    t = with_position(_run(spark, sf).table, written_table(spark, "positions"))
    return short(t, ["position", "gen", "ord", "email", "status"])


def q_reconcile_zone(spark, sf):
    return short(_run(spark, sf).table, FINAL)


def q_run_zone(spark, sf):
    base = scratch_path(spark, "snapshots")
    jobs.ingest(spark, base, derived.export(spark, sf))
    _, ros, add = _inputs(spark, sf)
    res = jobs.run_zone(spark, base, ros, add, zone=ZONE, clean="auto")
    return short(res.table, ["zone", "country", "gid", "lid", "name", "emp_status", "email", "status", "gen", "ord"])


def q_nearmiss_report(spark, sf):
    return short(_diag(spark, sf, materialize=True).report)


def q_accumulate_zones(spark, sf):
    base = scratch_path(spark, "snapshots")
    jobs.ingest(spark, base, derived.userbase(spark, sf))
    _, ros, add = _inputs(spark, sf)
    res = jobs.accumulate_zones(
        spark, base, [(ros, add, ZONE), (derived.roster_second_zone(spark, sf), None, derived.SECOND_ZONE)]
    )
    return short(res[-1].table, FINAL)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "read_userbase": q_read_userbase,
    "read_export": q_read_export,
    "read_tabs": q_read_tabs,
    "read_export_sheet": q_read_export_sheet,
    "write_snapshot": q_write_snapshot,
    "retain_previous": q_retain_previous,
    "project_required": q_project_required,
    "clean_export": q_clean_export,
    "valid_email": q_valid_email,
    "invalid_rows": q_invalid_rows,
    "action_class": q_action_class,
    "in_zone": q_in_zone,
    "norm_id": q_norm_id,
    "norm_email": q_norm_email,
    "norm_local": q_norm_local,
    "strip": q_strip,
    "email_local_part": q_email_local_part,
    "strip_leading_zeros": q_strip_leading_zeros,
    "fold_name": q_fold_name,
    "key_index": q_key_index,
    "cascade_match": q_cascade_match,
    "roster_match": q_roster_match,
    "add_new_only": q_add_new_only,
    "add_existing": q_add_existing,
    "unmatched_roster": q_unmatched_roster,
    "nearmiss_email": q_nearmiss_email,
    "nearmiss_gid": q_nearmiss_gid,
    "nearmiss_name": q_nearmiss_name,
    "resolve_zone": q_resolve_zone,
    "row_flags": q_row_flags,
    "reconcile_summary": q_reconcile_summary,
    "diagnose_summary": q_diagnose_summary,
    "removal_wins": q_removal_wins,
    "not_found": q_not_found,
    "apply_status": q_apply_status,
    "remove_rows": q_remove_rows,
    "append_new": q_append_new,
    "dedupe_email": q_dedupe_email,
    "topk_per_key": q_topk_per_key,
    "stable_order": q_stable_order,
    "reconcile_zone": q_reconcile_zone,
    "run_zone": q_run_zone,
    "nearmiss_report": q_nearmiss_report,
    "accumulate_zones": q_accumulate_zones,
}


def _training_data() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the training-data operators, where those are installed."""
    try:
        import corpus_pipeline
        from rollcall.llm import queries as training
    except ModuleNotFoundError as e:
        if (e.name or "").startswith(("rollcall.llm", "corpus_pipeline")):
            return {}, {}
        raise
    runs = {**training.QUERIES, "pipeline": corpus_pipeline.run}
    return runs, {**training.ORACLE_SQL, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: one zone reconcile on sf0.001 (final table)."""
    return q_reconcile_zone(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_training_data()[0]}


def oracle_sql() -> dict[str, str]:
    return {**_oracle.queries(), **_training_data()[1]}
