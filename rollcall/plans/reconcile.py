"""One zone run as one declarative plan (pure: DataFrames in, DataFrames out).

Shape of the plan (every arrow a Spark operator, no driver loop):

    userbase --narrow--> keyed_u(_gen,_ord, three keys)   (the one key scan)
    keyed_u --> keys_u(_tier,_key,_gen,_ord)              (blank keys dropped)
    roster/add --narrow--> probe keys
    keys_u that may meet a probe key (broadcast slots), count per key,
        SEMI distinct probe keys -> exists (hot keys collapse map-side)
    probe SEMI exists, min(struct(tier,key)) per probe row -> hits
    roster hits groupBy key          -> key flags (one row per key)
    keys_u JOIN key flags (hot keys split), groupBy row -> row flags (<= 3 rows meet per row)
    userbase LEFT JOIN row flags     -> statuses, removals
    add keys SEMI exists             -> skipped; the rest are appended
    survivors + appended, narrow     -> keep-first dedupe on the email key
    userbase LEFT JOIN row flags LEFT JOIN dups -> final table

The wide userbase rows meet only small per-row tables keyed by
``(_gen, _ord)``; all grouping happens on narrow key tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions import ACT_NOOP, action_class, in_zone, valid_email
from rollcall.operators import clean, match, skew, update
from rollcall.operators.dedupe import duplicate_rows
from rollcall.operators.prefilter import near
from rollcall.operators.zone import resolve_zone

INZ = "_inz"

SUMMARY_COLUMNS = [
    "zone",
    "validated",
    "not_found",
    "removed",
    "newly_added",
    "skipped_existing",
    "dedupe_removed",
    "bad_roster_emails",
    "bad_add_emails",
    "blank_actions",
]


class Counters:
    """Counts taken of rows while a job writes them, so that no job of its own
    counts them again. Each is taken in the last stage of a write, whose tasks
    Spark counts once even if an executor is lost and they run again."""

    def __init__(self):
        self.taken: list[Observation] = []

    def of(self, df: DataFrame, **counts: Column) -> DataFrame:
        seen = Observation()
        self.taken.append(seen)
        return df.observe(seen, *[e.alias(n) for n, e in counts.items()])

    def summary(self, zone: str) -> dict:
        """The counters of a run all of whose tables are written."""
        n: dict = {}
        for seen in self.taken:
            n.update(seen.get)
        if "in_zone" in n:
            n["not_found"] = n["in_zone"] - n["referenced"]
        n["newly_added"] = n.get("usable_add", 0) - n.get("skipped_existing", 0)
        return {c: zone if c == "zone" else n.get(c, 0) for c in SUMMARY_COLUMNS}


def row_keys(ub: DataFrame) -> DataFrame:
    """What matching needs of each row: its place, its three keys and its zone.
    None of it changes from run to run."""
    return match.with_norm_keys(ub).select(S.GEN, S.ORD, match.E, match.G, match.L, S.ZONE)


@dataclass
class ZoneRun:
    zone: str
    gen: int
    keys_u: DataFrame
    exists: DataFrame
    exists_n: DataFrame
    probe_n: DataFrame
    winners: DataFrame
    flags: DataFrame
    row_flags: DataFrame
    decided: DataFrame
    add_new: DataFrame | None
    add_existing: DataFrame | None
    appended: DataFrame | None
    dups: DataFrame
    table: DataFrame
    changed: DataFrame  # rows that stay with another status
    removed: DataFrame  # rows of the userbase that go, as removals or as copies
    kept_new: DataFrame | None  # appended rows that stay
    summary: DataFrame


def prepare_userbase(userbase: DataFrame) -> DataFrame:
    S.require_columns(userbase, (S.GLOBAL_ID, S.EMAIL, S.ZONE), "Userbase")
    if S.ORD not in userbase.columns:
        raise ValueError("Userbase has no _ord column; read it with rollcall.sources")
    ub = update.with_status_column(userbase)
    if S.GEN not in ub.columns:
        ub = ub.withColumn(S.GEN, F.lit(0))
    return ub


def _has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def reconcile_zone(
    userbase: DataFrame,
    roster: DataFrame,
    add: DataFrame | None = None,
    zone: str | None = None,
    gen: int = 1,
    materialize=None,
    unique_emails: bool = False,
    keyed: DataFrame | None = None,
    keep_keys=None,
    counters: Counters | None = None,
) -> ZoneRun:
    """Reconcile one zone. ``gen`` stamps appended rows and must exceed every
    ``_gen`` already in the userbase so they sort after it.

    ``materialize`` (e.g. ``session.written_table(spark)``) is applied to
    the narrow tables that feed several later steps: the userbase's keys per
    row, probe keys, counts of probe keys and of the userbase's keys among
    them, probe hits, per-row flags, groups of equal emails and duplicates. A
    job passes it so that none is computed twice (the key normalisation is
    the costliest per row) and lineage is cut at a reliable copy.

    ``unique_emails`` states that no two userbase rows share a normalised email
    (a run before left it so): the dedupe then looks at appended emails only.

    ``keyed`` is ``row_keys`` of the userbase where a run before stored it: the
    userbase is then not scanned for its keys. Otherwise ``keep_keys``, if given,
    is applied to it instead of ``materialize``. ``counters`` takes the counts
    while the tables are written (by ``materialize``, and ``table`` or
    ``changed`` by the caller, once)."""
    keep = materialize or (lambda df: df)
    counted = counters.of if counters else (lambda df, **_: df)
    ub = prepare_userbase(userbase)
    S.require_columns(roster, (S.GLOBAL_ID, S.EMAIL), "Zones roster tab")
    if S.ORD not in roster.columns:
        raise ValueError("Roster has no _ord column; read it with rollcall.sources")
    if add is not None and (S.GLOBAL_ID not in add.columns or S.EMAIL not in add.columns):
        if add.columns and _has_rows(add):
            S.require_columns(add, (S.GLOBAL_ID, S.EMAIL), "Zones add tab")
        add = None

    roster_valid = clean.valid_rows(roster)
    zone = resolve_zone(roster_valid, zone)
    act_col = S.find_action_column(roster.columns)

    # Userbase keys (narrow), matched over the whole userbase: cross-zone hits count.
    # Each key row carries its row's zone membership, so the counters never
    # need to join the wide userbase again.
    if keyed is None:
        keyed = row_keys(ub)
        if not unique_emails:
            keyed = counted(keyed, in_zone=F.count_if(in_zone(S.ZONE, zone)))
        keyed = (keep_keys or keep)(keyed)
    elif counters and not unique_emails:
        raise ValueError("stored keys are those of a table with unique emails")
    keyed_u = keyed.select(S.GEN, S.ORD, match.E, match.G, match.L, in_zone(S.ZONE, zone).alias(INZ))
    keys_u = match.key_index(keyed_u, S.GEN, S.ORD, INZ)

    # Roster keys, with the action class carried per row.
    usable = valid_email(S.EMAIL)
    counted_r = counted(roster, bad_roster_emails=F.count_if(~usable), blank_actions=F.count_if(usable & (action_class(act_col) == ACT_NOOP)))
    keyed_r = match.with_norm_keys(
        clean.valid_rows(counted_r).withColumns({match.RID: F.col(S.ORD), match.ACT: action_class(act_col)})
    )
    keys_r = match.key_index(keyed_r, match.RID, match.ACT)

    # One probe table for roster and add list: one semi-join against ``exists``.
    probe = keys_r.select(F.lit("r").alias("_src"), match.RID, match.ACT, match.TIER, match.KEY)
    add_valid = None
    if add is not None:
        add_valid = clean.valid_rows(add)
        counted_a = counted(add, bad_add_emails=F.count_if(~usable), usable_add=F.count_if(usable))
        keyed_a = match.with_norm_keys(clean.valid_rows(counted_a).withColumn(match.RID, F.col(S.ORD)))
        keys_a = match.key_index(keyed_a, match.RID).select(
            F.lit("a").alias("_src"), match.RID, F.lit(None).cast("string").alias(match.ACT), match.TIER, match.KEY
        )
        probe = probe.union(keys_a)

    probe = keep(probe)
    # Keys with their row counts: a hot key is one row per map task before its
    # shuffle, and the counts name the keys that the joins below split.
    keys_tk = [match.TIER, match.KEY]
    per_task = skew.rows_per_task(probe)
    probe_n = keep(match.key_counts(probe))
    # In a job the userbase's keys are first cut to those that may meet the probe's.
    meets = near if materialize else (lambda big, small, keys: big)
    exists_n = keep(match.key_counts(meets(keys_u, probe_n, keys_tk)).join(probe_n.select(*keys_tk), keys_tk, "left_semi"))
    exists = exists_n.select(*keys_tk)

    # First hitting tier per probe row, roster and add list in one aggregate.
    probe_hot = skew.hot_keys(probe_n, keys_tk, match.N, per_task)
    hits = match.cascade_match(probe, exists, "_src", match.RID, match.ACT, hot=probe_hot)
    hits = keep(counted(hits, skipped_existing=F.count_if(F.col("_src") == "a")))
    winners = hits.filter(F.col("_src") == "r").drop("_src")
    flags = match.key_flags(winners)
    rflags = match.row_flags(meets(keys_u, exists, keys_tk), flags, INZ, hot=skew.hot_keys(exists_n, keys_tk, match.N, per_task))
    gone = F.col(match.D)
    rflags = keep(counted(rflags, validated=F.count_if(F.col(match.V) & ~gone), removed=F.count_if(gone), referenced=F.count_if(F.col(INZ))))

    decided = update.with_row_decisions(ub, rflags.drop(INZ), zone)

    # Add list: rows with any hit in the ORIGINAL userbase (removed rows
    # included) are skipped; the rest are appended at the bottom.
    columns = ub.columns
    add_new = add_existing = appended = None
    if add is not None:
        hit_ids = hits.filter(F.col("_src") == "a").select(F.col(match.RID).alias(S.ORD))
        add_new = add_valid.join(hit_ids, S.ORD, "left_anti")
        add_existing = add_valid.join(hit_ids, S.ORD, "left_semi")
        appended = update.append_new(add_new, columns, zone, gen)

    # Keep-first dedupe over survivors then appended rows; blank emails exempt
    # (only the email key is computed for this branch).
    e = match.E
    survivors = (
        keyed_u.select(S.GEN, S.ORD, e)
        .filter(F.col(e) != "")
        .join(rflags.filter(F.col(match.D)).select(S.GEN, S.ORD), [S.GEN, S.ORD], "left_anti")
    )
    rows = survivors.filter(F.lit(False)) if unique_emails else survivors
    if appended is not None:
        new = match.with_norm_keys(appended).select(S.GEN, S.ORD, e).filter(F.col(e) != "")
        rows = (near(survivors, new, [e]) if unique_emails else survivors).union(new)
    dups = keep(counted(duplicate_rows(rows, e, materialize=keep), dedupe_removed=F.count(F.lit(1))))

    old = "_old"
    staying = update.apply_status(update.remove_rows(decided).withColumn(old, F.col(S.STATUS))).join(dups, [S.GEN, S.ORD], "left_anti")
    if unique_emails:  # only appended rows are copies, so all rows not found stay
        staying = counted(staying, not_found=F.count_if(update.NF))
    table = staying.select(*[S.qcol(c) for c in columns])
    changed = staying.filter(F.col(S.STATUS) != F.col(old)).select(S.GEN, S.ORD, S.STATUS)
    copies = dups.filter(F.col(S.GEN) != gen).select(S.GEN, S.ORD)
    removed = rflags.filter(F.col(match.D)).select(S.GEN, S.ORD).union(copies)
    kept_new = None
    if appended is not None:
        kept_new = appended.join(dups, [S.GEN, S.ORD], "left_anti").select(*[S.qcol(c) for c in columns])
        table = table.union(kept_new)

    summary = _summary(zone, keyed_u, rflags, roster, act_col, add, add_new, add_existing, dups)
    return ZoneRun(
        zone=zone,
        gen=gen,
        keys_u=keys_u,
        exists=exists,
        exists_n=exists_n,
        probe_n=probe_n,
        winners=winners,
        flags=flags,
        row_flags=rflags,
        decided=decided,
        add_new=add_new,
        add_existing=add_existing,
        appended=appended,
        dups=dups,
        table=table,
        changed=changed,
        removed=removed,
        kept_new=kept_new,
        summary=summary,
    )


def _summary(zone, keyed_u, rflags, roster, act_col, add, add_new, add_existing, dups) -> DataFrame:
    """All nine counters in one aggregate over a tagged union of narrow
    parts (no cross join of one-row results), taken before the final dedupe
    as the reference prints them. The userbase contributes the count of its
    in-zone rows, from its key table: not found = in-zone rows minus
    referenced in-zone rows, and every referenced row is in ``rflags``."""
    a, b, c = "_a", "_b", "_c"
    f = F.lit(False)
    parts = [
        rflags.select(
            F.lit("f").alias("_s"),
            (F.col(match.V) & ~F.col(match.D)).alias(a),
            F.col(match.D).alias(b),
            F.col(INZ).alias(c),
        ),
        keyed_u.select(F.lit("z").alias("_s"), F.col(INZ).alias(a), f.alias(b), f.alias(c)),
        roster.select(
            F.lit("r").alias("_s"),
            valid_email(S.EMAIL).alias(a),
            (valid_email(S.EMAIL) & (action_class(act_col) == ACT_NOOP)).alias(b),
            f.alias(c),
        ),
        dups.select(F.lit("d").alias("_s"), f.alias(a), f.alias(b), f.alias(c)),
    ]
    if add is not None:
        parts += [
            add.select(F.lit("a").alias("_s"), valid_email(S.EMAIL).alias(a), f.alias(b), f.alias(c)),
            add_new.select(F.lit("n").alias("_s"), f.alias(a), f.alias(b), f.alias(c)),
            add_existing.select(F.lit("x").alias("_s"), f.alias(a), f.alias(b), f.alias(c)),
        ]
    u = parts[0]
    for p in parts[1:]:
        u = u.union(p)
    s = F.col("_s")
    return u.agg(
        F.count_if((s == "f") & F.col(a)).alias("validated"),
        (F.count_if((s == "z") & F.col(a)) - F.count_if((s == "f") & F.col(c))).alias("not_found"),
        F.count_if((s == "f") & F.col(b)).alias("removed"),
        F.count_if(s == "n").alias("newly_added"),
        F.count_if(s == "x").alias("skipped_existing"),
        F.count_if(s == "d").alias("dedupe_removed"),
        F.count_if((s == "r") & ~F.col(a)).alias("bad_roster_emails"),
        F.count_if((s == "a") & ~F.col(a)).alias("bad_add_emails"),
        F.count_if((s == "r") & F.col(b)).alias("blank_actions"),
    ).select(F.lit(zone).alias("zone"), "*")
