"""Read-only diagnosis: roster rows that match nothing, with near-miss clues.

Same cascade as the reconcile, but over *all* roster rows (no email
filter). Clues are equi-joins on derived keys, never a scan per row:

* email: same local part (text before ``@``) as some userbase email;
* gid: same id once leading zeros are dropped;
* name: same trimmed, case-folded name (blank names never match).

All three kinds stand in one index of the userbase, made in one scan and cut
to the keys that unmatched rows may meet before it is shuffled. Candidate lists
are cut after sorting (emails and ids by value, name rows by table position), so
the report is deterministic; the cut is one ``row_number() <= k`` window, which
Spark limits partially before the shuffle, so a hot key never ships more than
``k`` rows per map task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions import email_local_part, fold_name, strip_leading_zeros, text, valid_email
from rollcall.operators import match, skew
from rollcall.operators.dedupe import topk_per_key
from rollcall.operators.prefilter import near

# --- Fixed values: how many candidates each clue lists. ---
EMAIL_CLUES = 3
GID_CLUES = 3
NAME_CLUES = 2
# --- end of fixed values ---

KINDS = ("email_domain", "gid_zeros", "name", "none")


def clued(probe: DataFrame, top: DataFrame, keys: list[str]) -> DataFrame:
    """Unmatched rows with the candidates of their key; a key that very many
    unmatched rows share is split over tasks."""
    counts = probe.groupBy(*keys).agg(F.count(F.lit(1)).alias(match.N))
    hot = skew.hot_keys(counts, keys, match.N, skew.rows_per_task(probe))
    return skew.split_hot_join(probe, top, keys, hot, [match.RID])


@dataclass
class Diagnosis:
    unmatched: DataFrame
    email_clues: DataFrame
    gid_clues: DataFrame
    name_clues: DataFrame
    report: DataFrame
    summary: DataFrame
    close: Callable[[], None] = lambda: None  # removes the scratch copies of a job


def unmatched_roster(userbase: DataFrame, roster: DataFrame) -> DataFrame:
    """Roster rows (all of them) whose cascade finds nothing, with the
    normalised keys ``_e, _g, _l`` alongside the raw columns."""
    S.require_columns(roster, (S.GLOBAL_ID, S.EMAIL), "Zones roster tab")
    keyed_u = match.with_norm_keys(userbase)
    keys_u = match.key_index(keyed_u, S.GEN, S.ORD)
    keyed_r = match.with_norm_keys(roster.withColumn(match.RID, F.col(S.ORD)))
    keys_r = match.key_index(keyed_r, match.RID)
    keys_tk = [match.TIER, match.KEY]
    counts = match.key_counts(keys_r)
    # The userbase's distinct keys among those that may meet the roster's: a hot one collapses map-side.
    exists = near(keys_u.select(*keys_tk), counts, keys_tk).distinct().join(counts.select(*keys_tk), keys_tk, "left_semi")
    hot = skew.hot_keys(counts, keys_tk, match.N, skew.rows_per_task(keys_r))
    hit = skew.split_hot_join(keys_r, exists, keys_tk, hot, [match.RID], "left_semi")
    return keyed_r.join(hit.select(match.RID), match.RID, "left_anti")


CLUE, CANDIDATE = "_clue", "candidate"
RAW = ["email", "gid", "lid"]


def _has(column: str, *tables: DataFrame) -> bool:
    return all(column in t.columns for t in tables)


def _clue(kind: str, key, candidate=None, position: bool = False, raw=None):
    """One entry of a row's clues: kind, key, and what the candidate is."""
    blank = F.lit("")
    return F.struct(
        F.lit(kind).alias("kind"), key.alias(CLUE), (blank if candidate is None else candidate).alias(CANDIDATE),
        (F.col(S.GEN) if position else F.lit(0)).cast("int").alias(S.GEN), (F.col(S.ORD) if position else F.lit(0)).cast("bigint").alias(S.ORD),
        *[(raw(c) if raw else blank).alias(n) for n, c in zip(RAW, (S.EMAIL, S.GLOBAL_ID, S.LOCAL_ID), strict=True)],
    )


def clue_index(userbase: DataFrame, unmatched: DataFrame, kinds: dict[str, int]) -> DataFrame:
    """``(_rid, kind, rank, candidate, _gen, _ord, email, gid, lid)``: for each
    unmatched row and kind of clue the first candidates of its key.

    The userbase is scanned once: every row gives an entry per kind, entries
    whose key can't meet one of the unmatched rows go before the shuffle, copies of
    a value collapse, and one window takes the first ``kinds[kind]`` of each key."""
    u, r = match.with_norm_keys(userbase), unmatched

    def raw(column):
        return text(column) if column in userbase.columns else F.lit("")

    entries, probes = [], []
    if "email_domain" in kinds and _has(S.EMAIL, userbase):
        entries.append(_clue("email_domain", email_local_part(match.E), F.col(match.E)))
        probes.append((F.col(match.E) != "", "email_domain", email_local_part(match.E)))
    if "gid_zeros" in kinds and _has(S.GLOBAL_ID, userbase):
        entries.append(_clue("gid_zeros", strip_leading_zeros(match.G), F.col(match.G)))
        probes.append((F.col(match.G) != "", "gid_zeros", strip_leading_zeros(match.G)))
    if "name" in kinds and _has(S.NAME, userbase, unmatched):
        entries.append(_clue("name", fold_name(S.NAME), position=True, raw=raw))
        probes.append((fold_name(S.NAME) != "", "name", fold_name(S.NAME)))
    schema = ["kind", CLUE, CANDIDATE, S.GEN, S.ORD, *RAW]
    keys = ["kind", CLUE]
    if not entries:
        nothing = _clue("none", F.lit(""))
        return unmatched.select(match.RID, F.inline(F.array(nothing))).withColumn("rank", F.lit(1)).filter(F.lit(False)).select(match.RID, "rank", *schema)
    wanted = F.array(*[F.struct(F.lit(kind).alias("kind"), F.when(used, key).alias(CLUE)) for used, kind, key in probes])
    probe = r.select(match.RID, F.inline(wanted)).filter(F.col(CLUE).isNotNull())
    # Blank emails and ids are no candidates, blank names no keys.
    all_of = u.select(F.inline(F.array(*entries)))
    some = all_of.filter(F.when(F.col("kind") == "name", F.col(CLUE) != "").otherwise(F.col(CANDIDATE) != ""))
    copies = near(some, probe, keys).distinct()
    most = F.create_map(*[F.lit(x) for kind in kinds.items() for x in kind])
    top = topk_per_key(copies, keys, [F.col(CANDIDATE), F.col(S.GEN), F.col(S.ORD)], max(kinds.values()))
    top = top.filter(F.col("rank") <= most[F.col("kind")])
    return clued(probe, top, keys).select(match.RID, "rank", *schema)


def email_clues(found: DataFrame) -> DataFrame:
    """``(_rid, rank, candidate)``: userbase emails sharing the local part."""
    return found.filter(F.col("kind") == "email_domain").select(match.RID, "rank", CANDIDATE)


def gid_clues(found: DataFrame) -> DataFrame:
    """``(_rid, rank, candidate)``: userbase ids equal once leading zeros go.
    Blank ids are excluded before stripping; an all-zero id may match."""
    return found.filter(F.col("kind") == "gid_zeros").select(match.RID, "rank", CANDIDATE)


def name_clues(found: DataFrame) -> DataFrame:
    """``(_rid, rank, _gen, _ord, email, gid, lid)``: the first userbase rows
    (table order) with the same folded name; raw keys shown."""
    return found.filter(F.col("kind") == "name").select(match.RID, "rank", S.GEN, S.ORD, *RAW)


def nearmiss_email(userbase: DataFrame, unmatched: DataFrame, k: int = EMAIL_CLUES) -> DataFrame:
    return email_clues(clue_index(userbase, unmatched, {"email_domain": k}))


def nearmiss_gid(userbase: DataFrame, unmatched: DataFrame, k: int = GID_CLUES) -> DataFrame:
    return gid_clues(clue_index(userbase, unmatched, {"gid_zeros": k}))


def nearmiss_name(userbase: DataFrame, unmatched: DataFrame, k: int = NAME_CLUES) -> DataFrame:
    return name_clues(clue_index(userbase, unmatched, {"name": k}))


def nearmiss_report(unmatched: DataFrame, found: DataFrame) -> DataFrame:
    """One row per clue ``(_rid, kind, rank, detail)``; an unmatched row
    with no clue gets one ``none`` row."""
    name_detail = F.concat(
        F.col(S.GEN).cast("string"), F.lit(":"), F.col(S.ORD).cast("string"),
        F.lit("|"), F.col("email"), F.lit("|"), F.col("gid"), F.lit("|"), F.col("lid"),
    )
    detail = F.when(F.col("kind") == "name", name_detail).otherwise(F.col(CANDIDATE))
    # Clues join their rows in one pass: a row without any gets a null kind.
    clues = unmatched.select(match.RID).join(found.select(match.RID, "kind", "rank", detail.alias("detail")), match.RID, "left")
    return clues.select(match.RID, F.coalesce("kind", F.lit("none")).alias("kind"), F.coalesce("rank", F.lit(1)).alias("rank"), F.coalesce("detail", F.lit("")).alias("detail"))


def diagnose_summary(userbase, roster, add, unmatched) -> DataFrame:
    """Row counts of userbase, roster and add list, roster rows with an
    unusable email, and unmatched roster rows, in one aggregate."""
    f = F.lit(False)
    parts = [
        userbase.select(F.lit("u").alias("_s"), f.alias("_bad")),
        roster.select(F.lit("r").alias("_s"), (~valid_email(S.EMAIL)).alias("_bad")),
        unmatched.select(F.lit("m").alias("_s"), f.alias("_bad")),
    ]
    if add is not None:
        parts.append(add.select(F.lit("a").alias("_s"), f.alias("_bad")))
    u = parts[0]
    for p in parts[1:]:
        u = u.union(p)
    s = F.col("_s")
    return u.agg(
        F.count_if(s == "u").alias("userbase_rows"),
        F.count_if(s == "r").alias("roster_rows"),
        F.count_if(s == "a").alias("add_rows"),
        F.count_if((s == "r") & F.col("_bad")).alias("invalid_roster_emails"),
        F.count_if(s == "m").alias("unmatched"),
    )


def diagnose(userbase: DataFrame, roster: DataFrame, add: DataFrame | None = None, materialize=None) -> Diagnosis:
    """``materialize`` (e.g. ``session.written_table(spark)``) is applied to
    the unmatched rows and their clues, which feed the report and the lists."""
    un = unmatched_roster(userbase, roster)
    if materialize is not None:
        un = materialize(un)
    found = clue_index(userbase, un, {"email_domain": EMAIL_CLUES, "gid_zeros": GID_CLUES, "name": NAME_CLUES})
    if materialize is not None:
        found = materialize(found)
    report = nearmiss_report(un, found)
    return Diagnosis(un, email_clues(found), gid_clues(found), name_clues(found), report, diagnose_summary(userbase, roster, add, un))
