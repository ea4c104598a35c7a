"""Key index and the prioritised cascade match (email -> global id -> local id).

The reference keeps a dict per tier and probes it row by row. Here every
table is exploded once into a long key table ``(_tier, _key, <row id>)``
with blank keys dropped *before* any shuffle (a missing local-id column
would otherwise send every row to one partition). The cascade "first tier
that hits" is ``min(struct(_tier, _key))`` over the keys of a row that
exist on the other side: a row has at most one key per tier, so the
minimum is exactly the first hitting tier.

No operator here emits (probe row x userbase row) pairs: actions are first
reduced to one row per key (``key_flags``) and only then meet the userbase
keys, so a key shared by N probe rows and M userbase rows costs N + M.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions import ACT_REMOVE, ACT_VALIDATE, norm_email, norm_id_of, norm_local
from rollcall.operators.skew import split_hot_join

TIER, KEY = "_tier", "_key"
E, G, L = "_e", "_g", "_l"
RID, ACT = "_rid", "_act"
V, D = "_v", "_d"
N = "_n"


def with_norm_keys(df: DataFrame, use_local: bool = True) -> DataFrame:
    """Adds the three normalised keys ``_e, _g, _l``; absent columns give ''."""
    e = norm_email(S.EMAIL) if S.EMAIL in df.columns else F.lit("")
    g = norm_id_of(df, S.GLOBAL_ID) if S.GLOBAL_ID in df.columns else F.lit("")
    lo = norm_local(S.LOCAL_ID) if (use_local and S.LOCAL_ID in df.columns) else F.lit("")
    return df.withColumns({E: e, G: g, L: lo})


def key_index(keyed: DataFrame, *carry: str) -> DataFrame:
    """Long key table ``(*carry, _tier, _key)``, one row per non-blank key."""
    tiers = F.array(
        F.struct(F.lit(S.TIER_EMAIL).alias(TIER), F.col(E).alias(KEY)),
        F.struct(F.lit(S.TIER_GLOBAL_ID).alias(TIER), F.col(G).alias(KEY)),
        F.struct(F.lit(S.TIER_LOCAL_ID).alias(TIER), F.col(L).alias(KEY)),
    )
    return keyed.select(*carry, F.inline(tiers)).filter(F.col(KEY) != "")


def key_counts(keys: DataFrame) -> DataFrame:
    """One row per key with its number of rows ``_n``."""
    return keys.groupBy(TIER, KEY).agg(F.count(F.lit(1)).alias(N))


def cascade_match(probe: DataFrame, exists: DataFrame, *row_cols: str, hot: DataFrame | None = None) -> DataFrame:
    """Winning ``(_tier, _key)`` per probe row: the first tier whose key exists.
    Probe rows with no hit at all are absent. ``hot`` (probe keys with too
    many rows for one task, see ``skew.hot_keys``) splits those keys."""
    if hot is None:
        hit = probe.join(exists, [TIER, KEY], "left_semi")
    else:
        hit = split_hot_join(probe, exists, [TIER, KEY], hot, list(row_cols), "left_semi")
    return (
        hit.groupBy(*row_cols)
        .agg(F.min(F.struct(TIER, KEY)).alias("_w"))
        .select(*row_cols, F.col("_w." + TIER).alias(TIER), F.col("_w." + KEY).alias(KEY))
    )


def key_flags(winners: DataFrame) -> DataFrame:
    """Roster actions reduced to one row per winning key (partial aggregation
    collapses a hot key map-side). Presence of a key = referenced."""
    return winners.groupBy(TIER, KEY).agg(
        F.bool_or(F.col(ACT) == ACT_VALIDATE).alias(V),
        F.bool_or(F.col(ACT) == ACT_REMOVE).alias(D),
    )


def row_flags(keys_u: DataFrame, flags: DataFrame, *carry: str, hot: DataFrame | None = None) -> DataFrame:
    """Per userbase row hit by the roster: ``_v`` validate, ``_d`` remove
    (plus boolean row attributes ``carry`` the key rows bring along).
    At most three rows (one per tier) meet per userbase row. ``hot``
    (userbase keys with too many rows for one task) splits those keys."""
    if hot is None:
        joined = keys_u.join(flags, [TIER, KEY])
    else:
        joined = split_hot_join(keys_u, flags, [TIER, KEY], hot, [S.GEN, S.ORD])
    return (
        joined
        .groupBy(S.GEN, S.ORD)
        .agg(F.bool_or(V).alias(V), F.bool_or(D).alias(D), *[F.bool_or(c).alias(c) for c in carry])
    )
