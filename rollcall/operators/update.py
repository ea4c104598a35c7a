"""Table updates: statuses, removals and appended rows.

All of these are narrow column expressions over the userbase joined (on
``(_gen, _ord)``) with the small per-row flag table; the userbase itself is
never grouped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions import in_zone, norm_id_of, strip
from rollcall.operators.match import D, V

REF, VAL, DEL, NF = "_ref", "_val", "_del", "_nf"


def with_status_column(userbase: DataFrame) -> DataFrame:
    """Ensure ``status`` exists ('' when absent), nulls read as ''."""
    if S.STATUS not in userbase.columns:
        return userbase.withColumn(S.STATUS, F.lit(""))
    return userbase.withColumn(S.STATUS, F.coalesce(F.col(S.STATUS).cast("string"), F.lit("")))


def with_row_decisions(userbase: DataFrame, flags: DataFrame, zone: str) -> DataFrame:
    """Left join of the userbase with per-row roster flags, adding:
    ``_ref`` referenced by any roster row, ``_del`` to remove,
    ``_val`` validated (removal wins over validation), ``_nf`` in the zone
    and never referenced (so never removed either)."""
    j = userbase.join(flags, [S.GEN, S.ORD], "left")
    ref = F.col(V).isNotNull()
    dele = F.coalesce(F.col(D), F.lit(False))
    return j.withColumns(
        {
            REF: ref,
            DEL: dele,
            VAL: F.coalesce(F.col(V), F.lit(False)) & ~dele,
            NF: in_zone(S.ZONE, zone) & ~ref,
        }
    ).drop(V, D)


def apply_status(decided: DataFrame) -> DataFrame:
    """``validated`` / ``not found in zone``; every other row keeps its status."""
    return decided.withColumn(
        S.STATUS,
        F.when(F.col(VAL), F.lit(S.STATUS_VALIDATED))
        .when(F.col(NF), F.lit(S.STATUS_NOT_FOUND))
        .otherwise(F.col(S.STATUS)),
    )


def remove_rows(decided: DataFrame) -> DataFrame:
    return decided.filter(~F.col(DEL))


def append_new(new_rows: DataFrame, columns: list[str], zone: str, gen: int) -> DataFrame:
    """Align add-list rows to the userbase columns (absent -> '', extra
    dropped), normalise their global id, fill a blank zone with ``zone``,
    mark them ``newly added`` and stamp them with run ``gen``."""
    out = []
    for c in columns:
        if c == S.GEN:
            out.append(F.lit(gen).alias(S.GEN))
        elif c == S.ORD:
            out.append(F.col(S.ORD).cast("bigint").alias(S.ORD))
        elif c == S.STATUS:
            out.append(F.lit(S.STATUS_NEWLY_ADDED).alias(S.STATUS))
        elif c == S.GLOBAL_ID and c in new_rows.columns:
            out.append(norm_id_of(new_rows, c).alias(c))
        elif c == S.ZONE:
            z = S.qcol(c).cast("string") if c in new_rows.columns else F.lit("")
            out.append(F.when(strip(z) == "", F.lit(zone)).otherwise(z).alias(c))
        elif c in new_rows.columns:
            out.append(S.qcol(c).cast("string").alias(c))
        else:
            out.append(F.lit("").alias(c))
    return new_rows.select(*out)
