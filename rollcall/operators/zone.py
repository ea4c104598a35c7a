"""Zone resolution: explicit zone, else the single zone named by the roster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions import strip

# An error names this many zones and gives the number of all.
NAMED_ZONES = 50


def resolve_zone(roster: DataFrame, zone: str | None = None) -> str:
    """The zone of a run: the given one, trimmed, if it isn't empty (white space
    alone becomes ''); else the one distinct non-blank value, trimmed, of the
    roster's ``Zone`` column. Anything but one value is an error."""
    if zone:
        return zone.strip()
    if S.ZONE in roster.columns:
        named = roster.select(strip(S.ZONE).alias("z")).filter("z <> ''").distinct()
        found = named.agg(F.count(F.lit(1)).alias("n"), F.min("z").alias("z")).first()
        if found.n == 1:
            return found.z
        if found.n:
            some = [r.z for r in named.orderBy("z").limit(NAMED_ZONES).collect()]
            more = f" and {found.n - len(some)} more" if found.n > len(some) else ""
            raise ValueError(f"the roster names {found.n} zones ({', '.join(some)}{more}): say which one with zone=")
    what = "names no zone in its column" if S.ZONE in roster.columns else "has no column"
    raise ValueError(f"the roster {what} '{S.ZONE}': say which zone it is with zone=")


def resolve_zones(tabs: DataFrame, group: str = "workbook") -> DataFrame:
    """Resolve many rosters at once: one row per ``group`` with the zone, or
    null when the roster names none or several (``n_zones`` says which)."""
    z = F.when(strip(S.ZONE) != "", strip(S.ZONE))
    return (
        tabs.select(group, z.alias("_z"))
        .groupBy(group)
        .agg(F.count_distinct("_z").alias("n_zones"), F.min("_z").alias("_min"))
        .select(
            group,
            F.when(F.col("n_zones") == 1, F.col("_min")).alias("zone"),
            "n_zones",
        )
    )
