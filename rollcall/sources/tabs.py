"""Workbooks as tab tables.

A workbook is an ordered set of named tabs with different columns. Each tab
is stored as its own parquet folder ``<base>/workbook=<w>/tab=<ordinal>``
(so reading a tab prunes to exactly its files and its own columns) and a
small manifest ``<base>/_manifest`` lists ``(workbook, tab, tab_ordinal)``.
Many zones' workbooks share one base folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.sources.files import read_delimited

MANIFEST = "_manifest"


def _tab_path(base: str, workbook: str, ordinal: int) -> str:
    return f"{base.rstrip('/')}/workbook={workbook}/tab={ordinal}"


def write_workbook(spark: SparkSession, base: str, workbook: str, tabs: list[tuple[str, DataFrame]]) -> None:
    """Write the tabs in the given order and register them in the manifest."""
    for i, (_, df) in enumerate(tabs):
        df.write.mode("errorifexists").parquet(_tab_path(base, workbook, i))
    rows = [(workbook, name, i) for i, (name, _) in enumerate(tabs)]
    manifest = spark.createDataFrame(rows, "workbook string, tab string, tab_ordinal int")
    manifest.coalesce(1).write.mode("append").parquet(f"{base.rstrip('/')}/{MANIFEST}")


def list_tabs(spark: SparkSession, base: str, workbook: str) -> list[str]:
    """Tab names in workbook order (one manifest row per tab)."""
    m = spark.read.parquet(f"{base.rstrip('/')}/{MANIFEST}").filter(F.col("workbook") == workbook)
    return [r.tab for r in m.orderBy("tab_ordinal").select("tab").collect()]


def read_tab(spark: SparkSession, base: str, workbook: str, name: str) -> DataFrame:
    names = list_tabs(spark, base, workbook)
    return spark.read.parquet(_tab_path(base, workbook, names.index(name)))


@dataclass
class ZoneTabs:
    roster: DataFrame
    add: DataFrame | None
    roster_name: str
    add_name: str | None


def select_tabs(names: list[str], roster_tab: str | None = None, add_tab: str | None = None) -> tuple[str, str | None]:
    """(roster tab, add-list tab or None) by the rules of a zones workbook.

    A tab asked for by name is found whatever its case and outer spaces, the
    first of several. Otherwise the roster is the first tab, and the add list
    the first tab besides it with ``add`` in its name.
    """
    folded = [n.strip().lower() for n in names]

    def asked(tab: str, what: str) -> str:
        wanted = tab.strip().lower()
        if wanted not in folded:
            raise ValueError(f"the workbook has no {what} named {tab!r}, only {names}")
        return names[folded.index(wanted)]

    if not names:
        raise ValueError("the workbook has no tabs")
    roster = asked(roster_tab, "roster tab") if roster_tab else names[0]
    if add_tab:
        return roster, asked(add_tab, "add-list tab")
    others = [n for n, f in zip(names, folded, strict=True) if "add" in f and n != roster]
    return roster, next(iter(others), None)


def read_zone_csv(spark: SparkSession, path: str, sep: str = ",") -> ZoneTabs:
    """A zones file that is delimited text: all of it is the roster, and there is no add list."""
    return ZoneTabs(read_delimited(spark, path, sep=sep).drop(S.GEN), None, path, None)


def read_zone_tabs(
    spark: SparkSession, base: str, workbook: str, roster_tab: str | None = None, add_tab: str | None = None
) -> ZoneTabs:
    names = list_tabs(spark, base, workbook)
    roster_name, add_name = select_tabs(names, roster_tab, add_tab)
    roster = spark.read.parquet(_tab_path(base, workbook, names.index(roster_name)))
    add = spark.read.parquet(_tab_path(base, workbook, names.index(add_name))) if add_name else None
    return ZoneTabs(roster, add, roster_name, add_name)


def read_first_tab(spark: SparkSession, base: str, workbook: str) -> DataFrame:
    """First sheet of a workbook (an export or userbase kept as a workbook)."""
    if not list_tabs(spark, base, workbook):
        raise ValueError("the workbook has no tabs")
    return spark.read.parquet(_tab_path(base, workbook, 0))
