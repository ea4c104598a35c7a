"""Jobs with I/O: run one zone against the latest snapshot, or several in turn.

``run_zone`` is the reference's command line re-expressed: decide whether
the one-time clean runs, reconcile, write the next snapshot version, report.
Zones must run one after another (each matches the whole userbase, so one
zone's removals change the next zone's matches); the driver loop in
``accumulate_zones`` runs one distributed job per zone, never per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rollcall import schema as S
from rollcall.operators.clean import clean_export
from rollcall.plans.reconcile import Counters, reconcile_zone, row_keys
from rollcall.session import case_sensitive, written_table
from rollcall.sources import files, snapshots

CLEAN_MODES = ("auto", "never", "force")


@dataclass
class RunResult:
    version: int
    zone: str
    cleaned: bool
    missing_columns: list[str]
    summary: dict
    table: DataFrame


def should_clean(columns, clean: str) -> bool:
    """``force`` always; ``never`` never; ``auto`` when the table is not yet
    prepared (has no ``status`` column)."""
    if clean not in CLEAN_MODES:
        raise ValueError(f"clean must be one of {CLEAN_MODES}")
    if clean == "force":
        return True
    if clean == "never":
        return False
    return not S.is_prepared(columns)


def _checkpointer(spark: SparkSession):
    return written_table(spark, "zone-run")


def run_zone(
    spark: SparkSession,
    base: str,
    roster: DataFrame,
    add: DataFrame | None = None,
    zone: str | None = None,
    clean: str = "auto",
    run_id: str | None = None,
) -> RunResult:
    """Reconcile ``roster``/``add`` into the latest snapshot under ``base``
    and commit the result as the next version: what it changed, as a layer over
    the version before; the whole table where the clean changed its rows and
    columns, where it had no status yet, and after ``snapshots.MAX_LAYERS``
    layers. ``run_id`` becomes part of the commit, so a caller that retries can
    tell whether the run took effect.

    The first run that writes a layer stores the rows' keys with it; later ones
    read them and those of the layers since, and don't scan the table for keys.
    The counters are taken while the tables are written."""
    version = snapshots.latest_version(spark, base)
    if version is None:
        raise ValueError(f"No snapshot under {base}; ingest the export first")
    below = snapshots.read_commit(spark, base, version)
    current = snapshots.merged(spark, base, below.chain)
    data_cols = [c for c in current.columns if c not in (S.GEN, S.ORD)]
    do_clean = should_clean(data_cols, clean)
    missing = S.missing_keep_columns(data_cols) if do_clean else []
    hook, counters = _checkpointer(spark), Counters()
    whole = do_clean or not S.is_prepared(data_cols) or S.GEN not in current.columns or len(below.chain) > snapshots.MAX_LAYERS
    unique = below.unique_emails and not do_clean
    keyed = snapshots.stored_keys(spark, base, below) if unique else None
    attempt = snapshots.new_attempt(spark, base, version + 1)
    storing = not whole and keyed is None

    def store_keys(df: DataFrame) -> DataFrame:
        df.write.parquet(snapshots.keys_path(base, attempt))
        return spark.read.parquet(snapshots.keys_path(base, attempt))

    try:
        with case_sensitive(spark):
            userbase = clean_export(current) if do_clean else current
            run = reconcile_zone(
                userbase, roster, add, zone=zone, gen=version + 1, materialize=hook, unique_emails=unique,
                keyed=keyed, keep_keys=store_keys if storing else None, counters=counters,
            )
            if whole:
                snapshots.write_snapshot(run.table, base, version + 1, run_id, unique_emails=True)
            else:
                layer = snapshots.Layer(run.changed, run.removed, run.kept_new, keys_of=row_keys)
                snapshots.write_layer(spark, layer, base, version + 1, run_id, unique_emails=True, attempt=attempt, keys=storing)
            summary = counters.summary(run.zone)
    except BaseException:
        if snapshots.latest_version(spark, base) == version:
            snapshots.drop_attempt(spark, base, attempt)
        raise
    finally:
        hook.cleanup()  # the committed snapshot doesn't depend on them
    return RunResult(
        version=version + 1,
        zone=run.zone,
        cleaned=do_clean,
        missing_columns=missing,
        summary=summary,
        table=snapshots.read_snapshot(spark, base, version + 1),
    )


def ingest(spark: SparkSession, base: str, export: DataFrame) -> int:
    """Store an export (raw, as read) as version 0."""
    if snapshots.latest_version(spark, base) is not None:
        raise ValueError(f"{base} already holds snapshots")
    snapshots.write_snapshot(export, base, 0)
    return 0


def export_delimited(spark: SparkSession, base: str, path: str, version: int | None = None, sep: str = ",") -> None:
    """The latest or the given version as delimited text in row order, with a
    byte order mark before each file."""
    files.write_delimited(snapshots.read_snapshot(spark, base, version), path, sep=sep, bom=True)


def accumulate_zones(
    spark: SparkSession, base: str, runs: list[tuple[DataFrame, DataFrame | None, str | None]], clean: str = "auto"
) -> list[RunResult]:
    """Run zones in the given order, each from the previous one's snapshot."""
    return [run_zone(spark, base, r, a, zone=z, clean=clean) for r, a, z in runs]


def diagnose_zone(spark: SparkSession, base: str, roster: DataFrame, add: DataFrame | None = None):
    """Read-only diagnosis of a roster against the latest snapshot: unmatched
    rows, near-miss clues and counts. The snapshot is never written; scratch
    copies in the shared folder go with ``close()`` of the result."""
    from rollcall.plans.diagnose import diagnose

    current = snapshots.read_snapshot(spark, base)
    hook = written_table(spark, "diagnose")
    try:
        with case_sensitive(spark):
            found = diagnose(current, roster, add, materialize=hook)
    except BaseException:
        hook.cleanup()
        raise
    found.close = hook.cleanup
    return found
