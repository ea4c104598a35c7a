"""Versioned userbase snapshots, never overwritten.

    <base>/data/<attempt>/     parquet of one attempt to write a version: a whole
                               table, or a layer of changes in three folders
                               (status, removed, appended) and the appended rows' keys
    <base>/keys/<attempt>/     the keys of all rows as that attempt found them
    <base>/commits/<N>.json    version N: its attempt, the whole table and the layers
                               it is read from, and the run that made it

A zone run changes few rows of a large table, so it writes a layer: the rows
whose status changed, those that went, and those that came. A version is read by
merging its layers, in order, into the whole table below them; after
``MAX_LAYERS`` layers a run writes a whole table again.

Each zone run reads version N and writes N+1, so the previous state is
always kept (the reference's timestamped backup) and "restore" is a read of
an older version. A version exists once its commit file does. That file is
written aside and renamed, which fails if another writer has taken the
number: of two writers of N+1 one commits and the other one's attempt is
removed. The run's id stands in the same file, so a run is recorded exactly
when its version is committed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall import schema as S

COMMITS = "commits"


def _fs(spark: SparkSession, base: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file in one step; False if it is there already."""
    fs, jvm = _fs(spark, path)
    target = jvm.org.apache.hadoop.fs.Path(path)
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(target), options)
        return True
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
            return False
        raise


def _commit_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/{COMMITS}/{version:010d}.json"


def versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions, ascending (a directory listing, no data job)."""
    fs, jvm = _fs(spark, base)
    root = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{COMMITS}")
    if not fs.exists(root):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(root)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))


def latest_version(spark: SparkSession, base: str) -> int | None:
    v = versions(spark, base)
    return v[-1] if v else None


MAX_LAYERS = 8
STATUS_ROWS, REMOVED_ROWS, APPENDED_ROWS = "status", "removed", "appended"
APPENDED_KEYS = "appended_keys"


@dataclass
class Layer:
    """What a run changes: new statuses ``(_gen, _ord, status)``, rows that go
    ``(_gen, _ord)``, and rows that come, with the columns of the table.
    ``keys_of`` makes the keys of the rows that come, where keys are stored."""

    status: DataFrame
    removed: DataFrame
    appended: DataFrame | None
    keys_of: Callable | None = None


@dataclass
class Commit:
    """``chain``: the attempt that holds a whole table, then layers in order.
    ``keys``: the attempt that holds the keys of all rows as they were below the
    layer ``keys_at`` of the chain; None where no run has stored them."""

    version: int
    data: str
    run: str | None
    chain: list[str]
    unique_emails: bool
    keys: str | None = None
    keys_at: int | None = None


def read_commit(spark: SparkSession, base: str, version: int) -> Commit:
    schema = "data string, run string, chain array<string>, unique_emails boolean, keys string, keys_at int"
    row = spark.read.schema(schema).json(_commit_path(base, version)).first()
    return Commit(version, row["data"], row["run"], row["chain"] or [row["data"]], bool(row["unique_emails"]), row["keys"], row["keys_at"])


def _data(base: str, attempt: str, part: str = "") -> str:
    return f"{base.rstrip('/')}/data/{attempt}{'/' + part if part else ''}"


def snapshot_path(spark: SparkSession, base: str, version: int) -> str:
    """The folder that a committed version wrote."""
    return _data(base, read_commit(spark, base, version).data)


def merged(spark: SparkSession, base: str, chain: list[str]) -> DataFrame:
    """A whole table with the layers above it. A row's last status counts; what
    meets the table is one short row for each changed one."""
    table = spark.read.parquet(_data(base, chain[0]))
    layers = chain[1:]
    if not layers:
        return table
    columns = table.columns

    def stacked(part: str, *marks):
        found = None
        for i, attempt in enumerate(layers):
            rows = spark.read.parquet(_data(base, attempt, part)).select("*", *[m(i) for m in marks])
            found = rows if found is None else found.unionByName(rows)
        return found

    appended = stacked(APPENDED_ROWS)
    rows = table.unionByName(appended.select(*[S.qcol(c) for c in columns]))
    status = stacked(STATUS_ROWS, lambda i: F.lit(i).alias("_layer"))
    last = status.groupBy(S.GEN, S.ORD).agg(F.max_by(S.STATUS, "_layer").alias("_status"))
    merged_rows = rows.join(stacked(REMOVED_ROWS), [S.GEN, S.ORD], "left_anti").join(last, [S.GEN, S.ORD], "left")
    new = F.coalesce(F.col("_status"), F.col(S.STATUS)).alias(S.STATUS)
    return merged_rows.select(*[new if c == S.STATUS else S.qcol(c) for c in columns])


def keys_path(base: str, attempt: str) -> str:
    """Where an attempt stores the keys of the rows that it found."""
    return f"{base.rstrip('/')}/keys/{attempt}"


def stored_keys(spark: SparkSession, base: str, commit: Commit) -> DataFrame | None:
    """The keys of the rows of a version, if a run has stored them: those found
    then, without the rows that later layers removed, and with the keys of
    those that they appended. The table itself isn't read."""
    if commit.keys is None:
        return None
    keys = spark.read.parquet(keys_path(base, commit.keys))
    for attempt in commit.chain[commit.keys_at :]:
        keys = keys.unionByName(spark.read.parquet(_data(base, attempt, APPENDED_KEYS)))
    removed = None
    for attempt in commit.chain[commit.keys_at :]:
        rows = spark.read.parquet(_data(base, attempt, REMOVED_ROWS))
        removed = rows if removed is None else removed.union(rows)
    return keys if removed is None else keys.join(removed, [S.GEN, S.ORD], "left_anti")


def read_snapshot(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The given version, or the latest committed one."""
    if version is None:
        version = latest_version(spark, base)
        if version is None:
            raise ValueError(f"No snapshot under {base}")
    return merged(spark, base, read_commit(spark, base, version).chain)


def _commit(spark: SparkSession, base: str, version: int, attempt: str, chain: list[str], run_id: str | None, unique_emails: bool, keys: str | None = None, keys_at: int | None = None) -> None:
    text = json.dumps({"version": version, "data": attempt, "run": run_id, "chain": chain, "unique_emails": unique_emails, "keys": keys, "keys_at": keys_at})
    if not write_once(spark, _commit_path(base, version), text):
        drop_attempt(spark, base, attempt)
        raise ValueError(f"version {version} was committed under {base} by another writer")


def drop_attempt(spark: SparkSession, base: str, attempt: str) -> None:
    """Remove what an attempt that isn't committed has written."""
    fs, jvm = _fs(spark, base)
    for path in (_data(base, attempt), keys_path(base, attempt)):
        fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)


def new_attempt(spark: SparkSession, base: str, version: int) -> str:
    """The name of an attempt to write a version that isn't taken yet."""
    if version in versions(spark, base):
        raise ValueError(f"version {version} already committed under {base}")
    return f"v={version}-{uuid.uuid4().hex[:12]}"


def write_snapshot(df: DataFrame, base: str, version: int, run_id: str | None = None, unique_emails: bool = False) -> str:
    """Write ``df`` whole and commit it as version ``version`` of run ``run_id``.
    Raises if the version is taken, whoever took it and when. ``unique_emails``
    states that no two rows share a normalised email."""
    spark = df.sparkSession
    attempt = new_attempt(spark, base, version)
    df.write.mode("errorifexists").parquet(_data(base, attempt))
    _commit(spark, base, version, attempt, [attempt], run_id, unique_emails)
    return _data(base, attempt)


def write_layer(
    spark: SparkSession, layer: Layer, base: str, version: int, run_id: str | None = None, unique_emails: bool = False, attempt: str | None = None, keys: bool = False
) -> str:
    """Write what changed since the version before and commit it as ``version``.

    ``keys`` states that the caller has stored the keys of the rows of the version
    before under ``keys_path(base, attempt)``. Keys stored by a run before stay in use."""
    below = read_commit(spark, base, version - 1)
    attempt = attempt or new_attempt(spark, base, version)
    appended = layer.appended
    if appended is None:
        appended = merged(spark, base, below.chain).limit(0)
    for part, rows in ((STATUS_ROWS, layer.status), (REMOVED_ROWS, layer.removed), (APPENDED_ROWS, appended)):
        rows.write.mode("errorifexists").parquet(_data(base, attempt, part))
    if keys or (below.keys and layer.keys_of):
        layer.keys_of(spark.read.parquet(_data(base, attempt, APPENDED_ROWS))).write.mode("errorifexists").parquet(_data(base, attempt, APPENDED_KEYS))
    stored = (attempt, len(below.chain)) if keys else (below.keys, below.keys_at) if layer.keys_of else (None, None)
    _commit(spark, base, version, attempt, [*below.chain, attempt], run_id, unique_emails, *stored)
    return _data(base, attempt)


def version_of_run(spark: SparkSession, base: str, run_id: str) -> int | None:
    """The version that a run made, if it took effect."""
    if not versions(spark, base):
        return None
    commits = spark.read.schema("version int, data string, run string").json(f"{base.rstrip('/')}/{COMMITS}")
    found = commits.filter(F.col("run") == run_id).agg(F.min("version").alias("version")).first()
    return found["version"]


def retain_previous(spark: SparkSession, base: str, version: int) -> DataFrame:
    """The state kept from before a run: simply an older version."""
    return read_snapshot(spark, base, version)


def columns_of(spark: SparkSession, base: str, version: int | None = None) -> list[str]:
    """Column list without reading data (footer only)."""
    return [c for c in read_snapshot(spark, base, version).columns if c not in (S.GEN, S.ORD)]
