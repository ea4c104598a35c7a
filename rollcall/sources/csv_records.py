"""Records of delimited text with line breaks inside quotes, read split by split.

A file is read in splits at line ends, also where such a line end stands inside
quotes. Whether a split begins inside quotes follows from the splits before it:

1. Each split says what it does to the state (outside or inside quotes) for
   either state it may begin in: keep it, turn it, or set it. Lines without a
   quote change nothing and never leave the JVM.
2. A prefix over the splits of a file (one short row per split) gives each its state.
   Files where no line ends inside quotes need no more: Spark's CSV reader reads them.
3. In the other files the lines of a split are put together to records. What
   reaches over the end of a split is joined with the heads of the splits behind it, by a
   window over at most two short rows per split.

A quote opens a value only at its start, and a doubled quote is one inside it; a
quote amid an unquoted value is a character like others. Blank lines between
records are skipped. ``records`` gives complete records for ``from_csv``.
"""

from __future__ import annotations

import re
import sys
from array import array
from bisect import bisect_left

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Functions of this module travel to the executors with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE = '"'
# Encodings in which a line feed, a quote and a separator are the bytes they are in ASCII.
_BYTEWISE = re.compile(r"utf_?8(_?sig)?|(us_?)?ascii|latin_?1|iso_?8859_?\d+|(cp|windows_?)125\d", re.I)
OUTSIDE, INSIDE = 0, 1


def bytewise(encoding: str) -> bool:
    return bool(_BYTEWISE.fullmatch(encoding.strip().replace("-", "_")))


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether the line ends inside quotes, if it begins so or not."""
    at = 0
    while True:
        if inside or line.startswith(QUOTE, at):
            at += not inside
            while True:
                at = line.find(QUOTE, at)
                if at < 0:
                    return True
                if line.startswith(QUOTE, at + 1):
                    at += 2
                    continue
                break
            inside = False
            at += 1
        # The next value that begins with a quote.
        at = line.find(sep + QUOTE, at)
        if at < 0:
            return False
        at += len(sep)


def lines(spark: SparkSession, path: str, encoding: str, files: list[str] | None = None) -> DataFrame:
    """(path, start, row, value): each line of all or the named files, with its
    split and its position in the task; a leading BOM dropped."""
    raw = spark.read.option("lineSep", "\n").text(path)
    raw = raw.filter(F.col("_metadata.file_path").isin(files)) if files is not None else raw
    value = F.make_valid_utf8("value") if re.fullmatch(r"utf_?8(_?sig)?", encoding.replace("-", "_"), re.I) else F.decode(F.col("value").cast("binary"), encoding)
    start = F.col("_metadata.file_block_start")
    return raw.select(
        F.col("_metadata.file_path").alias("path"), start.alias("start"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row"),
        F.when(start == 0, F.regexp_replace(value, "^\ufeff", "")).otherwise(value).alias("value"),
    )


def split_effects(found: DataFrame, sep: str) -> DataFrame:
    """(path, start, after_outside, after_inside, opens): the state after a split for
    either state before it, and whether a line ends inside quotes when it begins outside."""

    def work(batches):
        at, state = None, []

        def sent():
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*at, *state), (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()), strict=True)], ["path", "start", "after_outside", "after_inside", "opens"])

        for b in batches:
            for path, start, value in zip(b.column("path").to_pylist(), b.column("start").to_pylist(), b.column("value").to_pylist(), strict=True):
                if at != (path, start):
                    if at:
                        yield sent()
                    at, state = (path, start), [OUTSIDE, INSIDE, False]
                state[0], state[1] = (int(ends_inside(value, s == INSIDE, sep)) for s in state[:2])
                state[2] = state[2] or state[0] == INSIDE
        if at:
            yield sent()

    quoted = found.filter(F.contains("value", F.lit(QUOTE))).select("path", "start", "value")
    return quoted.mapInArrow(work, "path string, start bigint, after_outside int, after_inside int, opens boolean")


def files_by_record(found: DataFrame, sep: str) -> list[str]:
    """The files in which a line ends inside quotes."""
    return sorted(r["path"] for r in split_effects(found, sep).filter("opens").select("path").distinct().collect())


def split_states(effects: DataFrame) -> DataFrame:
    """Adds ``state``, in which each split begins. Effects that set the state cut the
    prefix: since the last of them only the number of turns counts."""
    before = Window.partitionBy("path").orderBy("start")
    a, b = F.col("after_outside"), F.col("after_inside")
    turns = effects.withColumn("_turns", F.sum(F.when((a == INSIDE) & (b == OUTSIDE), 1).otherwise(0)).over(before))
    last = F.max(F.when(a == b, F.struct("start", a.alias("state"), "_turns"))).over(before.rowsBetween(Window.unboundedPreceding, -1))
    known = turns.withColumn("_last", last).withColumn("_so_far", F.lag("_turns", 1, 0).over(before))
    state = (F.coalesce("_last.state", F.lit(OUTSIDE)) + F.col("_so_far") - F.coalesce("_last._turns", F.lit(0))) % 2
    return known.withColumn("state", state).drop("_turns", "_last", "_so_far")


def _split_records(value: str) -> list[str]:
    """A record without its carriage return; several where one stands outside quotes."""
    value = value.removesuffix("\r")
    if "\r" not in value:
        return [value]
    out = [""]
    for i, part in enumerate(value.split(QUOTE)):
        pieces = part.split("\r") if i % 2 == 0 else [part]
        out[-1] += (QUOTE if i else "") + pieces[0]
        out += pieces[1:]
    return out


def first_record(rows, sep: str) -> str:
    """The first record of a file's lines; no more of them are taken than it has."""
    held, inside = [], False
    for (line,) in rows:
        if not held and not line.strip():
            continue
        held.append(line)
        inside = ends_inside(line, inside, sep)
        if not inside:
            break
    return _split_records("\n".join(held))[0]


WHOLE, TAIL, HEAD = "whole", "tail", "head"


def pieces(batches, sep: str, states: dict):
    """(path, start, row, header, kind, text) of the records of each split: whole
    ones, a tail whose end stands in a later split, and the head of a later split.

    ``states``: by path, the starts of its splits and the states they begin in.
    Spark chooses splits anew each time; a start that wasn't seen before has no
    known state, and that raises.
    """
    at, held, since, state, kind, first = None, [], 0, OUTSIDE, WHOLE, False

    def piece(kind):
        return *at, since, first and kind != HEAD, kind, "\n".join(held)

    for b in batches:
        for path, start, row, value in zip(*(b.column(c).to_pylist() for c in ("path", "start", "row", "value")), strict=True):
            if at != (path, start):
                if held:
                    yield piece(HEAD if kind == HEAD else TAIL)
                starts, begins = states[path]
                i = bisect_left(starts, start)
                if i == len(starts) or starts[i] != start:
                    raise ValueError(f"the splits of {path} changed while it was read: set spark.sql.files.minPartitionNum")
                at, held, first = (path, start), [], start == 0
                state, kind = (INSIDE, HEAD) if begins[i] else (OUTSIDE, WHOLE)
            if not held:
                if state == OUTSIDE and not value.strip():
                    continue
                since = row
            held.append(value)
            if state == INSIDE or QUOTE in value:
                state = int(ends_inside(value, state == INSIDE, sep))
            if state == OUTSIDE:
                yield piece(kind)
                first = first and kind == HEAD
                held, kind = [], WHOLE
    if held:
        yield piece(HEAD if kind == HEAD else TAIL)


def _batches(rows, schema: pa.Schema, size: int = 4096):
    waiting: list = []
    for r in rows:
        waiting.append(r)
        if len(waiting) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting, strict=True), schema, strict=True)], schema.names)
            waiting = []
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting, strict=True), schema, strict=True)], schema.names)


_RECORD = pa.schema([("path", pa.string()), ("start", pa.int64()), ("row", pa.int64()), ("header", pa.bool_()), ("text", pa.string())])
_PIECE = pa.schema([*list(_RECORD)[:4], ("kind", pa.string()), ("text", pa.string())])


def records(found: DataFrame, sep: str) -> DataFrame:
    """(path, start, row, header, text): the records of the lines, each at the place
    of its first line; ``header`` marks the first of a file."""
    splits = found.groupBy("path", "start").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    effects = split_effects(found, sep)
    known = splits.join(effects, ["path", "start"], "left").select("path", "start", F.coalesce("after_outside", F.lit(OUTSIDE)).alias("after_outside"), F.coalesce("after_inside", F.lit(INSIDE)).alias("after_inside"))
    # One number and one byte per split, told to the tasks: 7 MB for 100 TB in splits of 128 MB.
    states: dict = {}
    for r in split_states(known).select("path", "start", "state").orderBy("path", "start").toLocalIterator():
        starts, begins = states.setdefault(r["path"], (array("q"), bytearray()))
        starts.append(r["start"])
        begins.append(r["state"])

    def whole(batches):
        rows = ((*p[:4], t) for p in pieces(batches, sep, states) if p[4] == WHOLE for t in _split_records(p[5]))
        yield from _batches((r for r in rows if r[4].strip()), _RECORD)

    def crossing(batches):
        yield from _batches((p for p in pieces(batches, sep, states) if p[4] != WHOLE), _PIECE)

    def once(batches):
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in _RECORD.names), strict=True)
            yield from _batches(((*r[:4], t) for r in rows for t in _split_records(r[4]) if t.strip()), _RECORD)

    kinds = "path string, start bigint, row bigint, header boolean"
    out = found.mapInArrow(whole, f"{kinds}, text string")
    # At most a head and a tail of each split; a head goes to the last tail before it.
    parts = found.mapInArrow(crossing, f"{kinds}, kind string, text string")
    owner = F.last(F.when(F.col("kind") == TAIL, F.struct("start", "row", "header")), ignorenulls=True).over(Window.partitionBy("path").orderBy("start", "row"))
    joined = parts.withColumn("owner", owner).groupBy("path", "owner").agg(F.sort_array(F.collect_list(F.struct("start", "row", "text"))).alias("parts"))
    late = joined.select("path", "owner.start", "owner.row", "owner.header", F.array_join(F.col("parts.text"), "\n").alias("text"))
    return out.unionByName(late.mapInArrow(once, f"{kinds}, text string"))
