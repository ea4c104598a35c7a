"""Delimited-text readers: every column a string, file order kept as ``_ord``.

Row position is data here (the dedupe keeps the *first* copy), so each row
gets a position at ingest that does not depend on how Spark packs file
splits into partitions:

    _ord = file_rank << 40 | (split_start + row_index_within_partition)

Every split except the last one of a file is full-size and therefore sits
alone at the start of its partition, so ``split_start + row index`` grows
strictly within a file and never reaches the next split's start (each row
takes at least one byte). The last split of a file may follow other splits
in its partition, but nothing of its own file comes after it. ``file_rank``
orders files by path; the rank table is one row per input file, built from
the file listing the driver already holds. It is broadcast, and its size is
bounded by ``MAX_FILES``: more files than that are refused.

Two things would break the numbering and are refused too: a setting that
packs several full-size splits into one partition, and files of 1 TiB or more.

Line breaks inside quotes need no flag. Files without any are read by Spark's
CSV reader, the others record by record (``csv_records``); both are read in
splits. Only encodings whose line feeds aren't single bytes (UTF-16 and the
like) make a file one task.
"""

from __future__ import annotations

import csv
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall import schema as S
from rollcall.operators.clean import clean_export
from rollcall.sources import csv_records

OFFSET_BITS = 40  # files up to 1 TiB
MAX_FILES = 1 << 20
_ROW_MASK = (1 << 33) - 1  # low bits of monotonically_increasing_id


_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):/+"


def _path_key(c):
    """File path in one spelling for both the listing and ``_metadata``, which
    encode it alike: scheme slashes collapsed (``file:///x`` == ``file:/x``)."""
    return F.regexp_replace(c, _SCHEME, "$1:/")


def _listed(path: str) -> str:
    return re.sub(_SCHEME, r"\1:/", path)


def dedupe_names(names: list[str]) -> list[str]:
    """Repeated header names keep the first as is and number the later ones
    ``name.1``, ``name.2`` ... (so the first ``Zone`` stays ``Zone``)."""
    seen: dict[str, int] = {}
    taken = set(names)
    out = []
    for n in names:
        if n not in seen:
            seen[n] = 0
            out.append(n)
            continue
        k = seen[n]
        while True:
            k += 1
            cand = f"{n}.{k}"
            if cand not in taken:
                break
        seen[n] = k
        taken.add(cand)
        out.append(cand)
    return out


def _header(spark: SparkSession, path: str, sep: str, encoding: str) -> list[str]:
    """Column names from the first record of the first file, as they stand there (a leading BOM dropped)."""
    first = min(spark.read.text(path).inputFiles())
    if csv_records.bytewise(encoding):
        of_first = csv_records.lines(spark, path, encoding).filter(_path_key(F.col("path")) == _listed(first))
        head = csv_records.first_record(of_first.select("value").toLocalIterator(), sep)
        return next(csv.reader([head], delimiter=sep), []) if len(sep) == 1 else head.split(sep)
    reader = spark.read.option("encoding", encoding).option("sep", sep).option("escape", '"').option("multiLine", True)
    row = reader.option("inferSchema", False).csv(unquote(first)).first()
    return ["" if v is None else v.lstrip("\ufeff") for v in row] if row else []


def _plain(spark: SparkSession, path: str, without: list[str], names: list[str], sep: str, encoding: str, check: bool, one_task: bool = False) -> DataFrame:
    """Files whose records are lines, by Spark's CSV reader: values and positions.
    The files ``without`` are pruned, by name, before any is opened."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in names])
    reader = spark.read.schema(schema).option("header", True).option("sep", sep).option("encoding", encoding).option("mode", "PERMISSIVE")
    raw = reader.option("enforceSchema", not check).option("quote", '"').option("escape", '"').option("multiLine", one_task).csv(path)
    raw = raw.filter(~F.col("_metadata.file_path").isin(without)) if without else raw
    return raw.select(
        *[S.qcol(c) for c in names],
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK)).alias("_row"),
    )


def _by_record(found: DataFrame, names: list[str], header: list[str] | None, sep: str) -> DataFrame:
    """Files whose records reach over lines: values and positions."""
    plain = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    values = F.from_csv("text", plain, {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"})
    parsed = csv_records.records(found, sep).withColumn("_v", values)
    if header is not None:
        fold = F.lower if found.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "false" else (lambda c: c)
        alike = [fold(F.coalesce(F.col(f"_v.c{i}"), F.lit(""))) == fold(F.lit(n)) for i, n in enumerate([*header, ""])]
        same = F.forall(F.array(*alike), lambda x: x)
        wrong = F.raise_error(F.concat(F.lit("CSV header does not conform to that of the first file: "), F.col("path"))).cast("boolean")
        parsed = parsed.filter(F.when(F.col("header"), F.when(same, False).otherwise(wrong)).otherwise(True))
    else:
        parsed = parsed.filter(~F.col("header"))
    return parsed.select(*[F.col(f"_v.c{i}").alias(n) for i, n in enumerate(names)], F.col("path").alias("_path"), F.col("start").alias("_start"), F.col("row").alias("_row"))


def read_delimited(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8", columns: list[str] | None = None) -> DataFrame:
    """All-string read with a header row; unquoted empty fields and nulls
    become '' (no NA tokens); a leading BOM is dropped. Values keep their outer
    spaces; a quote inside quotes is doubled; line breaks inside quotes belong
    to the value. Adds ``_gen = 0`` and the file-order ``_ord``.

    Every file must have the first file's header; each is checked against it
    when it is read. That needs distinct names: repeated header names are
    read from a single file only. Looking for line breaks inside quotes is a
    job of its own, over the lines with quotes."""
    if spark.conf.get("spark.sql.files.maxPartitionNum", None):
        raise ValueError("unset spark.sql.files.maxPartitionNum: row positions need one full-size split per partition")
    header = None if columns else _header(spark, path, sep, encoding)
    names = columns or dedupe_names(header)
    repeated = columns is None and names != header
    files = sorted(spark.read.text(path).inputFiles())
    if repeated and len(files) > 1:
        raise ValueError("repeated header names can be read from one file at a time")
    if len(files) >= MAX_FILES:
        raise ValueError(f"{len(files)} input files exceed the {MAX_FILES} the ordinal can number")
    check = columns is None and not repeated
    if csv_records.bytewise(encoding):
        # At most one row per file, as in the listing.
        by_record = csv_records.files_by_record(csv_records.lines(spark, path, encoding), sep)
        raw = _plain(spark, path, by_record, names, sep, encoding, check)
        if by_record:
            found = csv_records.lines(spark, path, encoding, by_record)
            raw = raw.unionByName(_by_record(found, names, None if columns else header, sep))
    else:
        raw = _plain(spark, path, [], names, sep, encoding, check, one_task=True)
    ranks = spark.createDataFrame([(f, i) for i, f in enumerate(files)], "_listed string, _rank long")
    ranks = ranks.select(_path_key(F.col("_listed")).alias("_path"), "_rank")
    too_long = F.raise_error(F.lit("a file of 1 TiB or more: its rows can't be numbered"))
    start = F.when(F.col("_start") < F.lit(1 << OFFSET_BITS), F.col("_start")).otherwise(too_long.cast("bigint"))
    return raw.withColumn("_path", _path_key(F.col("_path"))).join(F.broadcast(ranks), "_path").select(
        *[F.coalesce(S.qcol(c), F.lit("")).alias(c) for c in names],
        F.lit(0).alias(S.GEN),
        (F.shiftleft(F.col("_rank"), OFFSET_BITS) + start + F.col("_row")).alias(S.ORD),
    )


def read_userbase(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A userbase file as text, ready for ``reconcile_zone``."""
    return read_delimited(spark, path, sep=sep)


def read_export(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """The raw export, cleaned: keep-list columns and usable emails only.
    Spark's file splits replace the reference's 200,000-row chunks; the clean
    is narrow and nothing of the rows is shuffled."""
    return clean_export(read_delimited(spark, path, sep=sep))


def write_delimited(df: DataFrame, path: str, sep: str = ",", bom: bool = False) -> None:
    """Write a table as header-ed CSV part files, in ``(_gen, _ord)`` order
    (a range-partitioned sort, so part-file order is row order), values as they
    are. ``bom`` puts a byte order mark before each file, as spreadsheets want it."""
    order = [c for c in (S.GEN, S.ORD) if c in df.columns]
    out = df.orderBy(*order).drop(*order) if order else df
    if bom and out.columns:
        first = out.columns[0]
        if any(c in first for c in (sep, '"', "\n", "\r")):
            raise ValueError(f"a byte order mark can't stand before a quoted name: {first!r}")
        out = out.toDF("\ufeff" + first, *out.columns[1:])
    writer = out.write.mode("errorifexists").option("header", True).option("sep", sep).option("escape", '"').option("emptyValue", "")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
