"""Hard negatives of anchor vectors by exact integer scores.

Components are whole numbers (floor of 256 times the value). The scores of some
anchors with some rows come from matrix products modulo a few small primes:
residues are centred around 0, so that sums of products stay whole and exact in
float32, and the Chinese remainder theorem (in mixed radix) puts the signed
scores together. As many primes are taken as the largest possible score needs,
which follows from the largest component and the vectors' length.

Anchors are a stated query set that meets all rows in blocks: rows and anchors
are dealt into blocks of bounded size by a hash of their id, and a task holds one
block of each. The first pass takes each anchor's first rows of the same label,
its positives. The second selects, for each of them, the first rows of other
labels whose score lies in the window under the positive's. Both keep a bounded
number of candidates per block, of which windows by anchor take the first.

Defined results: rows with a null id or label, a null vector or a component
that is null or not finite (also once scaled) take no part. Rows of one id count
once: the smallest (label, vector) stands for them. A moved label is the
remainder from 0 to 9. A vector shorter than the others is filled with zeros.
Equal scores go by the smaller id. Scores beyond 64 bits are compared exactly,
but returned as null.
Empty tables give no rows. Further columns of the input are not used.
"""

from __future__ import annotations

import contextlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import pick
from rollcall.session import written_table

# The contract's values.
SCALE, EVERY, MOVED, LABELS = 256, 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH, OF = 50, 95, 100  # a negative's score lies between these hundredths of the positive's

EXACT = 1 << 24  # whole numbers up to here are exact in float32
AT_ONCE = 4096  # products that are summed up in float32
FEWER = (64, 4)  # where the score needs more primes than there are for so many
COMPONENTS = 1 << 20  # of a block of rows; a block of anchors has half of them
TILE = 1 << 22  # scores that are held at a time


def primes(size: int, bound: int, at_once: int = AT_ONCE) -> list[int]:
    """Primes so small that the sums of ``size`` products of centred residues
    are exact in float32, and so many that their product exceeds twice the bound."""
    found: list[int] = []
    p = 2 * math.isqrt(EXACT // max(min(64, at_once), min(size, at_once))) + 1
    while math.prod(found) <= 2 * bound:
        p -= 1
        if p < 3:
            raise ValueError(f"scores up to {bound} need more primes than there are")
        if all(p % q for q in range(2, math.isqrt(p) + 1)):
            found.append(p)
    return found


def basis(size: int, bound: int) -> tuple[list[int], int]:
    """The primes, and how many products are summed up at once."""
    for at_once in (AT_ONCE, *FEWER[:-1]):
        with contextlib.suppress(ValueError):
            return primes(size, bound, at_once), at_once
    return primes(size, bound, FEWER[-1]), FEWER[-1]


def centred(matrix: np.ndarray, p: int) -> np.ndarray:
    """Residues modulo p from -(p-1)/2 to (p-1)/2, as float32 (of large float64, too, they are exact)."""
    rest = np.mod(matrix, p)
    return np.where(rest > p // 2, rest - p, rest).astype(np.float32)


def is_wide(bound: int) -> bool:
    """Whether scores up to the bound, or their hundredfold, don't fit 64 bits."""
    return OF * bound >= 1 << 62


def scores(left: np.ndarray, right: np.ndarray, bound: int) -> np.ndarray:
    """Inner products of the rows of two matrices of whole numbers, exact, none
    beyond ``bound``: int64, or Python integers where the bound is wide."""
    size = left.shape[1]
    (moduli, at_once), digits, radix = basis(size, bound), [], 1
    total = np.zeros((len(left), len(right)), object if math.prod(moduli) >= 1 << 63 else np.int64)
    for k, p in enumerate(moduli):
        a, b = centred(left, p), centred(right, p)
        rest = np.zeros(total.shape, np.int64)
        for at in range(0, size, at_once):
            rest += (a[:, at : at + at_once] @ b[:, at : at + at_once].T).astype(np.int64)
        # Mixed radix: the next digit is what the digits before leave over, divided by the primes before.
        weight = 1
        for q, digit in zip(moduli[:k], digits, strict=True):
            rest -= digit * weight
            weight = weight * q % p
        digit = rest % p * pow(weight, -1, p) % p
        digits.append(digit)
        total += digit.astype(total.dtype) * radix
        radix *= p
    return np.where(total > radix // 2, total - radix, total).astype(object if is_wide(bound) else np.int64, copy=False)


def coded(score: int, bound: int) -> str:
    """A score that may not fit 64 bits, as hexadecimal digits that sort like the scores."""
    return f"{score + bound:0{len(f'{2 * bound:x}')}x}"


def decoded(score: str, bound: int) -> int:
    return int(score, 16) - bound


def matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    """The vectors as rows, filled with zeros up to ``size``."""
    flat = column.combine_chunks()
    wide = pa.types.is_floating(flat.type.value_type)
    out = np.zeros((len(flat), size), np.float64 if wide else np.int64)
    lengths = np.diff(flat.offsets.to_numpy())
    out[np.arange(size) < lengths[:, None]] = flat.flatten().to_numpy(zero_copy_only=False)
    return out


def tiles(rows: pa.Table, anchors: pa.Table, size: int, bound: int):
    """The rows' ids and labels, and for each anchor its place and its scores with the rows."""
    rows = rows.sort_by("vec_id")  # so that equal scores stand in the order of their ids
    right = matrix(rows.column("vector"), size)
    ids, labels = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
    left = matrix(anchors.column("vector"), size)
    step = max(1, TILE // max(1, len(ids)))
    for at in range(0, len(left), step):
        for i, row in enumerate(scores(left[at : at + step], right, bound)):
            yield ids, labels, at + i, row


class Blocks:
    """Rows and anchors dealt into blocks; ``each`` meets one block of both."""

    def __init__(self, used: DataFrame, n: int, anchors: int, size: int):
        partitions = int(used.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        room = max(1, COMPONENTS // max(1, size))
        # No fuller than the room, and as many as there are partitions where blocks stay of use.
        self.of_rows = max(1, math.ceil(n / room), min(partitions, math.ceil(n / 1024)))
        self.of_anchors = max(1, math.ceil(2 * anchors / room))
        self.rows = self._dealt(used, "rows", self.of_rows, "anchors", self.of_anchors)

    @staticmethod
    def _dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        # Both sides' keys have one type: cogroup shuffles by their hashes, which differ between int and bigint.
        return df.withColumns({own: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"), other: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))})

    def each(self, anchors: DataFrame, work, schema: str) -> DataFrame:
        queries = self._dealt(anchors, "anchors", self.of_anchors, "rows", self.of_rows)
        return self.rows.groupBy("rows", "anchors").cogroup(queries.groupBy("rows", "anchors")).applyInArrow(work, schema)


def first(df: DataFrame, keys: list[str], score: str, row: str, k: int) -> DataFrame:
    """The first ``k`` rows of each key, with their ``rank`` from 1."""
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), row)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(embeddings: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """One row per anchor, positive and negative, with the negative's rank."""
    spark = embeddings.sparkSession
    keep, result = written_table(spark, "hard-negatives"), written_table(spark, "hard-negatives-result")
    plain = pick(embeddings, vec_id="bigint", embedding="array<double>", label="bigint").dropna()
    fits = F.forall("embedding", lambda x: F.coalesce(F.abs(x * SCALE) < float("inf"), F.lit(False)))
    # From 2**53 on every double is a whole number, which a bigint may not hold.
    whole = lambda x: F.when(F.abs(x * SCALE) < float(1 << 53), F.floor(x * SCALE).cast("double")).otherwise(x * SCALE)
    moved = F.when(F.col("vec_id") % MOVED == 0, F.pmod(F.col("label") + 1, F.lit(LABELS))).otherwise(F.col("label"))
    vectors = plain.filter(fits).select("vec_id", moved.alias("label"), F.transform("embedding", whole).alias("vector"))
    one = vectors.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.label", "row.vector")
    try:
        used = keep(one)
        is_anchor = F.col("vec_id") % every == 0
        largest = F.array_max(F.transform("vector", lambda x: F.abs(x)))
        seen = used.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("anchors"), F.max(F.size("vector")).alias("size"), F.max(largest).alias("most")).first()
        size, most = seen["size"] or 0, int(seen["most"] or 0)
        bound = max(1, size * most * most)
        wide = is_wide(bound)
        kind, name = (pa.string(), "string") if wide else (pa.int64(), "bigint")
        sent = (lambda score: coded(score, bound)) if wide else int
        got = (lambda score: decoded(score, bound)) if wide else int
        narrow = "smallint" if most < 1 << 15 else "int" if most < 1 << 31 else "bigint" if most < 1 << 53 else "double"
        used = used.withColumn("vector", F.col("vector").cast(f"array<{narrow}>"))
        blocks = Blocks(used, seen["n"], seen["anchors"], size)
        anchors = used.filter(is_anchor)

        def same_label(rows: pa.Table, queries: pa.Table) -> pa.Table:
            names, own = queries.column("vec_id").to_pylist(), queries.column("label").to_pylist()
            out: list = []
            for ids, labels, at, row in tiles(rows, queries, size, bound):
                found = np.flatnonzero((labels == own[at]) & (ids != names[at]))
                found = found[np.argsort(-row[found], kind="stable")[:positives]]
                out += [(names[at], i, sent(s)) for i, s in zip(ids[found].tolist(), row[found].tolist(), strict=True)]
            columns = list(zip(*out, strict=True)) or [[]] * 3
            return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], kind)], ["anchor_id", "positive_id", "positive_score"])

        found = blocks.each(anchors, same_label, f"anchor_id bigint, positive_id bigint, positive_score {name}")
        best = keep(first(found, ["anchor_id"], "positive_score", "positive_id", positives).drop("rank"))
        # No more than `positives` rows of an anchor.
        targets = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("targets"))

        def in_window(rows: pa.Table, queries: pa.Table) -> pa.Table:
            names, own, wanted = (queries.column(c).to_pylist() for c in ("vec_id", "label", "targets"))
            out: list = []
            for ids, labels, at, row in tiles(rows, queries, size, bound):
                goals = [(t["positive_id"], got(t["positive_score"])) for t in wanted[at]]
                windows = [(-(-LOW * s // OF), HIGH * s // OF) for _, s in goals]
                widest = (row >= min(w[0] for w in windows)) & (row <= max(w[1] for w in windows))
                near = np.flatnonzero((labels != own[at]) & widest)
                near = near[np.argsort(-row[near], kind="stable")]
                fallen = -row[near]
                for (goal, score), (low, high) in zip(goals, windows, strict=True):
                    start = int(np.searchsorted(fallen, -high))
                    for i in near[start : start + negatives].tolist():
                        if row[i] >= low:
                            out.append((names[at], goal, int(ids[i]), sent(score), sent(int(row[i]))))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), kind, kind)
            return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

        schema = f"anchor_id bigint, positive_id bigint, negative_id bigint, positive_score {name}, negative_score {name}"
        found = blocks.each(keep(anchors.join(targets, "vec_id")), in_window, schema)
        mined = first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
        columns = ["positive_score", "negative_score"]
        if wide:
            long = F.udf(lambda s: n if -(1 << 63) <= (n := decoded(s, bound)) < 1 << 63 else None, "bigint")
            mined = mined.withColumns({c: long(c) for c in columns})
        return result(mined.select("anchor_id", "positive_id", "rank", "negative_id", *columns))
    finally:
        keep.cleanup()


def query(embeddings: DataFrame) -> DataFrame:
    return mine(embeddings)


# DuckDB twin: every anchor with every row.
SQL = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v,
    case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), anchors as (
  select * from vectors where vec_id % 50 = 0
), scored as (
  select a.vec_id as anchor_id, r.vec_id as row_id, a.label = r.label as same,
    cast(list_inner_product(a.v::double[], r.v::double[]) as bigint) as score
  from anchors a join vectors r on a.vec_id <> r.vec_id
), positives as (
  select anchor_id, row_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, row_id) <= 5
), negatives as (
  select p.anchor_id, p.positive_id, s.row_id as negative_id, p.positive_score, s.score as negative_score,
    row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.row_id) as rank
  from positives p join scored s on s.anchor_id = p.anchor_id and not s.same
    and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from negatives where rank <= 3
"""
