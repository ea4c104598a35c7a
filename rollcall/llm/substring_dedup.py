"""Repeated passages across and within documents, removed word by word.

A window is ``WINDOW`` consecutive words. Every word covered by a window whose
words also start earlier (in a document with a smaller doc_id, or before it in
the same one) is removed; all windows are judged on the input.

Anchors: each document is cut into blocks of ``BLOCK`` words that don't
overlap. Any window holds one whole block, so two equal windows share a block
of the earlier one, which the other meets at some offset. The blocks are the
index; every rolling stretch of ``BLOCK`` words probes it. Around the hits,
the windows themselves are compared: neighbouring equal windows are the
maximal exact repeats.

As Spark jobs: documents are dealt into chunks by a hash of their doc_id. A
chunk sends the hashes of its stretches, each once however often it holds it,
to the hash's bucket; the bucket answers with a bit for each: whether some
block has that hash and another place has it too. Windows next to such a
stretch then send their hashes, with the least doc_id that the chunk has for
them, and are told whether that is the first of all. A passage or copy that
a third of all documents share thus costs a bucket one entry per chunk, and
no pairs are formed. All of it is one plan in which the documents are
shuffled once.

Stretches are compared by 30 bits besides their bucket, which only decides
where windows are looked at; windows by 64 bits besides an independently
hashed bucket.

Defined results: null and empty texts have no words and an empty kept text. A
null doc_id comes after all others. Rows that repeat a doc_id with the same
text are one document and get the same result; with other texts they are
taken one after another, in the order of the texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import Memo, pick

WINDOW, BLOCK = 20, 10
LAST = (1 << 63) - 1  # the place of a null doc_id
ANSWERS, CANDIDATES = 0, 1

_ODD = np.random.default_rng(20).integers(1, 1 << 63, size=BLOCK + 4, dtype=np.uint64) | np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * _ODD[BLOCK]
    return h ^ h >> np.uint64(29)


def split(text: str | None) -> list[bytes]:
    """Words: runs of anything but ASCII white space (bytes know no other)."""
    return (text or "").encode("utf-8", "surrogatepass").split()


class Chunk:
    """The windows of a chunk's documents, in the order of doc_id and place."""

    def __init__(self, docs: pa.Table, buckets: int):
        ids, texts = docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()
        self.rows = [(LAST if i is None else i, t or "") for i, t in zip(ids, texts, strict=True)]
        self.buckets = buckets
        memo = Memo(xxhash.xxh64_intdigest)
        self.docs, parts = [], [np.zeros(0, np.uint64)]
        for key in sorted(set(self.rows)):
            words = split(key[1])
            if len(words) >= WINDOW:
                parts.append(np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)))
                self.docs.append((key, len(words)))
        sizes = np.array([n for _, n in self.docs], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        words = np.concatenate(parts)
        self.place = np.arange(len(words)) - np.repeat(self.starts[:-1], sizes)
        left = np.repeat(sizes, sizes) - self.place  # words from here to the document's end
        h = np.zeros(max(0, len(words) - BLOCK + 1), dtype=np.uint64)
        for j in range(BLOCK):
            h += words[j : j + len(h)] * _ODD[j]
        self.hash = np.concatenate([mixed(h), np.zeros(min(len(words), BLOCK - 1), np.uint64)])
        self.stretch, self.window = left >= BLOCK, left >= WINDOW

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (bucket, 30 bits) of the stretches, sorted; which each
        stretch is; and each one's entry: bits, repeated here, a block here."""
        h = self.hash[self.stretch]
        key = (h >> np.uint64(34)) % np.uint64(self.buckets) << np.uint64(30) | h & np.uint64((1 << 30) - 1)
        found, which, count = np.unique(key, return_inverse=True, return_counts=True)
        block = np.zeros(len(found), dtype=bool)
        block[which[self.place[self.stretch] % BLOCK == 0]] = True
        entry = (found & np.uint64((1 << 30) - 1)) << np.uint64(2) | (count > 1).astype(np.uint64) << np.uint64(1) | block.astype(np.uint64)
        return found >> np.uint64(30), which, entry.astype(np.uint32)

    def candidates(self, answers: dict[int, bytes]) -> np.ndarray:
        """Places where a window starts that holds a stretch answered with yes."""
        bucket, which, _ = self.probes()
        hit = np.zeros(len(self.hash) + 1, dtype=np.int64)
        hit[1:][self.stretch] = gathered(bucket, answers)[which]
        hits = np.cumsum(hit)
        at = np.nonzero(self.window)[0]
        return at[hits[at + WINDOW - BLOCK + 1] > hits[at]]

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct windows that start at the given places: bucket, hash,
        the first place of each, and which of them each place has."""
        a, b = self.hash[at], self.hash[at + BLOCK]
        h, bucket = mixed(a * _ODD[11] + b), mixed(b * _ODD[12] + a) % np.uint64(self.buckets)
        order = np.lexsort((h, bucket))  # stable: equal ones stay in order
        new = np.ones(len(order), dtype=bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])
        which = np.empty(len(order), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        first = order[new]
        return bucket[first], h[first], at[first], which

    def doc_ids(self, at: np.ndarray) -> np.ndarray:
        ids = np.array([key[0] for key, _ in self.docs], dtype=np.int64)
        return ids[np.searchsorted(self.starts, at, side="right") - 1]

    def removed(self, at: np.ndarray) -> np.ndarray:
        """Which words are covered by windows that start at the given places."""
        edge = np.zeros(len(self.hash) + 1, dtype=np.int64)
        edge[at] += 1
        edge[at + WINDOW] -= 1
        return np.cumsum(edge)[:-1] > 0


def by_bucket(bucket: np.ndarray) -> list[tuple[int, slice]]:
    """Each bucket's slice of the (sorted) entries."""
    buckets, first = np.unique(bucket, return_index=True)
    ends = np.append(first[1:], len(bucket))
    return [(b, slice(a, z)) for b, a, z in zip(buckets.tolist(), first, ends, strict=False)]


def gathered(bucket: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
    """The bits of all buckets, in the order of the entries asked."""
    out = np.zeros(len(bucket), dtype=bool)
    for b, s in by_bucket(bucket):
        out[s] = np.unpackbits(np.frombuffer(answers[b], np.uint8), count=s.stop - s.start)
    return out


ROWS = "bucket int, chunk int, kind int, blob binary"


def table(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) or [()] * 4
    return pa.table({"bucket": pa.array(cols[0], pa.int32()), "chunk": pa.array(cols[1], pa.int32()), "kind": pa.array(cols[2], pa.int32()), "blob": pa.array(cols[3], pa.binary())})


def answer_probes(asked):
    """For each entry of each chunk: does a block have its hash, and is there a
    second place with it."""
    blobs = [np.frombuffer(b, np.uint32) for b in asked.column("blob").to_pylist()]
    every = np.concatenate(blobs)
    found, which, chunks = np.unique(every >> 2, return_inverse=True, return_counts=True)
    block, many = np.zeros(len(found), bool), chunks > 1
    block[which[every & 1 > 0]] = True
    many[which[every & 2 > 0]] = True
    yes, at, out = (block & many)[which], 0, []
    for bucket, chunk, blob in zip(asked.column("bucket").to_pylist(), asked.column("chunk").to_pylist(), blobs, strict=True):
        out.append((bucket, chunk, ANSWERS, np.packbits(yes[at : at + len(blob)]).tobytes()))
        at += len(blob)
    return table(out)


def answer_windows(asked):
    """For each window of each chunk: does it start first there. What isn't a
    question passes through."""
    bucket, chunk, kind, blob = (asked.column(c).to_pylist() for c in ("bucket", "chunk", "kind", "blob"))
    out = [(b, c, k, x) for b, c, k, x in zip(bucket, chunk, kind, blob, strict=True) if k == CANDIDATES]
    asks = [(b, c, np.frombuffer(x, np.uint64).reshape(2, -1)) for b, c, k, x in zip(bucket, chunk, kind, blob, strict=True) if k == ANSWERS]
    if asks:
        h, ids = np.concatenate([x[0] for *_, x in asks]), np.concatenate([x[1] for *_, x in asks]).view(np.int64)
        order = np.lexsort((ids, h))
        first = np.zeros(len(order), dtype=bool)
        first[order[np.concatenate(([True], h[order][1:] != h[order][:-1]))]] = True
        at = 0
        for b, c, x in asks:
            out.append((b, c, ANSWERS, np.packbits(first[at : at + x.shape[1]]).tobytes()))
            at += x.shape[1]
    return table(out)


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (the text left): one row per document."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    chunks = buckets = 2 * parts
    plain = pick(docs, doc_id="bigint", text="string")
    # Null ids are spread by their text.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    dealt = plain.withColumn("chunk", F.pmod(spread, F.lit(chunks)).cast("int"))

    def ask_probes(key, own):
        bucket, _, entry = Chunk(own, buckets).probes()
        return table([(b, key[0].as_py(), ANSWERS, entry[s].tobytes()) for b, s in by_bucket(bucket)])

    def ask_windows(key, own, told):
        if not own.num_rows or not told.num_rows:
            return table([])
        chunk = Chunk(own, buckets)
        at = chunk.candidates(dict(zip(told.column("bucket").to_pylist(), told.column("blob").to_pylist(), strict=True)))
        if not len(at):
            return table([])
        bucket, h, first, _ = chunk.windows(at)
        ids = chunk.doc_ids(first).view(np.uint64)
        rows = [(b, key[0].as_py(), ANSWERS, np.concatenate([h[s], ids[s]]).tobytes()) for b, s in by_bucket(bucket)]
        marks = np.zeros(len(chunk.hash), dtype=bool)
        marks[at] = True
        return table([*rows, (key[0].as_py(), key[0].as_py(), CANDIDATES, np.packbits(marks).tobytes())])

    def finish(key, own, told):
        if not own.num_rows:
            return result([])
        chunk = Chunk(own, buckets)
        gone = np.zeros(len(chunk.hash), dtype=bool)
        answers = {}
        for b, k, x in zip(*(told.column(c).to_pylist() for c in ("bucket", "kind", "blob")), strict=True):
            if k == CANDIDATES:
                gone = np.unpackbits(np.frombuffer(x, np.uint8), count=len(chunk.hash)).astype(bool)
            else:
                answers[b] = x
        at = np.nonzero(gone)[0]
        if len(at):
            bucket, _, first, which = chunk.windows(at)
            earliest = gathered(bucket, answers)[which] & (first[which] == at)
            gone = chunk.removed(at[~earliest])
        where = {doc: (a, z) for (doc, _), a, z in zip(chunk.docs, chunk.starts[:-1].tolist(), chunk.starts[1:].tolist(), strict=True)}
        out = []
        for doc_id, row in zip(own.column("doc_id").to_pylist(), chunk.rows, strict=True):
            words = split(row[1])
            a, z = where.get(row, (0, 0))
            cut = gone[a:z]
            kept = [w for w, x in zip(words, cut.tolist(), strict=True) if not x] if cut.any() else words
            out.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        return result(out)

    def result(rows: list[tuple]) -> pa.Table:
        cols = list(zip(*rows, strict=True)) or [()] * 4
        return pa.table({"doc_id": pa.array(cols[0], pa.int64()), "n_words": pa.array(cols[1], pa.int64()), "n_removed": pa.array(cols[2], pa.int64()), "kept_sha256": pa.array(cols[3], pa.string())})

    own = dealt.groupBy("chunk")
    hits = own.applyInArrow(ask_probes, ROWS).groupBy("bucket").applyInArrow(answer_probes, ROWS)
    first = own.cogroup(hits.groupBy("chunk")).applyInArrow(ask_windows, ROWS).groupBy("bucket").applyInArrow(answer_windows, ROWS)
    return own.cogroup(first.groupBy("chunk")).applyInArrow(finish, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def query(docs: DataFrame) -> DataFrame:
    return deduplicated(docs)


# Every window as a string; those that aren't the first of their string are later ones.
SQL = r"""
with d as (select doc_id, row_number() over (order by doc_id, text) as r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (select r, s, array_to_string(w[s:s + 19], ' ') as t from (select r, w, unnest(range(1, len(w) - 18)) as s from d where len(w) >= 20)),
later as (select r, s from windows qualify row_number() over (partition by t order by r, s) > 1),
cut as (select distinct r, unnest(range(s, s + 20)) as i from later),
words as (select r, i, w[i] as x from (select r, w, unnest(range(1, len(w) + 1)) as i from d)),
kept as (select r, string_agg(x, ' ' order by i) as k from words anti join cut using (r, i) group by r),
n as (select r, count(*) as n_removed from cut group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(k, '')) as kept_sha256
from d left join n using (r) left join kept using (r)
"""
