"""Near-duplicate documents by SimHash, found through Golay-code fuzzy keys.

A fingerprint has 64 bits: two segments of 23 bits and one of 18. Of at most
three differing bits, either no more than two fall into each of the first two
segments, and then both share a Golay key of each (see ``golay``); or all
three fall into one of them, and the other two segments agree. So a
fingerprint gets the pairs of its segments' Golay keys and two exact pairs of
segments as join keys; what meets under a key is verified by its distance.

Only different fingerprints are joined; copies are one row before that. A key
under which more than ``most`` fingerprints meet isn't compared pair by pair:
its fingerprints are linked through shared neighbours instead (``by_flips``),
which is exact and linear in their number.

Defined results: null or empty text, or one without a word: fingerprint 0,
linked like any other. Fewer words than a shingle: one shingle of them all.
Repeated rows of one doc_id each keep their fingerprint and share the
component; a null doc_id is no component's name unless nothing else is there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.golay import BITS, DATA_BITS
from rollcall.llm.golay import keys as golay_keys
from rollcall.llm.common import documents, small, texts
from rollcall.llm.components import components
from rollcall.operators.skew import hot_keys, rows_per_task, split_hot_join
from rollcall.session import written_table

SHINGLE, DISTANCE, SEED = 3, 3, 42
LOW, HIGH = BITS, 2 * BITS
MASK = (1 << BITS) - 1


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bits that are set in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    whole = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(whole[a:b], SEED) for a, b in zip(starts, ends, strict=True)), np.uint64, n)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 15):
        part = hashes[at : at + (1 << 15)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << np.arange(64, dtype=np.uint64))[2 * counts > n].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, copy, fp): a hash of the text, and the fingerprint as a signed
    64-bit number."""

    def work(batches: Iterator[pa.RecordBatch]):
        for b in small(batches):
            fps = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("copy"), pa.array(fps.view(np.int64))], ["doc_id", "copy", "fp"])

    copied = texts(docs).select("doc_id", "text", F.xxhash64("text").alias("copy"))
    return copied.mapInArrow(work, "doc_id bigint, copy bigint, fp bigint")


def join_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, key) of every key of every fingerprint."""
    words = fps.view(np.uint64)
    a, b, c = (words & np.uint64(MASK)).astype(np.int64), (words >> np.uint64(LOW) & np.uint64(MASK)).astype(np.int64), (words >> np.uint64(HIGH)).astype(np.int64)
    ka, kb = golay_keys(a), golay_keys(b)
    pairs = np.where((ka[:, :, None] >= 0) & (kb[:, None, :] >= 0), ka[:, :, None] << DATA_BITS | kb[:, None, :], -1).reshape(len(fps), -1)
    exact = np.stack([1 << 60 | b << 18 | c, 1 << 61 | a << 18 | c], axis=1)
    every = np.concatenate([pairs, exact], axis=1)
    at = np.nonzero(every >= 0)
    return at[0], every[at]


def forest(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among the fingerprints, breadth first."""
    rest, a, b = fps, [], []
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            at = front.pop()
            near = np.bitwise_count((rest ^ at).view(np.uint64)) <= distance
            if near.any():
                found, rest = rest[near], rest[~near]
                a.append(np.full(len(found), at))
                b.append(found)
                front += found.tolist()
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def linked(keys: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal keys: all of them in short runs, which are
    compared a lag at a time, and a spanning forest in longer ones."""
    starts = np.concatenate(([0], np.nonzero(keys[1:] != keys[:-1])[0] + 1, [len(keys)]))
    sizes = np.diff(starts)
    a, b = [], []
    short = np.repeat(sizes <= 16, sizes)
    k, f = keys[short], fps[short]
    for lag in range(1, min(16, len(k))):
        near = (k[lag:] == k[:-lag]) & (np.bitwise_count((f[lag:] ^ f[:-lag]).view(np.uint64)) <= distance)
        a.append(f[:-lag][near])
        b.append(f[lag:][near])
    for i in np.nonzero(sizes > 16)[0]:
        x, y = forest(fps[starts[i] : starts[i + 1]], distance)
        a.append(x)
        b.append(y)
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def spread(fps: DataFrame) -> DataFrame:
    """(key, fp): one row for each key of each fingerprint."""

    def work(batches):
        for batch in batches:
            every = batch.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(every), 4096):
                part = np.ascontiguousarray(every[at : at + 4096])
                i, key = join_keys(part)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[i])], ["key", "fp"])

    return fps.mapInArrow(work, "key bigint, fp bigint")


def flips(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of up to ``most`` (at most two) bits, and their numbers of bits."""
    ones = [1 << i for i in range(64)]
    masks = [0, *ones, *(a | b for i, a in enumerate(ones) for b in ones[:i])]
    masks = np.array(masks[: 1 + 64 * (most > 0) + 2016 * (most > 1)], dtype=np.uint64)
    return masks, np.bitwise_count(masks)


def by_flips(fps: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) that connect all links among the given fingerprints.

    With ``distance`` = far + near, two fingerprints are linked exactly if some
    word lies within ``far`` bits of one and ``near`` bits of the other. For
    each word z, all fingerprints within ``far`` are tied to the least of those
    within ``near``: each such tie is a link, and no link's ends stay apart.
    A word has at most 2081 fingerprints within two bits, so groups are bounded.
    """
    near, far = distance // 2, distance - distance // 2
    masks, bits = flips(far)

    def work(batches):
        for batch in batches:
            every = batch.column("fp").to_numpy(zero_copy_only=False)
            for fp in every:
                z = (np.uint64(np.int64(fp).view(np.uint64)) ^ masks).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(z), pa.array(np.full(len(z), fp, np.int64)), pa.array(bits <= near)], ["z", "fp", "close"])

    around = fps.mapInArrow(work, "z bigint, fp bigint, close boolean")
    star = around.groupBy("z").agg(F.min(F.when(F.col("close"), F.col("fp"))).alias("hub"), F.collect_set("fp").alias("fps")).filter("hub is not null and size(fps) > 1")
    return star.select(F.explode("fps").alias("a"), F.col("hub").alias("b")).filter("a <> b").distinct()


def links(fps: DataFrame, *, distance: int = DISTANCE, most: int = 4000) -> DataFrame:
    """Edges (a, b) between distinct fingerprints, whose components are those of
    all links at up to ``distance`` (three at most) differing bits.

    ``most`` is the number of fingerprints under one key up to which they are
    compared with each other; those of fuller keys go through ``by_flips``.
    """
    if distance > DISTANCE:
        raise ValueError(f"the keys hold up to {DISTANCE} differing bits")
    keep = written_table(fps.sparkSession, "simhash-keys")
    every = spread(fps)
    hot = keep(every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select("key"))
    crowded = not hot.isEmpty()

    def compare(batches):
        keys, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column("key").to_numpy(zero_copy_only=False)])
            found = np.concatenate([found, batch.column("fp").to_numpy(zero_copy_only=False)])
            done = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last key may go on in the next batch
            a, b = linked(keys[:done], found[:done], distance)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
            keys, found = keys[done:], found[done:]
        a, b = linked(keys, found, distance)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    usual = every.join(hot, "key", "left_anti") if crowded else every
    edges = usual.repartition("key").sortWithinPartitions("key").mapInArrow(compare, "a bigint, b bigint")
    if crowded:
        edges = edges.union(by_flips(every.join(hot, "key", "left_semi").select("fp").distinct(), distance))
    return edges.distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, copy, fp, component, component_id) for every row of docs.

    ``component_id`` is the smallest doc_id that links reach from the row's
    fingerprint; ``component`` names the group also where all ids are null.
    ``copy`` is a hash of the text. Fingerprints and groups with very many rows
    are split over tasks.
    """
    keep = written_table(docs.sparkSession, "simhash")
    rows = keep(fingerprints(docs, shingle))
    classes = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")))
    found = components(links(classes.select("fp"), distance=distance), "simhash-components")
    member = classes.join(found, classes["fp"] == found["node"], "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    smallest = keep(member.groupBy("component").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n")))
    most = rows_per_task(rows)
    named = split_hot_join(member.select("fp", "component"), smallest.drop("n"), ["component"], hot_keys(smallest, ["component"], "n", most), ["fp"])
    return split_hot_join(rows, named, ["fp"], hot_keys(classes, ["fp"], "n", most), ["doc_id"])


def query(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest doc_id, once."""
    kept = documents(docs)
    found = near_duplicates(kept)
    best = found.groupBy("component").agg(F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "copy")).alias("best"))
    key = [F.coalesce("doc_id", F.lit(-1)).alias("_doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_copy")]
    first = best.select(F.coalesce("best.doc_id", F.lit(-1)).alias("_doc"), F.col("best.copy").alias("_copy"))
    once = kept.select("*", *key).join(first, ["_doc", "_copy"], "left_semi")
    return once.dropDuplicates(["_doc", "_copy"]).select(*kept.columns)
