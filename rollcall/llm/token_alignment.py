"""Alignment of two tokenizations of the same texts.

Tokenizer A is a byte-level BPE, tokenizer B a piece model with byte
fallback. Both cut the same bytes (a space and the text), so their tokens are
intervals over one axis. All intervals of a text are sorted by start
(``lexsort``), the running maximum of their ends is taken
(``maximum.accumulate``), and a group of tokens ends where a start reaches that
maximum. Within the groups overlapping A and B tokens are expanded into links.

A pair's count is the number of links with its ids in all texts. Tasks add up
their links before they send pairs, so a frequent pair is one row a task. The
most frequent pairs, at most ``frequent`` of them, go to every task as a table
of known size; links of all other pairs meet their counts in a join, where no
key is hot because the hot ones are in the table.

Defined results: null and empty texts, and texts whose tokens don't spell them
out (for example with U+2581), have no tokens: numbers are 0, the digest is ''.
A row is a document: repeated rows and rows that share an id count each, null
ids stay null. Ties for the highest count of a B id all count as best. A long
text is worked on in stretches that end where tokens of both end together.
Further columns of the input are not used.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rollcall.llm.common import pick, small
from rollcall.session import written_table

# The way in which byte-level vocabularies cut a text before they merge (a fixed value of the format).
BYTE_LEVEL_PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
STRETCH = 250_000  # tokens of A that are aligned at a time
PART = 1_000_000  # characters that are encoded at a time
# Merges of both kinds never reach over a space between two characters that aren't white space.
_CUT = re.compile(r"(?<=\S)(?= \S)")


def byte_alphabet() -> dict[str, int]:
    """The printable character by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenizerA:
    """Byte-level BPE from a ``tokenizers`` file. Where the file's ids stand in
    the order of its merges, ``tiktoken`` does the same merges faster."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        alphabet, ids = byte_alphabet(), spec["model"]["vocab"]
        special = {t["content"] for t in spec["added_tokens"] if t["special"]}
        plain = {t: i for t, i in ids.items() if t not in special}
        self.bytes = [b""] * (max(ids.values()) + 1)
        for token, i in plain.items():
            self.bytes[i] = bytes(alphabet[c] for c in token)
        merged = [plain["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        before = spec["pre_tokenizer"]
        usual = before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and spec["normalizer"] is None
        if usual and merged == sorted(set(merged)) and len(merged) + 256 == len(plain):
            ranks = {self.bytes[i]: i for i in plain.values()}
            merges = tiktoken.Encoding("a", pat_str=BYTE_LEVEL_PARTS, mergeable_ranks=ranks, special_tokens={})
            self.encode = merges.encode_ordinary
        else:
            tokenizer = Tokenizer.from_str(vocabulary)
            tokenizer.encode_special_tokens = True
            self.encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids


class TokenizerB:
    """Piece model; puts a space before the text by itself."""

    def __init__(self, model: bytes):
        pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
        spell = lambda i, p: bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()
        self.bytes = [b"" if pieces.is_control(i) or pieces.is_unknown(i) else spell(i, p) for i, p in enumerate(names)]
        self.encode = pieces.encode
        self.apart = not any(re.search("[^▁]▁", p) for p in names)


class Pair:
    """Both tokenizers. Very long texts are encoded in parts."""

    def __init__(self, vocabulary_a: str, model_b: bytes, part: int = PART):
        self.a, self.b = TokenizerA(vocabulary_a), TokenizerB(model_b)
        self.kinds = tuple("H" if len(t.bytes) <= 1 << 16 else "I" for t in (self.a, self.b))
        self.part = part

    def ids(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of A and of B, little-endian, of each text; none unless both spell out a space and the text."""
        short = [t for t in texts if len(t) <= self.part]
        found = iter(zip(short, self.b.encode(short, num_threads=1), strict=True))
        return [self._both(*next(found)) if len(t) <= self.part else self._long(t) for t in texts]

    def _both(self, text: str, b: list[int]) -> tuple[bytes, bytes]:
        if not text:
            return b"", b""
        a, spelled = self.a.encode(" " + text), (" " + text).encode()
        if b"".join(map(self.a.bytes.__getitem__, a)) != spelled or b"".join(map(self.b.bytes.__getitem__, b)) != spelled:
            return b"", b""
        return array(self.kinds[0], a).tobytes(), array(self.kinds[1], b).tobytes()

    def _long(self, text: str) -> tuple[bytes, bytes]:
        cuts = [0]
        while self.b.apart and (m := _CUT.search(text, cuts[-1] + self.part)):
            cuts.append(m.start())
        # Each part but the first starts with its space, which both put there by themselves.
        parts = [text[a + (a > 0) : b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]
        found = [self._both(p, self.b.encode(p)) for p in parts]
        return tuple(b"".join(x) for x in zip(*found, strict=True)) if all(a for a, _ in found) else (b"", b"")


def aligned(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray):
    """Groups and links of two runs of intervals that cover the same range.

    Returns the group of each A token, of each B token, and the links as
    positions of A tokens and of B tokens.
    """
    starts, ends = np.concatenate([starts_a, starts_b]), np.concatenate([ends_a, ends_b])
    side = np.repeat(np.array([0, 1], np.int8), [len(starts_a), len(starts_b)])
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    # Overlaps of an A token are a run of B tokens, all of its group.
    first, last = np.searchsorted(ends_b, starts_a, side="right"), np.searchsorted(starts_b, ends_a, side="left")
    n = last - first
    link_a = np.repeat(np.arange(len(starts_a)), n)
    link_b = np.arange(len(link_a)) - np.repeat(np.cumsum(n) - n - first, n)
    return group[: len(starts_a)], group[len(starts_a) :], link_a, link_b


def stretches(ends_a: np.ndarray, ends_b: np.ndarray, size: int):
    """Slices (a from, a to, b from, b to) that end where both have an end."""
    if len(ends_a) <= size:
        yield 0, len(ends_a), 0, len(ends_b)
        return
    both = np.intersect1d(ends_a, ends_b, assume_unique=True)
    at_a, at_b = np.searchsorted(ends_a, both) + 1, np.searchsorted(ends_b, both) + 1
    a = b = 0
    while a < len(ends_a):
        k = max(int(np.searchsorted(at_a, a + size, side="right")) - 1, int(np.searchsorted(at_a, a, side="right")))
        yield a, int(at_a[k]), b, int(at_b[k])
        a, b = int(at_a[k]), int(at_b[k])


class Aligner:
    """Groups and links of encoded texts."""

    def __init__(self, lengths: tuple[np.ndarray, np.ndarray], kinds: tuple[str, str], size: int = STRETCH):
        self.lengths, self.kinds, self.size = lengths, kinds, size

    def __call__(self, a: bytes, b: bytes):
        """(ids of A, ids of B, groups of A, groups of B, A ids of links, B ids of links) of each stretch."""
        ids_a, ids_b = (np.frombuffer(x, k) for x, k in zip((a, b), self.kinds, strict=True))
        ends_a, ends_b = self.lengths[0][ids_a].cumsum(), self.lengths[1][ids_b].cumsum()
        if not len(ids_a):
            return
        for a0, a1, b0, b1 in stretches(ends_a, ends_b, self.size):
            x, y = ids_a[a0:a1].astype(np.int64), ids_b[b0:b1].astype(np.int64)
            ea, eb = ends_a[a0:a1], ends_b[b0:b1]
            group_a, group_b, link_a, link_b = aligned(ea - self.lengths[0][x], ea, eb - self.lengths[1][y], eb)
            yield x, y, group_a, group_b, x[link_a], y[link_b]


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts by key, keys ascending."""
    kinds, at = np.unique(np.concatenate(keys), return_inverse=True)
    return kinds, np.bincount(at, weights=np.concatenate(counts), minlength=len(kinds)).astype(np.int64)


def encoded(docs: DataFrame, vocabulary_a: str, model_b: bytes) -> DataFrame:
    """(doc_id, row, a, b): the ids of each document; ``row`` tells rows apart."""

    def work(batches):
        both = Pair(vocabulary_a, model_b)
        for batch in small(batches, 256):
            ids = both.ids([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array([x[0] for x in ids], pa.binary()), pa.array([x[1] for x in ids], pa.binary())], ["doc_id", "row", "a", "b"])

    rows = pick(docs, doc_id="bigint", text="string").withColumn("row", F.monotonically_increasing_id())
    return rows.select("doc_id", "row", "text").mapInArrow(work, "doc_id bigint, row bigint, a binary, b binary")


def pair_counts(rows: DataFrame, align: Aligner, held: int = 1_000_000) -> DataFrame:
    """(a, b, n): the links of each pair of ids, added up in each task first."""

    def work(batches):
        def sent(keys, n):
            return pa.RecordBatch.from_arrays([pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(n)], ["a", "b", "n"])

        keys, counts, waiting = [], [], 0
        for batch in small(batches, 64):
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                for *_, link_a, link_b in align(a, b):
                    keys.append(link_a << 32 | link_b)
                    counts.append(np.ones(len(link_a)))
                    waiting += len(link_a)
            if waiting > held:
                found, n = merged(keys, counts)
                keys, counts, waiting = [found], [n], 0
                if len(found) > held:
                    yield sent(found, n)
                    keys, counts = [], []
        if keys:
            yield sent(*merged(keys, counts))

    sent = rows.mapInArrow(work, "a int, b int, n bigint")
    return sent.groupBy("a", "b").agg(F.sum("n").alias("n"))


LEVELS = 8  # levels of a count for each doubling


def level(n: str):
    return F.floor(F.log2(n) * LEVELS)


def level_for(pairs: DataFrame, limit: int) -> tuple[int, bool]:
    """The least level of count at and above which there are at most ``limit``
    pairs, and whether pairs lie below it. At most 63 * LEVELS rows are seen."""
    sizes = sorted((r["level"], r["n"]) for r in pairs.groupBy(level("n").alias("level")).agg(F.count(F.lit(1)).alias("n")).collect())
    total, least = 0, 64 * LEVELS
    while sizes and total + sizes[-1][1] <= limit:
        least, n = sizes.pop()
        total += n
    return least, bool(sizes)


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
RESULT = "doc_id bigint, row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string, rest array<struct<a:int,b:int,links:bigint>>"
REST = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("links", pa.int64())]))


def digested(rows: DataFrame, align: Aligner, table) -> DataFrame:
    """Numbers and digests of the documents; ``rest`` has the links whose pairs
    the broadcast ``table`` (sorted keys, counts, whether best) doesn't hold."""

    def work(batches):
        keys, counts, best = table.value
        # An id and the sign behind it: of the same list, of the other tokenizer, of the next group.
        words = [f"{i}{sign}" for i in range(max(map(len, align.lengths))) for sign in ",|;"]
        for batch in small(batches, 64):
            out = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                n = dict.fromkeys(NUMBERS, 0)
                digest, rest, before = hashlib.sha256(), [], ""
                for ids_a, ids_b, group_a, group_b, link_a, link_b in align(a, b):
                    ids = np.concatenate([ids_a, ids_b])
                    place = np.concatenate([2 * group_a, 2 * group_b + 1])
                    order = np.argsort(place, kind="stable")
                    place = place[order]
                    sign = np.full(len(order), 2)
                    sign[:-1] = np.where(place[1:] == place[:-1], 0, np.where(place[1:] >> 1 == place[:-1] >> 1, 1, 2))
                    text = "".join(map(words.__getitem__, (ids[order] * 3 + sign).tolist()))
                    digest.update((before + text[:-1]).encode())
                    before = ";"
                    links = link_a << 32 | link_b
                    at = np.searchsorted(keys, links)
                    known = at < len(keys)
                    known[known] = keys[at[known]] == links[known]
                    n["n_a"] += len(ids_a)
                    n["n_b"] += len(ids_b)
                    n["n_groups"] += int(group_a[-1]) + 1
                    n["n_links"] += len(links)
                    n["n_best"] += int(best[at[known]].sum())
                    n["count_sum"] += int(counts[at[known]].sum())
                    if not known.all():
                        kinds, many = np.unique(links[~known], return_counts=True)
                        rest += [{"a": k >> 32, "b": k & 0xFFFFFFFF, "links": m} for k, m in zip(kinds.tolist(), many.tolist(), strict=True)]
                out.append((*(n[c] for c in NUMBERS), digest.hexdigest() if n["n_a"] else "", rest))
            columns = list(zip(*out, strict=True)) or [[]] * 8
            arrays = [*(pa.array(c, pa.int64()) for c in columns[:6]), pa.array(columns[6], pa.string()), pa.array(columns[7], REST)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), *arrays], ["doc_id", "row", *NUMBERS, "groups_sha256", "rest"])

    return rows.mapInArrow(work, RESULT)


def align_documents(docs: DataFrame, path_a: str, path_b: str, frequent: int = 1 << 20) -> DataFrame:
    """One row per document with the numbers of its tokens, groups and links,
    and the digest of its groups. ``frequent`` bounds the table of pair counts
    that tasks hold; pairs beyond it are joined."""
    spark = docs.sparkSession
    with open(path_a, encoding="utf-8") as f:
        vocabulary_a = f.read()  # a few megabytes each, sent with the tasks: executors need no file
    with open(path_b, "rb") as f:
        model_b = f.read()
    both = Pair(vocabulary_a, model_b)
    lengths = tuple(np.array([len(x) for x in t.bytes], np.int64) for t in (both.a, both.b))
    align = Aligner(lengths, both.kinds)
    work, keep = written_table(spark, "token-alignment"), written_table(spark, "token-alignment-result")
    try:
        rows = work(encoded(docs, vocabulary_a, model_b))
        counted = work(pair_counts(rows, align))
        # One row per id of B: no more than its vocabulary has.
        top = counted.groupBy("b").agg(F.max("n").alias("top"))
        pairs = counted.join(F.broadcast(top), "b").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))
        least, more = level_for(counted, frequent)
        known = pairs.filter(level("n") >= least).select(F.shiftleft(F.col("a").cast("bigint"), 32).bitwiseOR(F.col("b").cast("bigint")).alias("key"), "n", "best").toArrow()
        key, n, best = (known.column(c).to_numpy() for c in ("key", "n", "best"))
        order = np.argsort(key)
        table = spark.sparkContext.broadcast((key[order], n[order], best[order]))
        found = keep(digested(rows, align, table))
        if more:
            links = found.select("row", F.inline("rest"))
            rare = pairs.filter(level("n") < least)
            late = links.join(rare, ["a", "b"]).groupBy("row").agg(F.sum(F.col("links") * F.col("n")).alias("_sum"), F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("_best"))
            added = found.join(late, "row", "left")
            found = keep(added.withColumns({"n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))}).drop("rest"))
    finally:
        work.cleanup()
    return found.select("doc_id", *NUMBERS, "groups_sha256")


def query(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return align_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
