"""Packing of tokenised documents into sequences of a fixed length.

Documents are cut into pieces of ``size`` tokens and a rest. Shortest-pack-
first works on the histogram of the pieces' lengths alone: lengths are placed
longest first, each count into the patterns that have the least room that
still fits it (the shortest remaining room first), and pattern counts are
split as they fill. The result, patterns with their counts, is as small as
the histogram; it is joined back to the pieces by their rank among those of
their length.

Ranks are taken without bringing a length together in one task: pieces are
numbered within (length, bucket of the doc_id's hash), and the buckets'
counts, summed up in order, give the rest.

Defined results: null and empty texts are the end token alone. Repeated rows
are packed as often as they appear.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rollcall.llm.common import Memo, pick, small
from rollcall.session import written_table

SIZE, END_ID = 4096, 2
PIECES = "doc_id bigint, row bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
# White space for str.split that isn't white space for the tokenizer.
_UNLIKE = re.compile("[\x1c-\x1f]")


class Words:
    """Ids of pieces of text without white space, as little-endian bytes.

    Plain words (Latin letters, perhaps with signs behind) go through the same
    merges in ``tiktoken``, whose merging is faster: its ranks are the ids of
    the vocabulary, in which merged tokens stand in the order of their merges,
    and ``\\x01`` marks the end of a word. Everything else goes to the tokenizer;
    signs behind words, which recur with ever other words, do so once.
    """

    PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?#$%&*|<>]*)")
    MARK, END_OF_WORD = b"\x01", "</w>"

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_str(vocabulary)
        model = json.loads(vocabulary)["model"]
        self.signs = Memo(self.whole)
        self.merges = self._merges(model) if model["type"] == "BPE" and model["end_of_word_suffix"] == self.END_OF_WORD else None

    def _merges(self, model: dict) -> tiktoken.Encoding | None:
        ids = model["vocab"]
        merged = [ids["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if merged != sorted(merged) or len(set(merged)) < len(merged) or merged[0] < 512:
            return None
        # Byte-level vocabularies write byte b as a printable character.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        signs = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
        known = [*range(512), *merged]
        by_id = {i: t for t, i in ids.items()}
        ranks = {}
        for i in known:
            token, last = by_id[i].removesuffix(self.END_OF_WORD), by_id[i].endswith(self.END_OF_WORD)
            ranks[bytes(signs[c] for c in token) + (self.MARK if last else b"")] = i
        return tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}) if len(ranks) == len(known) else None

    def __call__(self, part: str) -> bytes:
        plain = self.PLAIN.fullmatch(part) if self.merges else None
        if not plain:
            return self.whole(part)
        ids = array("I", self.merges.encode_ordinary(plain[1].lower() + "\x01")).tobytes()
        return ids + self.signs[plain[2]] if plain[2] else ids

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def token_bytes(words: Words, text: str, memo: Memo) -> bytes:
    """The text's ids, little-endian unsigned 32-bit.

    The tokenizer splits at white space before anything else, so that a text's
    ids are those of its parts between white space, which are kept by part.
    """
    if _UNLIKE.search(text):
        return words.whole(text)
    return b"".join(map(memo.__getitem__, text.split()))


def pieces(docs: DataFrame, tokenizer_path: str, size: int = SIZE) -> DataFrame:
    """One row per piece: its place in the document, its length and checksum."""
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = f.read()  # a few megabytes, sent with the tasks: executors need no file

    def work(batches):
        words = Words(vocabulary)
        memo = Memo(words, 400_000)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for b in small(batches):
            out = []
            for doc_id, row, text in zip(b.column("doc_id").to_pylist(), b.column("row").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = token_bytes(words, text or "", memo) + end
                n = len(ids) // 4
                view = memoryview(ids)
                out += [(doc_id, row, a, min(size, n - a), zlib.crc32(view[4 * a : 4 * (a + size)]), n) for a in range(0, n, size)]
            names = ("doc_id", "row", "start", "length", "ids_crc32", "doc_tokens")
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 6, names)

    plain = pick(docs, doc_id="bigint", text="string").withColumn("row", F.monotonically_increasing_id())
    return plain.select("doc_id", "row", "text").mapInArrow(work, PIECES)


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a pattern, number of sequences that follow it), from the
    number of pieces of each length."""
    open_by_room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # room left -> pattern -> count
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        # What this length fills must not be filled again before all rooms were seen: a pattern takes it once a round.
        while left > 0:
            rooms = sorted(r for r, kinds in open_by_room.items() if r >= length and kinds)
            if not rooms:
                each = size // length
                for many, count in ((each, left // each), (left % each, 1)):
                    if many and count:
                        kind = (length,) * many
                        room = open_by_room[size - length * many]
                        room[kind] = room.get(kind, 0) + count
                break
            room = rooms[0]
            kind = min(open_by_room[room])
            here = open_by_room[room].pop(kind)
            fits = room // length  # pieces that one sequence of this pattern can still take
            full = min(here, left // fits)
            for many, count in ((fits, full), (left - full * fits if full < here and left - full * fits < fits else 0, 1)):
                if many and count:
                    grown = kind + (length,) * many
                    target = open_by_room[room - length * many]
                    target[grown] = target.get(grown, 0) + count
                    here, left = here - count, left - many * count
            if here:
                open_by_room[room][kind] = open_by_room[room].get(kind, 0) + here
    return sorted(((kind, n) for kinds in open_by_room.values() for kind, n in kinds.items()), key=lambda p: (p[0], p[1]), reverse=True)


def places(found: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: the first rank, first sequence and offset of each run of ranks.

    A pattern's sequences are numbered in a row; each of its slots takes as
    many ranks of its length in a row.
    """
    used: dict[int, int] = defaultdict(int)
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for kind, n in found:
        offset = 0
        for length in kind:
            runs[length].append((used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return {length: tuple(np.array(c, dtype=np.int64) for c in zip(*r, strict=True)) for length, r in runs.items()}


def ranked(rows: DataFrame) -> DataFrame:
    """Adds ``rank``: a number from 0 among the rows of the same length."""
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "row"), F.lit(buckets)).cast("int"))
    own = rows.withColumn("_n", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "row", "start")))
    counts = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    # One row per bucket and length: a window over at most `buckets` rows.
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return own.join(first, ["length", "bucket"]).withColumn("rank", F.col("first") + F.col("_n") - 1).drop("_n", "first", "bucket")


def pack(docs: DataFrame, tokenizer_path: str, size: int = SIZE) -> DataFrame:
    """One row per piece with its sequence and its offset there."""
    keep = written_table(docs.sparkSession, "packing")
    rows = keep(pieces(docs, tokenizer_path, size))
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `size` rows
    where = places(patterns(histogram, size))

    def work(batches):
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for part in np.split(order, np.nonzero(np.diff(length[order]))[0] + 1):
                if len(part):
                    first, start, at = where[int(length[part[0]])]
                    run = np.searchsorted(first, rank[part], side="right") - 1
                    sequence[part], offset[part] = start[run] + rank[part] - first[run], at[run]
            kept = [b.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return ranked(rows).mapInArrow(work, schema)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(docs: DataFrame) -> DataFrame:
    return pack(docs, vocabulary_path())


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in packed sequences."""
    return pack(docs, vocabulary_path())
