"""Toxicity by the nearest labelled examples.

Terms are words and their first four and five letters; every term of the
examples spans a dimension, none is left out. A term weighs
``(1 + ln count) x idf x |phi|``, ``phi`` being the correlation of its
presence with the label over the examples (chi-squared over their number, its
root), which doesn't grow with the number of labels; terms that no example
holds weigh nothing. Texts are unit vectors.

The examples sit in an inverted index; the lists of its most frequent terms are
kept as rows of a dense matrix. Texts are met by it some at a time: a product in
float32 gives the frequent terms' part of the cosines with all examples, the
lists add that of every other term. Examples whose sum may reach the k best, by
the bound on float32's error, are scored again in float64, so the k nearest are
exact. A score is the similarity-weighted share of toxic examples among them,
smoothed by the share of all.

Defined results: texts without any weighing term (empty and null ones too)
get the share of toxic documents among the examples without one. Examples with
equal vectors are one example, which votes its share of toxic rows; ties go to
the smallest doc_id. Repeated rows are scored alike. Rows without an id are
scored, not learned from. Long texts are read whole. No labelled rows: score 0.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import Memo, bounded_examples, fold_is, learned, pick, small

SCHEMA = "doc_id bigint, score double, evidence array<string>"
# Which lists are kept as dense rows; any values give the same result.
FREQUENT = 16  # terms that more than one in so many examples hold
CELLS = 1 << 23  # of the dense rows, at most
TOGETHER = 256  # texts that meet the dense rows at once
_WORD = re.compile(r"[^\W_]+")


def terms(chunk: str) -> tuple[str, ...]:
    """The terms of a piece of text without white space."""
    out = []
    for w in _WORD.findall(chunk.lower()):
        out.append(w)
        if len(w) > 4:
            out.append(w[:4] + "-")
            if len(w) > 5:
                out.append(w[:5] + "-")
    return tuple(out)


@dataclass
class Index:
    """Unit vectors of distinct examples, row by row."""

    vocabulary: dict[str, int] = field(default_factory=dict)
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))  # by term
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int64))  # of rows
    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int32))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.float32))
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    count: np.ndarray = field(default_factory=lambda: np.zeros(0))
    example: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    none: tuple[float, float] = (0.0, 0.0)  # toxic and all examples without a weighing term

    def __len__(self) -> int:
        return len(self.starts) - 1

    def build(self) -> Index:
        """The dense rows of the most frequent terms and the lists of the others."""
        n, size = len(self), len(self.weight)
        holding = np.bincount(self.terms, minlength=size)
        common = np.nonzero(holding * FREQUENT > n)[0]
        common = common[np.argsort(-holding[common], kind="stable")[: CELLS // max(1, n)]]
        self.slot = np.full(size, -1)
        self.slot[common] = np.arange(len(common))
        rows, slot = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.starts)), self.slot[self.terms]
        dense, others = slot >= 0, slot < 0
        self.dense = np.zeros((len(common), n), np.float32)
        self.dense[slot[dense], rows[dense]] = self.values[dense]
        of = self.terms[others]
        by_term = np.argsort(of, kind="stable")  # rows ascend within a term
        self.rows, self.row_values = rows[others][by_term], self.values[others][by_term]
        self.lists = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=size))]).astype(np.int32)
        # Weights aren't negative and a cosine isn't above 1, so that rounding adds up to no more than this.
        self.error = (len(common) + 4) * 2.0**-23
        return self

    def vector(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sparse unit vector (terms, weights) of a text's term ids; empty if none weighs."""
        at, counts = np.unique(ids, return_counts=True)
        w = (1 + np.log(counts)) * self.weight[at]
        at, w = at[w > 0], w[w > 0]
        return at, w / np.linalg.norm(w) if len(w) else w

    def summed(self, at: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The part of every example's cosine that some terms in lists give."""
        sizes = self.lists[at + 1] - self.lists[at]
        ends = np.cumsum(sizes, dtype=np.int32)
        # The places of the lists' entries, one list after another.
        p = np.repeat(self.lists[at] - (ends - sizes), sizes)
        p += np.arange(len(p), dtype=np.int32)
        values = np.repeat(w, sizes)
        values *= self.row_values.take(p)
        return np.bincount(self.rows.take(p), values, minlength=len(self))

    def nearest(self, at: np.ndarray, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the k examples nearest to a sparse unit vector,
        of equal ones the first; those without a common term don't count."""
        return next(self.nearest_of([(at, w)], k))

    def nearest_of(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What ``nearest`` finds, for each of some vectors."""
        for first in range(0, len(vectors), TOGETHER):
            part = vectors[first : first + TOGETHER]
            queries, places = np.zeros((len(part), len(self.dense)), np.float32), [self.slot[at] for at, _ in part]
            for query, slot, (_, w) in zip(queries, places, part, strict=True):
                query[slot[slot >= 0]] = w[slot >= 0]
            for near, slots, (at, w) in zip(queries @ self.dense, places, part, strict=True):
                yield self.best(near, slots, at, w, k)

    def best(self, near: np.ndarray, slot: np.ndarray, at: np.ndarray, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest, from what the dense rows give to within ``error``."""
        if not len(at) or not len(self) or not k:
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        dense = slot >= 0
        others = self.summed(at[~dense], w[~dense])
        near = near + others
        least = np.partition(near, len(near) - k)[len(near) - k] if len(near) > k else 0.0
        can = np.nonzero(near >= least - 2 * self.error)[0]
        score = others[can] + w[dense] @ self.dense[np.ix_(slot[dense], can)].astype(float)
        found = np.round(score, 9)
        some = np.nonzero(found > 0)[0]
        order = some[np.lexsort((self.example[can[some]], -found[some]))[:k]]
        return can[order], score[order]


def coded(text: str | None, memo: Memo) -> np.ndarray:
    """The ids of the text's terms that the index knows, repeats included."""
    return np.frombuffer(b"".join(map(memo.__getitem__, (text or "").split())), dtype=np.int32)


def known(vocabulary: dict[str, int]) -> Memo:
    """The ids of the ``terms`` of pieces of text, of those in the vocabulary."""
    words, fours, fives = {}, {}, {}
    for term, i in vocabulary.items():
        of = words if term[-1] != "-" else fours if len(term) == 5 else fives
        of[term.removesuffix("-")] = np.int32(i).tobytes()

    def one(w: str) -> bytes:
        found = words.get(w, b"")
        if len(w) > 4:
            found += fours.get(w[:4], b"")
            if len(w) > 5:
                found += fives.get(w[:5], b"")
        return found

    def ids(chunk: str) -> bytes:
        chunk = chunk.lower()
        return one(chunk) if chunk.isalnum() else b"".join(map(one, _WORD.findall(chunk)))

    return Memo(ids)


def indexed(rows: list[tuple[int, str, int]]) -> Index:
    """The index of (doc_id, text, label) rows."""
    rows = sorted(rows)
    vocabulary: dict[str, int] = {}
    memo = Memo(lambda chunk: np.array([vocabulary.setdefault(t, len(vocabulary)) for t in terms(chunk)], dtype=np.int32).tobytes())
    coded_rows = [(coded(text, memo), doc_id, label == 1) for doc_id, text, label in rows]
    n, p, size = float(len(rows)), float(sum(r[2] for r in coded_rows)), len(vocabulary)
    holding = np.zeros((2, size))
    for ids, _, y in coded_rows:
        holding[int(y), np.unique(ids)] += 1
    both = holding.sum(axis=0)
    spread = both * (n - both) * p * (n - p)
    phi = np.abs(holding[1] * (n - p) - holding[0] * p) / np.sqrt(np.where(spread > 0, spread, np.inf))
    index = Index(vocabulary, (np.log((1 + n) / (1 + both)) + 1) * phi)
    distinct: dict[bytes, list] = {}
    for ids, doc_id, y in coded_rows:
        at, w = index.vector(ids)
        one = distinct.setdefault(at.tobytes() + w.tobytes(), [at, w, doc_id, 0, 0])
        one[3:] = [one[3] + y, one[4] + 1]
    empty = [x for x in distinct.values() if not len(x[0])]
    index.none = (empty[0][3], empty[0][4]) if empty else (0, 0)
    kept = sorted((x for x in distinct.values() if len(x[0])), key=lambda x: (x[0][np.argsort(-x[1], kind="stable")[:3]].tolist(), x[2]))
    index.starts = np.cumsum([0, *(len(x[0]) for x in kept)])
    if kept:
        index.terms = np.concatenate([x[0] for x in kept]).astype(np.int32)
        index.values = np.concatenate([x[1] for x in kept]).astype(np.float32)
    index.toxic, index.count = np.array([x[3] for x in kept], float), np.array([x[4] for x in kept], float)
    index.example = np.array([x[2] for x in kept], dtype=np.int64)
    return index


def fit(docs: DataFrame, labels: DataFrame, label: str, *, limit: int = 8000) -> bytes:
    """The index, pickled as the driver only passes it on, of at most ``limit`` labelled documents (the documented bound
    of the fit); ``labels`` holds only rows that may be learned from. It grows
    with the examples' distinct terms, about 4 MB a thousand examples here."""
    rows = bounded_examples(docs, labels, "doc_id", label, limit)

    def learn(batches):
        return pickle.dumps(vars(indexed([r for pdf in batches for r in zip(pdf["doc_id"], pdf["text"], pdf["label"], strict=True)])))

    return learned(rows, learn, pickle.dumps({}))


def voted(index: Index, ids: np.ndarray, k: int) -> tuple[float, list[str]]:
    """Score and evidence of a text's term ids."""
    return next(voted_of(index, [ids], k))


def voted_of(index: Index, texts: list[np.ndarray], k: int) -> Iterator[tuple[float, list[str]]]:
    """What ``voted`` gives, for each of some texts."""
    base = (index.toxic.sum() + index.none[0]) / max(1.0, index.count.sum() + index.none[1])
    vectors = [index.vector(ids) for ids in texts]
    for (at, _), (rows, near) in zip(vectors, index.nearest_of(vectors, k), strict=True):
        if not len(at):
            yield float((index.none[0] + base) / (index.none[1] + 1.0)), []
            continue
        votes = near**2
        score = float((votes * index.toxic[rows] / index.count[rows]).sum() + base) / float(votes.sum() + 1)
        yield score, [f"{index.example[r]}:{c:.3f}" for r, c in zip(rows[:3], near[:3], strict=True)]


def predict(docs: DataFrame, model: bytes, *, k: int = 15) -> DataFrame:
    """(doc_id, score, evidence) of every document; the evidence lists the
    nearest examples as id:cosine."""

    def work(batches):
        index = Index(**pickle.loads(model)).build()
        memo = known(index.vocabulary)
        judged: dict[bytes, tuple] = {}  # of copies within a task, by the text's digest

        for b in small(batches):
            texts = b.column("text").to_pylist()
            keys = [hashlib.blake2b((t or "").encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts]
            if len(judged) >= 20_000:
                judged.clear()
            new = {key: t for key, t in zip(keys, texts, strict=True) if key not in judged}
            judged.update(zip(new, voted_of(index, [coded(t, memo) for t in new.values()], k), strict=True))
            out = [judged[key] for key in keys]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x[0] for x in out], pa.float64()), pa.array([x[1] for x in out], pa.list_(pa.string()))], ["doc_id", "score", "evidence"])

    return pick(docs, doc_id="bigint", text="string").mapInArrow(work, SCHEMA)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = fold_is("doc_id", 4, 2)
    scored = predict(docs, fit(docs, pick(labels, doc_id="bigint", toxic="int").filter(~held_out), "toxic"))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "evidence")
