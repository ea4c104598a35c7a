"""Text quality by logistic regression on hashed word n-grams.

Features are single words and pairs of neighbouring words, as written and as
shapes (letters, digits and runs reduced to one sign; a word that repeats its
neighbour has a sign of its own), hashed into ``2**bits`` bins. The weights
are trained with follow-the-regularised-leader updates (FTRL-proximal); a
score is the sparse dot product of the weights with the text's counts,
divided by the square root of their number.

Defined results: null and empty texts have no features and get the score of
the intercept. Without training rows all weights are 0 and every score is
0.5. Whole texts are used.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import Memo, bounded_examples, fold_is, learned, pick, small

BITS = 18
SCHEMA = "doc_id bigint, score double"
_RUNS = re.compile(r"(.)\1+")
_UPPER, _LOWER, _DIGIT = re.compile(r"[^\W\d_a-zß-öø-ÿ]"), re.compile(r"[a-zß-öø-ÿ]"), re.compile(r"\d")


def shape(word: str) -> str:
    """Capitals as X, small letters as x, digits as 9, runs as one sign."""
    return _RUNS.sub(r"\1", _UPPER.sub("X", _LOWER.sub("x", _DIGIT.sub("9", word))))


def word_code(word: str) -> int:
    """Hash of the word (low half) and of its shape (high half)."""
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) | (zlib.crc32(shape(word).encode("utf-8", "surrogatepass")) & 0x7FFFFFFF) << 32


def features(text: str | None, memo: Memo, bits: int = BITS) -> np.ndarray:
    """The bin of every n-gram of the text, repeats included."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    codes = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
    word, form = (codes & 0xFFFFFFFF).astype(np.uint64), (codes >> 32).astype(np.uint64)
    one, two = np.array([0x9E3779B97F4A7C15], dtype=np.uint64), np.array([0xC2B2AE3D27D4EB4F], dtype=np.uint64)
    same = word[:-1] == word[1:]
    hashes = [
        (word + np.uint64(1)) * one,
        (form + np.uint64(2)) * two,
        np.where(same, np.uint64(3) * one, (word[:-1] * two) ^ (word[1:] * one) * np.uint64(5)),
        np.where(same, np.uint64(7) * two, (form[:-1] * one) ^ (form[1:] * two) * np.uint64(11)),
    ]
    mixed = np.concatenate(hashes)
    return ((mixed ^ mixed >> np.uint64(29)) * one >> np.uint64(64 - bits)).astype(np.int64)


class Ftrl:
    """FTRL-proximal for logistic loss; ``n`` and ``z`` as usually named."""

    def __init__(self, size: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5):
        self.n, self.z = np.zeros(size + 1), np.zeros(size + 1)  # the last one is the intercept
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def update(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + math.exp(-max(-35.0, min(35.0, float(w @ x))))) - label) * x
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - step * w
        self.n[at] += g * g


def sparse(bins: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    at, counts = np.unique(bins, return_counts=True)
    return np.append(at, size), np.append(counts / math.sqrt(max(1, len(bins))), 1.0)


def fit(docs: DataFrame, labels: DataFrame, label: str, *, limit: int = 6000, epochs: int = 3, bits: int = BITS) -> np.ndarray:
    """Weights learned from at most ``limit`` labelled documents (the documented
    bound of the fit); ``labels`` holds only rows that may be learned from.
    """
    rows = bounded_examples(docs, labels, "doc_id", label, limit)

    def learn(batches):
        memo, examples = Memo(word_code), []
        for pdf in batches:
            for doc_id, text, y in zip(pdf["doc_id"], pdf["text"], pdf["label"], strict=True):
                at, x = sparse(features(text, memo, bits), 1 << bits)
                examples.append((zlib.crc32(str(doc_id).encode()), doc_id, at.astype(np.int32), x.astype(np.float32), int(y)))
            del pdf
        examples.sort(key=lambda e: e[:2])
        model = Ftrl(1 << bits)
        for _ in range(epochs):
            for _, _, at, x, y in examples:
                model.update(at, x.astype(np.float64), y)
        return model.weights(slice(None)).astype(np.float32)

    return learned(rows, learn, np.zeros((1 << bits) + 1, dtype=np.float32))


def predict(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, score) of every document; a score over 0.5 means label 1."""
    bits = (len(weights) - 1).bit_length() - 1

    def work(batches):
        memo = Memo(word_code)
        for b in small(batches):
            score = []
            for text in b.column("text").to_pylist():
                bins = features(text, memo, bits)
                margin = float(weights[bins].sum(dtype=np.float64)) / math.sqrt(max(1, len(bins))) + float(weights[-1])
                score.append(1 / (1 + math.exp(-max(-35.0, min(35.0, margin)))))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"])

    return pick(docs, doc_id="bigint", text="string").mapInArrow(work, SCHEMA)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = fold_is("doc_id", 3, 1)
    weights = fit(docs, pick(labels, doc_id="bigint", quality="int").filter(~held_out), "quality")
    scored = predict(docs, weights)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
