"""The binary (23, 12, 7) Golay code as a fuzzy hash of 23-bit words.

The code is perfect: every word lies within three bits of exactly one
codeword. The keys of a word are the codewords of all words at most one bit
away: one key for words within two bits of their codeword, six for the rest.
Two words that differ in at most two bits share a key, since some word lies
within one bit of both.
"""

from __future__ import annotations

import numpy as np

BITS, DATA_BITS, GENERATOR = 23, 12, 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
MOST_KEYS = 6


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of each word, as a polynomial over GF(2), by the generator."""
    left = words.astype(np.int64).copy()
    for bit in range(BITS - 1, BITS - DATA_BITS - 1, -1):
        left ^= np.where(left >> bit & 1, GENERATOR << (bit - (BITS - DATA_BITS)), 0)
    return left


def _errors() -> np.ndarray:
    """The error pattern of up to three bits for each of the 2048 syndromes."""
    ones = [1 << i for i in range(BITS)]
    patterns = [0, *ones, *(a | b for i, a in enumerate(ones) for b in ones[:i]), *(a | b | c for i, a in enumerate(ones) for j, b in enumerate(ones[:i]) for c in ones[:j])]
    found = np.zeros(1 << (BITS - DATA_BITS), dtype=np.int64)
    found[syndromes(np.array(patterns))] = patterns
    return found


ERRORS = _errors()


def decode(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each word."""
    return (words.astype(np.int64) ^ ERRORS[syndromes(words)]) >> (BITS - DATA_BITS)


def keys(words: np.ndarray) -> np.ndarray:
    """Sorted distinct keys of each word, as rows of ``MOST_KEYS``, padded with -1."""
    near = np.concatenate([decode(words)[:, None], *(decode(words ^ (1 << i))[:, None] for i in range(BITS))], axis=1)
    near.sort(axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    near = -np.sort(-near, axis=1)
    return near[:, :MOST_KEYS]
