"""Words and their hashes for a run of texts at once, with numpy over the UTF-8 bytes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

from martloom.llm.common import text_bytes

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
S27, S30, S31 = np.uint64(27), np.uint64(30), np.uint64(31)

CODES = np.arange(256, dtype=np.uint8)
LOWER_ASCII = np.where((CODES >= 0x41) & (CODES <= 0x5A), CODES + 32, CODES).astype(np.uint8)
IS_SPACE = (CODES == 0x20) | ((CODES >= 0x09) & (CODES <= 0x0D))
NOT_SPACE = ~IS_SPACE
# Digits, lower-case letters, and every byte of a character beyond ASCII.
IS_NAME = ((CODES >= 0x30) & (CODES <= 0x39)) | ((CODES >= 0x61) & (CODES <= 0x7A)) | (CODES >= 0x80)
BYTE_VALUES = np.random.default_rng(20_240_501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def nth(k: int) -> np.uint64:
    """The k-th of a fixed sequence of odd-looking constants."""
    return np.uint64(k * int(ODD) % (1 << 64))


def mixed(values: np.ndarray) -> np.ndarray:
    """Each value scrambled over all 64 bits (a bijection)."""
    values = (values ^ (values >> S30)) * MIX_1
    values = (values ^ (values >> S27)) * MIX_2
    return values ^ (values >> S31)


@cache
def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ODD modulo 2^64, and of its inverse."""
    inverse = np.full(length, pow(int(ODD), -1, 1 << 64), dtype=np.uint64)
    factors = np.full(length, ODD, dtype=np.uint64)
    inverse[:1] = factors[:1] = 1
    return np.multiply.accumulate(factors), np.multiply.accumulate(inverse)


def powers_for(length: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (length - 1).bit_length())
    # Tables beyond one slice serve a single long text and are not kept.
    up, down = powers(size) if size <= 1 << 21 else powers.__wrapped__(size)
    return up[:length], down[:length]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes: equal spans hash alike wherever they stand."""
    up, down = powers_for(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[:-1], out=sums[1:])
    found = (sums[end] - sums[start]) * down[start]
    return mixed(found + (end - start).astype(np.uint64) * ODD)


@dataclass
class Words:
    """The words of some texts: of which text, and from which byte to which."""

    data: np.ndarray
    offsets: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.offsets) - 1

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.texts)

    def firsts(self) -> np.ndarray:
        """Index of each text's first word."""
        return np.cumsum(self.counts()) - self.counts()


def find_words(strings: pa.Array, is_word: np.ndarray, fold: np.ndarray | None = None) -> Words:
    """Longest runs of bytes of a class; fold maps bytes first. A word never reaches over the end of its text."""
    data, offsets = text_bytes(strings)
    data = data if fold is None else fold[data]
    inside = is_word[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, offsets, doc, start, end)


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flagged bytes each text has."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def windows(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word of each window of so many words of one text, and the hash of the window."""
    if len(hashes) < size:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    last = len(hashes) - size + 1
    first = np.flatnonzero(doc[:last] == doc[size - 1 :])
    found = np.zeros(len(first), dtype=np.uint64)
    for k in range(size):
        found = mixed(found + hashes[first + k] + nth(k + 1))
    return first, found
