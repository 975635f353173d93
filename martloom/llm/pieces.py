"""Byte-level encoding of many texts at once, where most pieces have been seen before.

A text is cut at its spaces into chunks, each with the space before it. Arrow cuts a run of texts and numbers its distinct
chunks; each distinct one is split by the vocabulary's pattern and encoded once, and numpy puts the ids of all chunks
together. Ids of chunks are remembered in two tables of bounded size: when the newer one is full it becomes the older one,
and what is still in use moves over.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST_REMEMBERED = 32 << 20  # bytes of one table, about
ENTRY_BYTES = 240  # a key, a value and their place in the table
# Runs of white space whose split depends on more than one chunk; such texts are split as a whole.
ENTANGLED = re.compile(r"\s\s\s|\s\s\Z")


class Remembered:
    """Ids of strings as bytes, of those met lately."""

    def __init__(self, most: int):
        self.most, self.new, self.old, self.held = most, {}, {}, 0

    def find(self, strings: list[str]) -> tuple[list[bytes | None], list[str]]:
        """The ids of each string, None where they are not known, and the strings that are not known."""
        found = list(map(self.new.get, strings))
        missing, moved = [], []
        for k, ids in enumerate(found):
            if ids is None:
                found[k] = ids = self.old.get(strings[k])
                (missing if ids is None else moved).append(strings[k])
        self.add(moved, list(map(self.old.get, moved)))
        return found, missing

    def add(self, strings: list[str], ids: list[bytes]) -> None:
        if self.held > self.most:
            self.old, self.new, self.held = self.new, {}, 0
        self.new.update(zip(strings, ids, strict=True))
        self.held += ENTRY_BYTES * len(strings) + sum(map(len, strings)) + sum(map(len, ids))


def gathered(tables: list[bytes], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of tables[which[0]], tables[which[1]], ... one after the other, and how many each has."""
    flat = np.frombuffer(b"".join(tables), "<u4")
    sizes = np.array([len(t) >> 2 for t in tables], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    counts = sizes[which]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(begins[which] - ends + counts, counts)
    return flat[at], counts


class PieceEncoder:
    """Ids of texts.

    split(text) gives the pieces of a text; encode_pieces(pieces) gives the ids of distinct pieces as little-endian unsigned
    32-bit numbers. The pattern must keep letters together with a space before them; then a chunk is split like the text it
    stands in, unless the text is entangled.
    """

    def __init__(self, split: Callable[[str], list[str]], encode_pieces: Callable[[list[str]], list[bytes]]):
        self.split, self.encode_pieces = split, encode_pieces
        self.known = Remembered(MOST_REMEMBERED)

    def of_strings(self, strings: list[str]) -> list[bytes]:
        """Ids of distinct strings, each split on its own."""
        found, missing = self.known.find(strings)
        if missing:
            # A word of plain letters, with or without a space before it, is one piece.
            words = [s for s in missing if s.isascii() and (s[1:] if s[0:1] == " " else s).isalpha()]
            ids = dict(zip(words, self.encode_pieces(words), strict=True))
            others = [s for s in missing if s not in ids]
            parts = list(map(self.split, others))
            pieces = list(set(chain.from_iterable(parts)))
            of_piece = dict(zip(pieces, self.encode_pieces(pieces), strict=True))
            ids.update((s, b"".join([of_piece[x] for x in p])) for s, p in zip(others, parts, strict=True))
            self.known.add(list(ids), list(ids.values()))
            found = [ids[s] if x is None else x for s, x in zip(strings, found, strict=True)]
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and the number of ids of each text."""
        tangled = np.array([ENTANGLED.search(t) is not None for t in texts], dtype=bool)
        simple = pa.array([t for t, x in zip(texts, tangled.tolist(), strict=True) if not x], type=pa.large_string())
        cut = pc.split_pattern(simple, " ")
        values, edges = cut.flatten(), np.asarray(cut.offsets).astype(np.int64)
        edges = edges - (edges[0] if len(edges) else 0)
        coded = values.dictionary_encode()
        which = np.asarray(coded.indices).astype(np.int64)
        # The first chunk of a text has no space before it; an entangled text is a chunk of its own kind.
        first = edges[:-1]
        inner = np.ones(len(which), dtype=bool)
        inner[first] = False
        used = np.unique(which[inner])
        heads = values.take(pa.array(first)).dictionary_encode()
        names = coded.dictionary.take(pa.array(used)).to_pylist()
        tables = self.of_strings([" " + c for c in names])
        place = np.zeros(len(coded.dictionary), dtype=np.int64)
        place[used] = np.arange(len(used))
        slots = np.where(inner, place[which], 0)
        slots[first] = len(tables) + np.asarray(heads.indices).astype(np.int64)
        tables = tables + self.of_strings(heads.dictionary.to_pylist())
        if not tangled.any():
            ids, counts = gathered(tables, slots)
            return ids, np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)
        whole = [t for t, x in zip(texts, tangled.tolist(), strict=True) if x]
        pieces = [self.split(t) for t in whole]
        distinct = list(set(chain.from_iterable(pieces)))
        ids_of = dict(zip(distinct, self.encode_pieces(distinct), strict=True))
        begin = len(tables)
        tables = tables + [b"".join([ids_of[p] for p in parts]) for parts in pieces]
        # Chunks text after text, in the order of the texts.
        sizes = np.ones(len(texts), dtype=np.int64)
        sizes[~tangled] = np.diff(edges)
        starts = np.cumsum(sizes) - sizes
        order = np.empty(int(sizes.sum()), dtype=np.int64)
        plain = np.repeat(~tangled, sizes)
        order[plain] = slots
        order[~plain] = begin + np.arange(len(whole))
        ids, counts = gathered(tables, order)
        return ids, np.add.reduceat(counts, starts)
