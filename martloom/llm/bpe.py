"""Byte-level BPE encoding and decoding from a file of ranks, with segment trees.

Each piece of a text has a segment tree over its byte positions. A leaf holds the rank of the pair that starts at a live
position (a large number if there is none), an inner node the least rank below it; going down to the left on ties gives
the leftmost position of the least rank. A merge makes the right neighbour dead and updates the leaves of the merged
position and of its live neighbour to the left: logarithmic work, whatever the length of the piece. Trees of pieces of
similar length are rows of one array, so that a step of all of them is one step of numpy; a single very long piece is
an array with one row.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from martloom.llm.common import text_bytes, with_text_columns
from martloom.llm.pieces import PieceEncoder

NONE = np.int64(1) << 40
ROW_BYTES = 1 << 18  # bytes of the pieces that are merged together, at some 80 bytes of arrays each


class Vocabulary:
    """Ranks of byte strings, and for each pair of tokens the rank of what they make together."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        # All tokens one after the other, by rank, and where each begins (a rank without a token is empty).
        by_rank = [self.bytes_of.get(rank, b"") for rank in range(max(self.bytes_of) + 1)]
        self.flat = np.frombuffer(b"".join(by_rank), dtype=np.uint8)
        self.begins = np.concatenate([[0], np.cumsum([len(t) for t in by_rank])])
        self.byte_ranks = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)

    def decoded(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The bytes that the ids of each text stand for. An id that the file lacks is an error."""
        if len(ids) and (int(ids.max()) >= len(self.begins) - 1 or (self.begins[ids + 1] == self.begins[ids]).any()):
            raise ValueError("an id without a token")
        sizes = self.begins[ids + 1] - self.begins[ids]
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.begins[ids] - ends + sizes, sizes)
        offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        large = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(self.flat[at])])
        return large.cast(pa.binary())

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens; NONE where they make no token or there is no right one (-1)."""
        keys = left << 32 | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (right >= 0) & (left >= 0), self.pair_ranks[at], NONE)


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_rows(vocab: Vocabulary, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each row of bytes (padded to a power of two) and which positions are live in the end."""
    count, width = rows.shape
    levels = width.bit_length() - 1
    at = np.arange(width)
    token = np.where(at < lengths[:, None], vocab.byte_ranks[rows], -1)
    following = np.where(at + 1 < lengths[:, None], at + 1, -1)  # the next live position
    before = np.broadcast_to(at - 1, rows.shape).copy()  # the live position before
    tree = np.full((count, 2 * width), NONE)
    right = np.full_like(token, -1)
    right[:, :-1] = token[:, 1:]
    tree[:, width:] = vocab.pair(token, right)
    for level in range(levels - 1, -1, -1):
        low = 1 << level
        tree[:, low : 2 * low] = np.minimum(tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2])

    def update(which: np.ndarray, position: np.ndarray, rank: np.ndarray) -> None:
        node = position + width
        tree[which, node] = rank
        for _ in range(levels):
            node >>= 1
            tree[which, node] = np.minimum(tree[which, 2 * node], tree[which, 2 * node + 1])

    active = np.flatnonzero(tree[:, 1] < NONE) if width > 1 else np.empty(0, np.int64)
    while len(active):
        least = tree[active, 1]
        node = np.ones(len(active), dtype=np.int64)
        for _ in range(levels):
            node = 2 * node
            node += tree[active, node] != least  # to the left on ties
        spot = node - width
        gone = following[active, spot]
        after = following[active, gone]
        token[active, spot] = least
        token[active, gone] = -1
        following[active, spot] = after
        linked = after >= 0
        before[active[linked], after[linked]] = spot[linked]
        update(active, gone, np.full(len(active), NONE))
        update(active, spot, vocab.pair(least, np.where(linked, token[active, after], -1)))
        left = before[active, spot]
        has = left >= 0
        which, left = active[has], left[has]
        update(which, left, vocab.pair(token[which, left], least[has]))
        active = active[tree[active, 1] < NONE]
    return token, token >= 0


def encode_pieces(vocab: Vocabulary, pieces: list[str]) -> list[bytes]:
    """Ids of each piece as little-endian unsigned 32-bit numbers; a piece that is a token itself is that token."""
    found: list[bytes] = [b""] * len(pieces)
    by_width: dict[int, list[tuple[int, bytes]]] = {}
    for k, piece in enumerate(pieces):
        raw = piece.encode()
        rank = vocab.ranks.get(raw)
        if rank is not None:
            found[k] = rank.to_bytes(4, "little")
        elif raw:
            by_width.setdefault(1 << max(1, (len(raw) - 1).bit_length()), []).append((k, raw))
    for width, held in by_width.items():
        step = max(1, ROW_BYTES // width)
        for at in range(0, len(held), step):
            part = held[at : at + step]
            lengths = np.array([len(raw) for _, raw in part])
            rows = np.frombuffer(b"".join(raw.ljust(width, b"\0") for _, raw in part), dtype=np.uint8)
            token, live = merge_rows(vocab, rows.reshape(len(part), width), lengths)
            flat = token[live].astype("<u4").tobytes()
            ends = (np.cumsum(live.sum(axis=1)) * 4).tolist()
            begin = 0
            for (k, _), end in zip(part, ends, strict=True):
                found[k] = flat[begin:end]
                begin = end
    return found


def encoder(path: str, pattern: str) -> PieceEncoder:
    """One for each task. White space is what Unicode calls so, as in the original pattern."""
    split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")).findall
    vocab = vocabulary(path)
    return PieceEncoder(split, lambda pieces: encode_pieces(vocab, pieces))


def binaries(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The ids of each text as one binary value."""
    offsets = np.concatenate([[0], np.cumsum(counts)]) * 4
    raw = pa.py_buffer(np.ascontiguousarray(ids, dtype="<u4"))
    large = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), raw])
    return large.cast(pa.binary())


def encode(docs: DataFrame, text: str, path: str, pattern: str, ids: str = "token_ids") -> DataFrame:
    """docs with the ids of each text, as little-endian unsigned 32-bit numbers (binary); NULL counts as empty.

    path names a rank file that every executor has. Characters of any kind can be encoded, so no text fails; special
    tokens are ordinary text.
    """

    def make() -> Callable[[pa.Array], list]:
        known = encoder(path, pattern)
        return lambda texts: [binaries(*known.encode(texts.fill_null("").to_pylist()))]

    return with_text_columns(docs, text, StructType([StructField(ids, BinaryType())]), make)


def decode(docs: DataFrame, path: str, ids: str = "token_ids", raw: str = "decoded") -> DataFrame:
    """docs with the bytes that the ids stand for; NULL ids give NULL. An id that the file lacks is an error."""

    def make() -> Callable[[pa.Array], list]:
        vocab = vocabulary(path)

        def work(coded: pa.Array) -> list:
            data, edges = text_bytes(coded)
            found = vocab.decoded(np.frombuffer(data.tobytes(), "<u4").astype(np.int64), np.diff(edges) // 4)
            return [pc.if_else(pc.is_valid(coded), found, pa.scalar(None, pa.binary()))]

        return work

    return with_text_columns(docs, ids, StructType([StructField(raw, BinaryType())]), make)


def encode_and_decode(
    docs: DataFrame, text: str, path: str, pattern: str, ids: str = "token_ids", raw: str = "decoded"
) -> DataFrame:
    """encode and then decode in one task, for checks: one Python worker and one vocabulary for both."""

    def make() -> Callable[[pa.Array], list]:
        known, vocab = encoder(path, pattern), vocabulary(path)

        def work(texts: pa.Array) -> list:
            found, counts = known.encode(texts.fill_null("").to_pylist())
            stored = binaries(found, counts)
            back, edges = text_bytes(stored)
            return [stored, vocab.decoded(np.frombuffer(back.tobytes(), "<u4").astype(np.int64), np.diff(edges) // 4)]

        return work

    return with_text_columns(docs, text, StructType([StructField(ids, BinaryType()), StructField(raw, BinaryType())]), make)


def digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text, through encode and decode.

    NULL and empty texts have no ids. Rows with equal ids or texts are rows of their own; an empty table gives an empty
    result. Other columns are not read.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return encode_and_decode(plain, "text", path, pattern).select(
        "doc_id",
        F.floor(F.octet_length("token_ids") / 4).cast(LongType()).alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
