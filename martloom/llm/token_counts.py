"""Token counts of every prefix of a text, by dynamic programming over prefixes of its pieces.

The vocabulary is a BPE of the tokenizers library whose last symbol of a piece carries an end mark. A tokenization is
what BPE gives exactly if no two neighbouring tokens would have merged across their border, and a text has one such
tokenization. So the state at a position is one token: the last one of the piece's BPE up to there, without the end mark.
From it every token that starts there and does not merge with it leads on, with the mark to the count of the prefix as a
text of its own, without it to the next state. One pass over a piece answers for all its prefixes.

Counts are stored as one binary value for each text; truncation and budgets are read from it, nothing is encoded again.

Layout of the value, little-endian: one byte with the width of a number (1, 2, 4), then for each prefix of 1, 2, ... code
points the difference of its count from the one before, signed; the least number of the width marks a prefix that is no
cut (it ends before a combining mark or between letters of a Hangul syllable).
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Callable
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from martloom.llm.common import fresh, with_text_columns

END_MARK = "</w>"
LIMIT = 2048
# What a task remembers of pieces it has met, in bytes.
MOST_REMEMBERED = 48 << 20
SLICE_BYTES = 2 << 20  # text whose pieces are looked up together
# Pairs of neighbours a worker remembers, some 150 bytes each.
MOST_PAIRS = 300_000
# Characters whose kind and lower case are known here: one code point each, unchanged by normalisation. Texts with any
# other one are cut by the library.
PLAIN_END = 0x250
PLAIN = [
    chr(c) for c in (0x09, 0x0A, 0x0D, *range(0x20, 0x7F), *range(0xA1, PLAIN_END))
    if len(chr(c).lower()) == 1 and ord(chr(c).lower()) < PLAIN_END
]
NOT_PLAIN = re.compile(f"[^{re.escape(''.join(PLAIN))}]")
SPACE, LETTER, NUMBER, SYMBOL = range(4)
# The contractions that the split pattern of the vocabulary knows.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def kind_of(character: str) -> int:
    if character in "\t\n\r ":
        return SPACE
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(character)[0], SYMBOL)


KINDS = np.array([kind_of(chr(c)) for c in range(PLAIN_END)], dtype=np.uint8)
LOWER = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in range(PLAIN_END)], dtype=np.uint32)


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) if b in plain else chr(0x100 + others.index(b)) for b in range(256)}


class Merges:
    """Tokens of the vocabulary, and which two of them may stand side by side."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END_MARK:
            raise ValueError("not a BPE vocabulary with word ends")
        vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.rank = {(vocab[a], vocab[b]): k for k, (a, b) in enumerate(pairs)}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token: left, right, rank of their merge
        for k, (a, b) in enumerate(pairs):
            if self.parts.setdefault(vocab[a + b], (vocab[a], vocab[b], k))[2] != k:
                raise ValueError("a token that two merges make has no single history")
        # What a string is: the token without the mark, the token with it (-1: none). All beginnings of tokens are there.
        self.tokens: dict[str, tuple[int, int]] = {}
        for token in vocab:
            whole = token.removesuffix(END_MARK)
            for k in range(1, len(whole) + 1):
                part = whole[:k]
                if part not in self.tokens:
                    self.tokens[part] = (vocab.get(part, -1), vocab.get(part + END_MARK, -1))
        self.letters = {ord(chr(b)): c for b, c in byte_letters().items()}
        self.right_edges: dict[int, list[tuple[int, float]]] = {}
        self.left_edges: dict[int, list[tuple[int, float]]] = {}
        self.known: dict[tuple[int, int], bool] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that stand at one end of a token while it is made, each with the rank of the merge that uses it up."""
        table = self.left_edges if side == 0 else self.right_edges
        if token not in table:
            found, until = [(token, float("inf"))], token
            while until in self.parts:
                rank, until = self.parts[until][2], self.parts[until][side]
                found.append((until, rank))
            table[token] = found
        return table[token]

    def apart(self, left: int, right: int) -> bool:
        """Whether BPE keeps the border between two neighbouring tokens.

        It does unless some token at the right end of the left one merges with some token at the left end of the right one
        while both are there. Merges of one rank go from left to right: at equal rank the border goes before the right
        neighbour merges further, but not before the left one has.
        """
        if len(self.known) > MOST_PAIRS:
            self.known.clear()
        rank, right_edge = self.rank, self.edge(right, 0)
        found = True
        for a, a_until in self.edge(left, 1):
            for b, b_until in right_edge:
                merge = rank.get((a, b))
                if merge is not None and merge < a_until and merge <= b_until:
                    found = False
        self.known[left, right] = found
        return found

    def prefix_counts(self, pieces: list[str]) -> list[list[int]]:
        """For each piece the tokens of its prefixes of 1, 2, ... characters, each as a piece of its own."""
        found = self.counts_of(pieces)
        for k, piece in enumerate(pieces):
            if len(piece) == 3 and piece[0] == "'" and piece[1:] in CONTRACTIONS:
                # What comes before the last letter is no contraction yet.
                mark, letter = self.counts_of(["'", piece[1]])
                found[k] = [mark[0], mark[0] + letter[0], found[k][-1]]
        return found

    def counts_of(self, pieces: list[str]) -> list[list[int]]:
        """In alphabetical order, so that what a piece has in common with the one before is not worked out again."""
        words = [
            p if p.isascii() and p.isalnum() else p.encode().decode("latin-1").translate(self.letters) for p in pieces
        ]
        result: list[list[int]] = [[]] * len(words)
        tokens, known, apart = self.tokens, self.known, self.apart
        before, last, count, closed = "", [-1], [0], [0]
        for k in sorted(range(len(words)), key=words.__getitem__):
            word = words[k]
            size, same = len(word), 0
            for x, y in zip(word, before, strict=False):
                if x != y:
                    break
                same += 1
            more = size - same
            last = last[: same + 1] + [-1] * more
            count = count[: same + 1] + [0] * more
            closed = closed[: same + 1] + [0] * more
            for at in range(size):
                left, many = last[at], count[at] + 1
                if at and left < 0:
                    raise ValueError("a byte without a token")
                for end in range((at if at > same else same) + 1, size + 1):
                    pair = tokens.get(word[at:end])
                    if pair is None:
                        break
                    token, marked = pair
                    if token >= 0 and last[end] < 0:
                        fits = not at or known.get((left, token))
                        if fits or (fits is None and apart(left, token)):
                            last[end], count[end] = token, many
                    if marked >= 0 and not closed[end]:
                        fits = not at or known.get((left, marked))
                        if fits or (fits is None and apart(left, marked)):
                            closed[end] = many
            before = word
            if size == len(pieces[k]):
                result[k] = closed[1:]
            else:
                result[k] = [closed[e] for e in accumulate(len(c.encode()) for c in pieces[k])]
        return result


@cache
def merges(path: str) -> Merges:
    return Merges(path)


@cache
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already has a task on each core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def cuts_of(points: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where pieces and white space begin in plain lower-case text; edges: where texts begin and end."""
    kinds = KINDS[points]
    new = np.ones(len(points) + 1, dtype=bool)
    new[1:-1] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == NUMBER)
    new[edges] = True
    # An apostrophe that begins a run of symbols takes a short ending with it.
    padded = np.concatenate([points, np.zeros(3, points.dtype)])
    inside = np.concatenate([~new[1:], np.zeros(3, bool)])  # whether the next character goes on with the same run
    spots = np.flatnonzero((points == ord("'")) & new[:-1])
    edge = np.zeros(len(points) + 4, dtype=bool)
    edge[edges] = True
    spots = spots[~edge[spots + 1]]  # the next character belongs to the same text
    one, two = padded[spots + 1], padded[spots + 2]
    second = inside[spots + 1]
    short = np.isin(one, [ord(c) for c in CONTRACTIONS if len(c) == 1])
    long = np.zeros(len(spots), dtype=bool)
    for c in CONTRACTIONS:
        if len(c) == 2:
            long |= second & (one == ord(c[0])) & (two == ord(c[1]))
    new[spots[short | long] + 1] = False
    new[np.minimum(spots[short] + 2, len(points))] = True
    new[np.minimum(spots[long] + 3, len(points))] = True
    return np.flatnonzero(new)


class PrefixCounter:
    """Prefix counts of texts; remembers pieces it has met, up to so many bytes. One for each task."""

    def __init__(self, path: str):
        self.path, self.merges = path, merges(path)
        self.special = [t.content for t in library(path).get_added_tokens_decoder().values() if not t.normalized]
        self.special_text = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self.seen: dict[str, bytes] = {}
        self.held = 0

    def of_pieces(self, pieces: list[str]) -> list[bytes]:
        """Counts of the prefixes of each of some distinct pieces, as 32-bit numbers."""
        found = list(map(self.seen.get, pieces))
        new = [p for p, known in zip(pieces, found, strict=True) if known is None]
        if new:
            made = [array("i", counts).tobytes() for counts in self.merges.prefix_counts(new)]
            if self.held > MOST_REMEMBERED:
                self.seen, self.held = {}, 0
            for piece, counts in zip(new, made, strict=True):
                if self.held > MOST_REMEMBERED:
                    break  # one call may bring more than there is room for
                self.seen[piece] = counts
                self.held += 220 + 5 * len(piece)
            rest = iter(made)
            found = [next(rest) if known is None else known for known in found]
        return found

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        """Counts of texts of plain characters only, many at once."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
        if not len(points):
            return [np.empty(0, np.int64) for _ in texts]
        lower = LOWER[points]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        cuts = cuts_of(lower, edges)
        at_byte = np.zeros(len(lower) + 1, dtype=np.int64)
        np.cumsum(1 + (lower >= 0x80).astype(np.int64) + (lower >= 0x800), out=at_byte[1:])
        raw = lower.astype("<u4").tobytes().decode("utf-32-le").encode()
        strings = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(at_byte[cuts]), pa.py_buffer(raw))
        coded = strings.dictionary_encode()
        which = np.asarray(coded.indices).astype(np.int64)
        kinds = np.asarray(KINDS[np.minimum(lower[cuts[:-1]], PLAIN_END - 1)])
        blank = np.zeros(len(coded.dictionary), dtype=bool)
        blank[which[kinds == SPACE]] = True
        pieces = coded.dictionary.to_pylist()
        counted = iter(self.of_pieces([p for p, space in zip(pieces, blank.tolist(), strict=True) if not space]))
        tables = [bytes(4 * len(p)) if space else next(counted) for p, space in zip(pieces, blank.tolist(), strict=True)]
        starts = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        flat = np.frombuffer(b"".join(tables), np.int32)
        lengths = np.diff(cuts)
        whole = flat[starts[which + 1] - 1].astype(np.int64)
        before = np.cumsum(whole) - whole
        inside = np.arange(len(lower)) - np.repeat(cuts[:-1], lengths)
        counts = np.repeat(before, lengths) + flat[np.repeat(starts[which], lengths) + inside]
        # Counts run on over the texts: each begins again at 0.
        full = np.concatenate([[0], np.cumsum(whole)])[np.searchsorted(cuts, edges)]
        return [counts[a:b] - base for a, b, base in zip(edges[:-1], edges[1:], full[:-1], strict=True)]

    def other(self, text: str) -> np.ndarray:
        """Counts of a text with any characters but no special token; -1 where a prefix is no cut."""
        heads = [
            k for k, c in enumerate(text)
            if not k or not (unicodedata.category(c)[0] == "M" or 0x1100 <= ord(c) < 0x1200 or 0xA960 <= ord(c) < 0xA980 or 0xD7B0 <= ord(c) < 0xD800)
        ]
        tool, known = library(self.path), {}
        normal, ends, length = [], [], 0
        for a, b in zip(heads, [*heads[1:], len(text)], strict=True):
            cluster = text[a:b]
            if cluster not in known:
                known[cluster] = tool.normalizer.normalize_str(cluster)
            normal.append(known[cluster])
            length += len(known[cluster])
            ends.append(length)
        joined = "".join(normal)
        counts = np.zeros(length + 1, dtype=np.int64)
        total, at = 0, 0
        spans = [span for _, span in tool.pre_tokenizer.pre_tokenize_str(joined)]
        distinct = list({joined[a:b] for a, b in spans})
        tables = dict(zip(distinct, self.of_pieces(distinct), strict=True))
        for a, b in spans:
            counts[at + 1 : a + 1] = total
            found = np.frombuffer(tables[joined[a:b]], np.int32)
            counts[a + 1 : b + 1] = found + total
            total += int(found[-1])
            at = b
        counts[at + 1 :] = total
        result = np.full(len(text), -1, dtype=np.int64)
        result[np.array([*heads[1:], len(text)]) - 1] = counts[np.array(ends)]
        return result

    def with_special(self, text: str) -> np.ndarray:
        """Counts of a text in which special tokens may stand: each is one token when it is complete, and text until then."""
        found, base, at = [], 0, 0
        for match in self.special_text.finditer(text):
            part = self.single(text[at : match.end() - 1])
            whole = part[match.start() - at - 1] if match.start() > at else 0
            if whole < 0:  # no cut before the token as text, but the token itself is one
                whole = self.single(text[at : match.start()])[-1]
            found += [np.where(part < 0, -1, part + base), np.array([base + whole + 1])]
            base, at = base + int(whole) + 1, match.end()
        if at < len(text):
            part = self.single(text[at:])
            found.append(np.where(part < 0, -1, part + base))
        return np.concatenate(found)

    def single(self, text: str) -> np.ndarray:
        return self.other(text) if NOT_PLAIN.search(text) else self.plain([text])[0]

    def counts(self, texts: list[str]) -> list[np.ndarray]:
        special = {k for k, t in enumerate(texts) if any(s in t for s in self.special)}
        odd = {k for k, t in enumerate(texts) if k not in special and NOT_PLAIN.search(t)}
        rest = [k for k in range(len(texts)) if k not in special and k not in odd]
        found: list[np.ndarray] = [np.empty(0, np.int64)] * len(texts)
        for k, counts in zip(rest, self.plain([texts[k] for k in rest]), strict=True):
            found[k] = counts
        for k in special:
            found[k] = self.with_special(texts[k])
        for k in odd:
            found[k] = self.other(texts[k])
        return found


def pack(counts: np.ndarray) -> bytes:
    """The stored form of the counts of one text (-1: no cut)."""
    cut = counts >= 0
    real = counts[cut]
    steps = np.diff(real, prepend=0)
    most = int(np.abs(steps).max()) if len(steps) else 0
    width = 1 if most < 1 << 7 else 2 if most < 1 << 15 else 4
    kind = f"<i{width}"
    out = np.full(len(counts), np.iinfo(kind).min, dtype=kind)
    out[cut] = steps
    return bytes([width]) + out.tobytes()


def unpack(stored: bytes | memoryview) -> np.ndarray:
    """Counts of the prefixes of 1, 2, ... code points; -1 for a prefix that is no cut."""
    kind = f"<i{stored[0]}"
    steps = np.frombuffer(stored, kind, offset=1)
    cut = steps != np.iinfo(kind).min
    counts = np.cumsum(np.where(cut, steps, 0), dtype=np.int64)
    return np.where(cut, counts, -1)


def with_prefix_counts(docs: DataFrame, path: str, text: str = "text", counts: str = "prefix_counts") -> DataFrame:
    """docs with the token count of every prefix of each text (binary, see the layout above).

    path names a vocabulary that every executor has. NULL counts as the empty text, which has no prefixes but itself.
    """

    def make() -> Callable[[pa.Array], list]:
        counter = PrefixCounter(path)

        def work(texts: pa.Array) -> list:
            return [pa.array([pack(c) for c in counter.counts(texts.fill_null("").to_pylist())], type=pa.binary())]

        return work

    return with_text_columns(docs, text, StructType([StructField(counts, BinaryType())]), make, SLICE_BYTES)


def answers(stored: list[bytes | None], budget: int) -> tuple[list[int], list[int]]:
    """From stored counts (None: the empty text): the tokens of each whole text, and the length, in code points, of its
    longest prefix of at most so many tokens."""
    whole, fitting = [], []
    for value in stored:
        found = np.empty(0, np.int64) if value is None else unpack(value)
        within = np.flatnonzero((found >= 0) & (found <= budget))
        whole.append(int(found[-1]) if len(found) else 0)
        fitting.append(int(within[-1]) + 1 if len(within) else 0)
    return whole, fitting


def answer_fields(tokens: str, length: str) -> StructType:
    return StructType([StructField(tokens, LongType()), StructField(length, IntegerType())])


def with_budget(docs: DataFrame, budget: int, counts: str = "prefix_counts", tokens: str = "n_tokens", length: str = "fits") -> DataFrame:
    """docs with the tokens of each whole text and the length, in code points, of its longest prefix of at most so many
    tokens, both read from the stored counts. NULL counts are those of the empty text."""

    def make() -> Callable[[pa.Array], list]:
        def work(stored: pa.Array) -> list:
            whole, fitting = answers(stored.to_pylist(), budget)
            return [pa.array(whole, pa.int64()), pa.array(fitting, pa.int32())]

        return work

    return with_text_columns(docs, counts, answer_fields(tokens, length), make)


def with_counts_and_budget(docs: DataFrame, path: str, budget: int, text: str, tokens: str, length: str) -> DataFrame:
    """with_prefix_counts and with_budget in one pass: the counts are made, asked and left in the task."""

    def make() -> Callable[[pa.Array], list]:
        counter = PrefixCounter(path)

        def work(texts: pa.Array) -> list:
            stored = [pack(c) for c in counter.counts(texts.fill_null("").to_pylist())]
            whole, fitting = answers(stored, budget)
            return [pa.array(whole, pa.int64()), pa.array(fitting, pa.int32())]

        return work

    return with_text_columns(docs, text, answer_fields(tokens, length), make, SLICE_BYTES)


def count_at(stored: bytes, length: int) -> int | None:
    """Tokens of the prefix of so many code points (all of a shorter text); None where no cut is."""
    if length <= 0:
        return 0
    found = unpack(stored)
    at = min(length, len(found))
    return 0 if not at else None if found[at - 1] < 0 else int(found[at - 1])


def truncated(docs: DataFrame, path: str, budget: int, text: str = "text") -> DataFrame:
    """docs with each text cut to its longest prefix of at most so many tokens; NULL stays NULL."""
    tokens, length = fresh("tokens"), fresh("length")
    counted = with_counts_and_budget(docs, path, budget, text, tokens, length)
    cut = F.when(F.col(text).isNotNull(), F.substring(F.col(text), F.lit(1), F.col(length)))
    return counted.withColumn(text, cut).select(*docs.columns)


def document_counts(
    docs: DataFrame, path: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, and fits (code points of the longest prefix within the limit) of every row.

    Special tokens in a text are found as the library finds them. NULL texts are empty, and an empty text has no token. Rows
    with equal ids or texts are counted each; an empty table gives an empty result. Other columns are not read.
    """
    plain = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
        F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes"),
    )
    return with_counts_and_budget(plain, path, limit, "text", "n_tokens", "fits").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fits"
    )
