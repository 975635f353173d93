"""Runs of words that repeat with a period, found by minimizers on several scales.

Words get numbers, and so do all stretches of 1, 2, 4, ... words: equal stretches have equal numbers (a stretch is named by
the pair of its halves, so names are exact and no hash is trusted).

A scale of w words finds periods above w / 2 up to w. Its keys are the names of stretches of w words, in an order by hash; in
each window of w / 2 starts the least key is kept (the leftmost of equal ones). In a run of period q and at least four
periods, the windows at i and i + q hold the same keys, so the kept start m comes with m + q; and since a stretch of w >= q
words recurs in the run at multiples of q only, m and m + q follow one another among the kept starts of this key. So every
run is seeded by two neighbouring equal minimizers at the distance of its period, and a scale keeps only some 4 / w of all
starts. A seed is extended to both sides by the names of long stretches, then shorter ones. Periods too short for a scale
are found by comparing every word with the one at that lag.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from martloom.llm import tokens
from martloom.llm.common import arrow_map, fresh, slices, with_text_columns

LEAST_LENGTH, LEAST_PERIODS = 6, 4
SHORT_PERIODS = 4  # found by direct lags; the first scale has twice as many words
RUNS = ArrayType(
    StructType([StructField(n, LongType(), False) for n in ("start", "length", "period")]), containsNull=False
)


def numbered(keys: np.ndarray) -> np.ndarray:
    """Equal keys get equal numbers from 0 on."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int32)


def word_numbers(words: tokens.Words) -> np.ndarray:
    """Equal words get equal numbers, by their bytes."""
    if not len(words.start):
        return np.empty(0, np.int32)
    # Words and what stands between them, as one Arrow array over the same bytes.
    edges = np.empty(2 * len(words.start) + 1, dtype=np.int64)
    edges[0:-1:2], edges[1::2] = words.start, words.end
    edges[-1] = words.end[-1]
    spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(words.data))])
    return np.asarray(spans.dictionary_encode().indices)[0::2].astype(np.int32)


class Names:
    """Names of the stretches of 1, 2, 4, ... words of some texts; a stretch never reaches over the end of its text."""

    def __init__(self, words: np.ndarray, ends: np.ndarray):
        """words: numbers of all words; ends: for each word the index after the last word of its text."""
        self.ends = ends
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # starts, ascending, and names
        self.add(np.arange(len(words), dtype=np.int64), words)

    def add(self, starts: np.ndarray, names: np.ndarray) -> None:
        table = np.full(len(self.ends) + 1, -1, dtype=np.int32)
        table[starts] = names
        self.levels.append((starts, table))

    def level(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all stretches of 2**k words, ascending, and a table of their names by start (-1: none)."""
        while len(self.levels) <= k:
            half = 1 << (len(self.levels) - 1)
            starts, table = self.levels[-1]
            starts = starts[starts + 2 * half <= self.ends[starts]]
            left, right = table[starts].astype(np.int64), table[starts + half].astype(np.int64)
            self.add(starts, numbered(left << 32 | right))
        return self.levels[k]


def minimizers(starts: np.ndarray, keys: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """Which of the starts hold the least key of some window of so many neighbouring starts of one text, the leftmost of
    equal ones."""
    size = len(starts)
    if size < window:
        return np.empty(0, np.int64)
    # Least (key, place) of windows that double in size; the last step overlaps.
    place = np.arange(size)
    span = 1
    while span < window:
        step = min(span, window - span)
        other = place[step:]
        left = place[: len(other)]
        place = np.where(keys[other] < keys[left], other, left)
        span += step
    same = ends[starts[: len(place)]] == ends[starts[window - 1 : window - 1 + len(place)]]
    return np.unique(place[same])


def common_stretch(names: Names, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
    """How far the words from a and from b on (forward) or before a and before b (backward) are equal, within a text."""
    found = np.zeros(len(a), dtype=np.int64)
    top = len(names.levels) - 1
    for k in range(top, -1, -1):
        size, table = 1 << k, names.levels[k][1]
        going = np.arange(len(a))
        while len(going):
            if forward:
                x, y = a[going] + found[going], b[going] + found[going]
            else:
                x, y = a[going] - found[going] - size, b[going] - found[going] - size
            inside = (x >= 0) & (y < len(names.ends))
            going, x, y = going[inside], x[inside], y[inside]
            # A name stands for a stretch of one text; it must be the text of the pair.
            outer = y if forward else x
            same = (table[x] == table[y]) & (table[x] >= 0) & (names.ends[outer] == names.ends[a[going]])
            going = going[same]
            found[going] += size
            if k < top:
                break  # of a shorter stretch there is at most one more
    return found


def find_runs(words: np.ndarray, first: np.ndarray, counts: np.ndarray, periods: int, length: int) -> np.ndarray:
    """Rows (start, length, period) of all runs of some texts, by start and period; starts count over all texts.

    words: numbers of all words, text after text; first, counts: of each text's words. A run has its least period, at least
    ``length`` words and at least ``periods`` (4 or more) periods, and no neighbouring word goes on with it.
    """
    ends = np.repeat(first + counts, counts)
    found = []
    size = len(words)
    for lag in range(1, min(SHORT_PERIODS, int(counts.max(initial=0)) // periods) + 1):
        equal = np.zeros(size + 1, dtype=bool)
        equal[: size - lag] = (words[lag:] == words[:-lag]) & (ends[lag:] == ends[:-lag])
        begins = np.flatnonzero(equal[:-1] & ~np.concatenate([[False], equal[:-2]]))
        stops = np.flatnonzero(equal[:-1] & ~equal[1:]) + 1
        # Equal neighbours of two texts must not run together: the last words of a text are equal to nothing at the lag.
        found.append(np.stack([begins, stops - begins + lag, np.full(len(begins), lag)], axis=1))
    longest = int(counts.max(initial=0))
    names = Names(words, ends)
    # All levels first: a run of a short period may be long, and is measured by long stretches.
    names.level(max(longest // periods, 1).bit_length())
    scale = 2 * SHORT_PERIODS
    while longest // periods > scale // 2:
        k = scale.bit_length() - 1
        starts, table = names.level(k)
        keys = table[starts]
        long_enough = np.repeat(counts, counts)[starts] >= periods * (scale // 2 + 1)
        starts, keys = starts[long_enough], keys[long_enough]
        kept = minimizers(starts, tokens.mixed(keys.astype(np.uint64)), ends, scale // 2)
        at, key = starts[kept], keys[kept]
        order = np.lexsort((at, key, ends[at]))
        at, key = at[order], key[order]
        gap = np.diff(at)
        pair = np.flatnonzero((key[1:] == key[:-1]) & (ends[at[1:]] == ends[at[:-1]]) & (gap > scale // 2) & (gap <= scale))
        if len(pair):
            a, lag = at[pair], gap[pair]
            b = a + lag
            after, before = common_stretch(names, a, b, True), common_stretch(names, a, b, False)
            found.append(np.stack([a - before, before + after + lag, lag], axis=1))
        scale *= 2
    if not found:
        return np.empty((0, 3), np.int64)
    rows = np.concatenate(found)
    rows = np.unique(rows[rows[:, 1] >= np.maximum(length, periods * rows[:, 2])], axis=0)
    if not len(rows):
        return rows.reshape(0, 3)
    # A multiple of a run's period gives the same stretch again: the least one stays.
    order = np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))
    rows = rows[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


@dataclass
class Spans:
    """Pieces of bytes to be joined by single spaces, text by text."""

    data: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    texts: int

    def joined(self) -> pa.Array:
        count = np.bincount(self.doc, minlength=self.texts)
        sizes = self.end - self.start
        bytes_of = np.bincount(self.doc, weights=sizes, minlength=self.texts).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(bytes_of + np.maximum(count - 1, 0))])
        out = np.full(int(offsets[-1]), 0x20, dtype=np.uint8)
        if len(sizes):
            first = np.cumsum(count) - count
            before = np.cumsum(sizes) - sizes
            nth = np.arange(len(sizes)) - first[self.doc]
            to = offsets[self.doc] + before - before[first[self.doc]] + nth
            inside = np.arange(int(sizes.sum())) - np.repeat(before, sizes)
            out[np.repeat(to, sizes) + inside] = self.data[np.repeat(self.start, sizes) + inside]
        large = pa.LargeStringArray.from_buffers(self.texts, pa.py_buffer(offsets), pa.py_buffer(out))
        return large.cast(pa.string())


def runs_of_texts(texts: pa.Array, periods: int, length: int) -> list[pa.Array]:
    """For each text its number of words, its runs, and its words without those that a run repeats."""
    words = tokens.find_words(texts, tokens.NOT_SPACE)
    counts, first = words.counts(), words.firsts()
    rows = find_runs(word_numbers(words), first, counts, periods, length)
    doc = words.doc[rows[:, 0]] if len(rows) else np.empty(0, np.int64)
    change = np.zeros(len(words.start) + 1, dtype=np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 0] + rows[:, 1], -1)
    stay = np.cumsum(change)[:-1] == 0
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=words.texts))]).astype(np.int32)
    fields = [pa.array(x) for x in (rows[:, 0] - first[doc], rows[:, 1], rows[:, 2])]
    structs = pa.StructArray.from_arrays(fields, fields=[pa.field(f.name, pa.int64(), False) for f in RUNS.elementType])
    listed = pa.ListArray.from_arrays(pa.array(offsets), structs, type=pa.list_(pa.field("element", structs.type, False)))
    collapsed = Spans(words.data, words.doc[stay], words.start[stay], words.end[stay], words.texts).joined()
    return [pa.array(counts.astype(np.int64)), listed, collapsed]


def with_runs(
    docs: DataFrame, text: str = "text", periods: int = LEAST_PERIODS, length: int = LEAST_LENGTH,
    n_words: str = "n_words", runs: str = "runs", collapsed: str = "collapsed",
) -> DataFrame:
    """docs with the number of words of each text, its runs (start, length, period, in words from 0; by start and period), and
    the text without what runs repeat: the words that no run contains after its first period, joined by one space.

    A run is a stretch with a least period (words that far apart are identical), at least ``periods`` periods and
    ``length`` words, that no neighbouring word continues. NULL counts as empty: no words, no runs, an empty text.
    """
    if periods < LEAST_PERIODS:
        raise ValueError("the scales need four periods or more")

    def make() -> Callable[[pa.Array], list]:
        return lambda texts: runs_of_texts(texts, periods, length)

    added = [StructField(n_words, LongType()), StructField(runs, RUNS), StructField(collapsed, StringType())]
    return with_text_columns(docs, text, StructType(added), make)


def repeated_in_part(texts: pa.Array, hashes: np.ndarray) -> pa.Array:
    """Texts of which every tenth (by its hash) has its later words replaced by a repetition: from word a on, word i is word
    a + (i - a) % p, with a = g % n and p = 1 + (n - a) // (3 + g % 8) for g = hash // 10 and n words."""
    words = tokens.find_words(texts, tokens.NOT_SPACE)
    counts, first = words.counts(), words.firsts()
    chosen = np.flatnonzero((hashes % 10 == 0) & (counts > 0))
    if not len(chosen):
        return texts
    g, n = hashes[chosen] // 10, counts[chosen]
    begin = g % n
    period = 1 + (n - begin) // (3 + g % 8)
    which = np.repeat(np.arange(len(chosen)), n)
    at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    a, p = begin[which], period[which]
    at = np.where(at >= a, a + (at - a) % p, at) + first[chosen][which]
    made = Spans(words.data, which, words.start[at], words.end[at], len(chosen)).joined()
    take = np.arange(len(texts))
    take[chosen] = len(texts) + np.arange(len(chosen))
    return pa.concat_arrays([texts.cast(pa.string()), made]).take(pa.array(take))


def partly_repeated(docs: DataFrame, doc_id: str, text: str, out: str) -> DataFrame:
    """docs with a column of texts of which every tenth goes over into a repetition (a NULL id hashes as empty text)."""

    hashed = fresh("hash")
    names = [*docs.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                hashes = np.asarray(part.column(hashed)).astype(np.int64)
                made = repeated_in_part(part.column(text).fill_null(""), hashes)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], made], names=names)

    code = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    return arrow_map(docs.withColumn(hashed, code), run, StructType([*docs.schema.fields, StructField(out, StringType())]))


def run_digests(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: bool = True
) -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli; of equal ones the first, then the shortest
    period; NULL without a run) and digests of all runs and of the collapsed text, for every row.

    With ``plant``, every tenth text (by its id) goes over into a repetition first, so that there is something to find. NULL
    and empty texts have no run and an empty collapsed text; equal ids and repeated rows are rows of their own; an empty
    table gives an empty result. Other columns are not read.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if plant:
        plain = partly_repeated(plain, "doc_id", "text", "made").select("doc_id", F.col("made").alias("text"))
    found = with_runs(plain, "text").drop("text")
    best = F.expr(
        "array_max(transform(runs, r -> struct(r.length AS length, -r.start AS back, -r.period AS less)))"
    )
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, chr(10))), '')")

    def digest(column: Column) -> Column:
        return F.sha2(column.cast("binary"), 256)

    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed").select(
        "doc_id", "n_runs", (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.less")).alias("period"),
        F.expr("(1000 * best.length) DIV (-best.less)").alias("exponent_milli"),
        digest(F.col("lines")).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"),
    )
