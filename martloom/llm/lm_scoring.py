"""Cross-entropy difference (Moore and Lewis, 2010): how much likelier a target model finds a document than a background one.

Both are bigram models over one vocabulary, all words of all documents, and both are smoothed alike. All documents are
counted for the background, and all target documents for the target; background counts are brought to the target's total,
so that the models are matched but for what they have read. No word or pair is left out, so the counts grow with the corpus
and are never in one place:

1. A chunk of the corpus is a class of hashes of ids, some megabytes of text. Its texts and the target ids of its class meet
   in one task, which counts the chunk's distinct pairs, words and contexts (words as the first of a pair), in target texts
   and in all texts. These are hashed keys, sorted within each kind.
2. They go to buckets, a kind and a range of its keys each, packed. A bucket sums its keys over all chunks. A key has at
   most one entry for each chunk, so the commonest word of all is no load on a task.
3. The sums go back to the chunks without their keys, in the order in which the keys came.
4. A chunk's texts, read from the shuffle of step 1 again, meet these sums in one task, which works out the losses of every
   token. Keys depend on the texts alone, so a repeated task finds them in the same order.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm import tokens
from martloom.llm.common import arrow_map, ship, slices

# Bytes of text for each chunk, and for each bucket of a kind of keys.
CHUNK_BYTES = BUCKET_BYTES = 8 << 20
# Strength of the unigram model behind each bigram, in tokens.
PRIOR = 50.0
# The word before the first one of a text.
BEGIN = tokens.nth(1000)
PACKED = "bucket long, chunk long, keys binary, target binary, background binary"
PACKED_SCHEMA = pa.schema([
    ("bucket", pa.int64()), ("chunk", pa.int64()), *[(name, pa.binary()) for name in ("keys", "target", "background")],
])
RESULT = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"
RESULT_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_tokens", pa.int64()),
    *[(name, pa.float64()) for name in ("target_loss", "background_loss", "score")],
])


def text_words(texts: pa.Array) -> tokens.Words:
    """Words of the texts in lower case: runs of digits, letters and characters beyond ASCII."""
    return tokens.find_words(pc.utf8_lower(texts.fill_null("")), tokens.IS_NAME)


def gram_keys(words: tokens.Words) -> np.ndarray:
    """For each token, a column with the keys of the pair that it ends, of itself, and of the context before it."""
    now = words.hashes()
    before = np.full(len(now), BEGIN)
    before[1:] = np.where(words.doc[1:] == words.doc[:-1], now[:-1], BEGIN)
    return np.stack([tokens.mixed(tokens.mixed(before + tokens.nth(1)) + now), now, tokens.mixed(before + tokens.nth(2))])


class Chunk:
    """The words of a chunk's texts, slice by slice, and its distinct keys of each kind."""

    def __init__(self, texts: pa.Table):
        self.parts = [part for batch in texts.combine_chunks().to_batches() for part in slices(batch, "text")]
        self.words = [text_words(part.column("text")) for part in self.parts]
        found = [gram_keys(words) for words in self.words]
        # For each kind: sorted distinct keys, and the place among them of each token's key.
        self.kinds = [np.unique(np.concatenate(rows), return_inverse=True) for rows in zip(*found, strict=True)]

    def spans(self, buckets: int) -> Iterator[tuple[int, int, int, int]]:
        """(bucket, kind, begin, end): the keys of a kind that belong to a bucket."""
        for kind, (keys, _) in enumerate(self.kinds):
            place = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            present, starts = np.unique(place, return_index=True)
            for bucket, (a, b) in zip(present.tolist(), itertools.pairwise([*starts.tolist(), len(keys)]), strict=True):
                yield kind * buckets + bucket, kind, a, b


def packed(values: np.ndarray) -> bytes:
    """Unsigned 64-bit values by byte plane, compressed: leading bytes, alike in sorted keys and small counts, shrink."""
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


def chunk_of(doc_id: Column, chunks: int, otherwise: Column | None = None) -> Column:
    """The chunk of an id; rows without an id, which are never targets, go by another column."""
    return F.pmod(F.xxhash64(doc_id if otherwise is None else F.coalesce(doc_id, F.xxhash64(otherwise))), F.lit(chunks))


def totals(plain: DataFrame, chosen: DataFrame) -> tuple[int, int, int]:
    """Tokens of target texts, tokens of all texts, and distinct words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = text_words(part.column("text"))
                seen, n = np.unique(words.hashes()).view(np.int64), words.counts().astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([True, False], [len(n), len(seen)])),
                     pa.concat_arrays([part.column("doc_id"), pa.array(seen)]), pa.array(np.append(n, np.zeros_like(seen)))],
                    names=["is_doc", "value", "n"],
                )

    rows = arrow_map(plain, run, "is_doc boolean, value long, n long").groupBy("is_doc", "value").agg(F.sum("n").alias("n"))
    wanted = chosen.select(F.lit(True).alias("is_doc"), F.col("target_id").alias("value"), F.lit(True).alias("target"))
    sums = rows.join(wanted, ["is_doc", "value"], "left").agg(
        F.sum(F.when(F.col("target"), F.col("n"))), F.sum("n"), F.count(F.when(~F.col("is_doc"), 1))
    )
    return tuple(x or 0 for x in sums.first())


def gram_sums(texts: DataFrame, targets: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, target, background): the sums over the corpus of the chunk's keys in the bucket, in their order."""

    def deal(texts: pa.Table, targets: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return PACKED_SCHEMA.empty_table()
        chunk, ids = Chunk(texts), targets.column("target_id").combine_chunks()
        is_target = [np.asarray(pc.is_in(part.column("doc_id"), value_set=ids, skip_nulls=True)) for part in chunk.parts]
        chosen = np.concatenate([flags[words.doc] for flags, words in zip(is_target, chunk.words, strict=True)])
        counts = [
            (np.bincount(at[chosen], minlength=len(keys)), np.bincount(at, minlength=len(keys))) for keys, at in chunk.kinds
        ]
        number = texts.column("chunk")[0].as_py()
        rows = [
            (bucket, number, *[packed(x[a:b]) for x in (chunk.kinds[kind][0], *counts[kind])])
            for bucket, kind, a, b in chunk.spans(buckets)
        ]
        return pa.Table.from_pylist([dict(zip(PACKED_SCHEMA.names, row, strict=True)) for row in rows], PACKED_SCHEMA)

    def total(rows: pa.Table) -> pa.Table:
        each = [unpacked(blob) for blob in rows.column("keys").to_pylist()]
        ends = np.cumsum([len(keys) for keys in each])
        found, group = np.unique(np.concatenate(each), return_inverse=True)
        columns = []
        for name in ("target", "background"):
            counts = np.concatenate([unpacked(blob) for blob in rows.column(name).to_pylist()]).astype(np.int64)
            sums = np.zeros(len(found), np.int64)
            np.add.at(sums, group, counts)
            columns.append(pa.array([packed(x) for x in np.split(sums[group], ends[:-1])], pa.binary()))
        return pa.table([rows.column("bucket"), rows.column("chunk"), *columns], names=["bucket", "chunk", "target", "background"])

    dealt = texts.groupBy("chunk").cogroup(targets.groupBy("chunk")).applyInArrow(deal, PACKED)
    return dealt.groupBy("bucket").applyInArrow(total, "bucket long, chunk long, target binary, background binary")


def losses(pair: np.ndarray, word: np.ndarray, context: np.ndarray, scale: float, total: float) -> np.ndarray:
    """-ln P(token | token before) from counts times a scale: unigrams with one added, bigrams over them."""
    single = (word * scale + 1) / total
    return -np.log((pair * scale + PRIOR * single) / (context * scale + PRIOR))


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss and score for every document.

    The losses are means over the tokens of the whole text, in nats; score is target_loss - background_loss, so low scores
    are close to the target. A text without tokens (NULL, empty) has 0 in all of them. target_ids has a column doc_id and
    may name ids more than once, or ids without a document; with no target at all both models are flat alike. Rows that
    repeat an id are documents of their own. An empty table gives an empty result; other columns of docs are not read.
    """
    ship(docs.sparkSession)
    chosen = target_ids.select(F.col("doc_id").cast("long").alias("target_id")).where("target_id IS NOT NULL").distinct()
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, buckets = (max(1, -(-size // most)) for most in (CHUNK_BYTES, BUCKET_BYTES))
    of_target, of_all, vocabulary = totals(plain, chosen)
    scale, total = (of_target / of_all if of_all else 1.0), float(of_target + vocabulary)

    def score(texts: pa.Table, sums: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return RESULT_SCHEMA.empty_table()
        chunk = Chunk(texts)
        of_bucket = {row["bucket"]: row for row in sums.to_pylist()}
        counts = [np.zeros((2, len(keys))) for keys, _ in chunk.kinds]
        for bucket, kind, a, b in chunk.spans(buckets):
            counts[kind][:, a:b] = [unpacked(of_bucket[bucket][name]) for name in ("target", "background")]
        both = [
            losses(*[row[at] for row, (_, at) in zip(rows, chunk.kinds, strict=True)], by, total)
            for rows, by in zip(zip(*counts, strict=True), (1.0, scale), strict=True)
        ]
        found, first = [], 0
        for part, words in zip(chunk.parts, chunk.words, strict=True):
            n, last = words.counts(), first + len(words.doc)
            means = [np.bincount(words.doc, weights=x[first:last], minlength=len(n)) / np.maximum(n, 1) for x in both]
            found.append(pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n.astype(np.int64)), *map(pa.array, means), pa.array(means[0] - means[1])],
                schema=RESULT_SCHEMA,
            ))
            first = last
        return pa.Table.from_batches(found, RESULT_SCHEMA)

    # Counted and scored from the same columns, so that Spark shuffles the texts once.
    texts = plain.withColumn("chunk", chunk_of(F.col("doc_id"), chunks, F.col("text")))
    sums = gram_sums(texts, chosen.withColumn("chunk", chunk_of(F.col("target_id"), chunks)), buckets)
    return texts.groupBy("chunk").cogroup(sums.groupBy("chunk")).applyInArrow(score, RESULT)
