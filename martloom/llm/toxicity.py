"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the hashed buckets of its words, of the stems of longer words, of pairs of neighbours and of pairs
with one or two words between them, each bucket once. Stems (the first bytes of a word) let one inflected form speak for
the others. Training is the per-coordinate method of McMahan et al. (2013): every coordinate has its own
learning rate, and L1 keeps most weights at exactly zero. What is left is small and goes to the tasks that score.

The model is fitted on a bounded sample of labelled rows (``most_rows``), drawn by the hash of the id; scoring reads every
text as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from martloom.llm import tokens
from martloom.llm.common import arrow_map, fold_of, slices, with_text_columns

BITS = 22
SKIPS = (1, 2, 3)
STEMS = (4, 6)
MOST_ROWS = 16_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 0.1
FOLDS, HELD_OUT = 5, 0


def features(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every feature, in no order and with repeats."""
    words = tokens.find_words(pc.utf8_lower(strings.fill_null("")), tokens.IS_NAME)
    hashes, doc = words.hashes(), words.doc
    docs, found = [doc], [hashes]
    for size in STEMS:
        longer = np.flatnonzero(words.end - words.start > size)
        docs.append(doc[longer])
        start = words.start[longer]
        found.append(tokens.mixed(tokens.span_hashes(words.data, start, start + size) + tokens.nth(100 + size)))
    for skip in SKIPS:
        pair = np.flatnonzero(doc[:-skip] == doc[skip:]) if len(doc) > skip else np.empty(0, np.int64)
        docs.append(doc[pair])
        found.append(tokens.mixed(hashes[pair] + tokens.nth(skip) + tokens.mixed(hashes[pair + skip])))
    return np.concatenate(docs), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """State of the learner: z and n of every coordinate; the last coordinate is the intercept, without L1."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        rate = (BETA + np.sqrt(self.n[at])) / ALPHA + L2
        shrink = np.where(at == 1 << BITS, 0.0, L1)
        return np.where(np.abs(z) > shrink, (np.sign(z) * shrink - z) / rate, 0.0)

    def learn(self, at: np.ndarray, label: float) -> None:
        weights = self.weights(at)
        gradient = 1 / (1 + np.exp(-np.clip(weights.sum(), -35, 35))) - label
        more = self.n[at] + gradient * gradient
        self.z[at] += gradient - (np.sqrt(more) - np.sqrt(self.n[at])) / ALPHA * weights
        self.n[at] = more


def fit(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, most_rows: int = MOST_ROWS) -> tuple[dict[int, float], float]:
    """Nonzero weights by bucket, and the intercept, from labelled rows outside the held-out fold.

    The sample is the most_rows rows (a documented bound) with the least hash of their id. It is learned in one task, in
    the order of these hashes. Rows without a label or text of their own are passed over; of several labels the greatest
    counts. Without any labelled row there are no weights, and every score is 0.5.
    """
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id"), FOLDS) != HELD_OUT))
    drawn = usable.groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
    drawn = drawn.withColumn("draw", F.xxhash64(F.lit("toxicity"), "doc_id")).orderBy("draw", "doc_id").limit(most_rows)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # At most most_rows rows of three numbers.
    sample = texts.join(F.broadcast(drawn), "doc_id").select("draw", "doc_id", "label", "text")
    sample = sample.repartition(1).sortWithinPartitions("draw", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, seen = Ftrl(), []
        for batch in batches:
            for part in slices(batch, "text"):
                docs_at, buckets = features(part.column("text"))
                order = np.lexsort((buckets, docs_at))
                docs_at, buckets = docs_at[order], buckets[order]
                new = np.ones(len(docs_at), dtype=bool)
                new[1:] = (docs_at[1:] != docs_at[:-1]) | (buckets[1:] != buckets[:-1])
                docs_at, buckets = docs_at[new], buckets[new].astype(np.int32)
                cuts = np.searchsorted(docs_at, np.arange(part.num_rows + 1))
                for k, target in enumerate(part.column("label").to_pylist()):
                    seen.append((np.append(buckets[cuts[k] : cuts[k + 1]], np.int32(1 << BITS)), target))
        for _ in range(EPOCHS):
            for at, target in seen:
                learner.learn(at, target)
        weights = learner.weights(np.arange((1 << BITS) + 1))
        kept = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(weights[kept])], names=["bucket", "weight"])

    found = {r["bucket"]: r["weight"] for r in arrow_map(sample, run, "bucket long, weight double").collect()}
    return {k: v for k, v in found.items() if k < 1 << BITS}, found.get(1 << BITS, 0.0)


def with_score(docs: DataFrame, text: str, model: tuple[dict[int, float], float], score: str) -> DataFrame:
    """docs with a score from 0 to 1 for each whole text; an empty or NULL text has the intercept's."""
    buckets = np.array(sorted(model[0]), dtype=np.int64)
    values = np.array([model[0][k] for k in buckets.tolist()])
    intercept = model[1]

    def make() -> Callable[[pa.Array], list]:
        dense = np.zeros(1 << BITS, dtype=np.float32)
        dense[buckets] = values

        def work(texts: pa.Array) -> list:
            docs_at, at = features(texts)
            hit = np.flatnonzero(dense[at])
            pairs = np.unique(docs_at[hit] << BITS | at[hit])
            sums = np.bincount(pairs >> BITS, weights=dense[pairs & ((1 << BITS) - 1)], minlength=len(texts))
            return [pa.array(1 / (1 + np.exp(-np.clip(sums + intercept, -35, 35))))]

        return work

    return with_text_columns(docs, text, StructType([StructField(score, DoubleType())]), make)


def scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted for every document; NULL and empty texts are scored like any other."""
    model = fit(docs, labels, doc_id, text, label)
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return with_score(plain, "text", model, "score").select(
        "doc_id", (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
