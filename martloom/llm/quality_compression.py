"""Quality by compression: two zstandard dictionaries, from good and from bad labelled text.

A text is compressed in blocks of a fixed length, once with each dictionary. The difference of the compressed sizes over
their sum tells which kind of text it is closer to; blocks keep a long text from teaching the compressor about itself.
A logistic curve, fitted on labelled rows that gave no block to a dictionary, turns the difference into a probability.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from martloom.llm.common import arrow_map, fold_of, slices, with_text_columns

BLOCK = 1024
LEVEL = 3
DICTIONARY_BYTES = 112_640
# Bounds of the sample: labelled rows of each kind that are looked at, and blocks of each kind that train a dictionary.
MOST_ROWS, MOST_BLOCKS = 6_000, 8_000
FOLDS, HELD_OUT = 3, 1


def blocks_of(text: str) -> list[bytes]:
    raw = text.encode()
    return [raw[k : k + BLOCK] for k in range(0, len(raw), BLOCK)]


class Sizes:
    """Compressed sizes of a text under both dictionaries and under none."""

    def __init__(self, good: bytes, bad: bytes):
        def press(dictionary: bytes) -> Callable[[bytes], bytes]:
            options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
            if dictionary:
                data = zstandard.ZstdCompressionDict(dictionary)
                data.precompute_compress(level=LEVEL)
                options["dict_data"] = data
            return zstandard.ZstdCompressor(**options).compress

        self.good, self.bad, self.plain = press(good), press(bad), press(b"")

    def features(self, text: str) -> tuple[float, float]:
        """The normalised difference (positive: closer to good text), and the plain size over the length."""
        parts = blocks_of(text)
        if not parts:
            return 0.0, 1.0
        good, bad = sum(len(self.good(p)) for p in parts), sum(len(self.bad(p)) for p in parts)
        return (bad - good) / (bad + good), min(1.5, sum(len(self.plain(p)) for p in parts) / sum(map(len, parts)))


def train_dictionary(blocks: list[bytes]) -> bytes:
    """A dictionary from sample blocks; too few of them are used as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:]


def basis(features: np.ndarray) -> np.ndarray:
    """Columns of the calibration curve: intercept, difference, plain ratio, and the two together."""
    difference, ratio = features[:, 0] * 10, features[:, 1]
    return np.stack([np.ones(len(features)), difference, ratio, difference * np.abs(difference), ratio * ratio, difference * ratio], axis=1)


def calibrate(features: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, ridge: float = 1e-3) -> np.ndarray:
    """Coefficients of a logistic regression by Newton's method; without both kinds of label, of a constant.

    Weights count relative to each other: their mean is taken as 1.
    """
    x = basis(features) if len(features) else np.empty((0, 6))
    beta = np.zeros(6)
    if not len(labels) or labels.min() == labels.max():
        beta[0] = 0.0 if not len(labels) else (4.0 if labels[0] else -4.0)
        return beta
    w = np.ones(len(labels)) if weights is None else weights / weights.mean()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(6), x.T @ (w * (labels - p)) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, most_rows: int) -> DataFrame:
    """draw, label, weight, use (train or calibrate) and text of a bounded number of labelled rows outside the held-out fold.

    A row's weight is the number of usable labels of its kind over those that were drawn: 1 where the bound cuts nothing.
    """
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id"), FOLDS) != HELD_OUT))
    one = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    one = one.withColumn("draw", F.xxhash64(F.lit("quality"), "doc_id"))
    counts = {r["label"]: r["count"] for r in one.where("label IN (0, 1)").groupBy("label").count().collect()}
    drawn = None
    for kind in (0, 1):
        part = one.where(F.col("label") == kind).orderBy("draw", "doc_id").limit(most_rows)
        part = part.withColumn("weight", F.lit(max(1.0, counts.get(kind, 0) / most_rows)))
        drawn = part if drawn is None else drawn.unionByName(part)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # At most two times most_rows rows of four numbers.
    return texts.join(F.broadcast(drawn), "doc_id").select(
        "draw", "label", "weight", (F.pmod("draw", F.lit(2)) == 0).alias("trains"), "text"
    )


def fit(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, most_rows: int = MOST_ROWS, most_blocks: int = MOST_BLOCKS):
    """The two dictionaries and the coefficients of the curve.

    Half of the sampled rows give blocks of their whole texts, the most_blocks of each kind with the least hash; the other
    half is compressed as a whole and calibrates. The curve is weighted back to the share of labels in the table.
    """
    sample = labelled_sample(docs, labels, doc_id, text, label, most_rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for draw, kind, body in zip(*(part.column(c).to_pylist() for c in ("draw", "label", "text")), strict=True):
                    found = blocks_of(body or "")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([draw] * len(found), pa.int64()), pa.array([kind] * len(found), pa.int32()), pa.array(range(len(found)), pa.int32()), pa.array(found, pa.binary())],
                        names=["draw", "label", "nth", "block"],
                    )

    blocks = arrow_map(sample.where("trains"), cut, "draw long, label int, nth int, block binary")
    order = [F.xxhash64("draw", "nth"), F.col("draw"), F.col("nth"), F.col("block")]
    trained = []
    for kind in (1, 0):
        rows = blocks.where(F.col("label") == kind).orderBy(*order).limit(most_blocks).collect()
        trained.append(train_dictionary([bytes(r["block"]) for r in rows]))
    rest = with_features(sample.where("NOT trains"), "text", trained[0], trained[1]).drop("text").collect()
    rest.sort(key=lambda r: r["draw"])
    kinds, weights = (np.array([r[name] for r in rest], dtype=float) for name in ("label", "weight"))
    features = np.array([[r["difference"], r["ratio"]] for r in rest]).reshape(-1, 2)
    return trained[0], trained[1], calibrate(features, kinds, weights)


def with_features(docs: DataFrame, text: str, good: bytes, bad: bytes, names: tuple[str, str] = ("difference", "ratio")) -> DataFrame:
    def make() -> Callable[[pa.Array], list]:
        sizes = Sizes(good, bad)

        def work(texts: pa.Array) -> list:
            found = np.array([sizes.features(t or "") for t in texts.to_pylist()]).reshape(-1, 2)
            return [pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())]

        return work

    return with_text_columns(docs, text, StructType([StructField(n, DoubleType()) for n in names]), make)


def scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted for every document, and the two features of its whole text.

    NULL texts count as empty; an empty text has the features 0 and 1. Without labelled rows every score is 0.5.
    """
    good, bad, beta = fit(docs, labels, doc_id, text, label)
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    d, r = F.col("difference") * 10, F.col("ratio")
    terms = [F.lit(1.0), d, r, d * F.abs(d), r * r, d * r]
    logit = sum((F.lit(float(b)) * t for b, t in zip(beta, terms, strict=True)), F.lit(0.0))
    return with_features(plain, "text", good, bad).select(
        "doc_id", (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        (1 / (1 + F.exp(-logit))).alias("score"), (1 / (1 + F.exp(-logit)) >= 0.5).cast("int").alias("predicted"),
        "difference", "ratio",
    )
