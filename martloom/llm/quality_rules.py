"""Quality rules: fixed limits first, then robust multivariate outliers by language and source.

Each document becomes a vector of transformed statistics. For every language and source the minimum-covariance-determinant
estimate (Rousseeuw and van Driessen, 1999) is approached by concentration steps from a start of medians and quartiles:
the three quarters of the rows that are closest to the present centre give the next centre and covariance. Documents whose
Mahalanobis distance is beyond the cut-off are rejected.

A step is one aggregation: squared distances are put into 256 logarithmic bins, and each bin of a group holds its count,
sums and products. The subset is the nearest bins up to three quarters of the rows, so any number of rows in a group costs
256 rows after the partial sums. Sources with few documents of a language are pooled for that language.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from martloom.llm import tokens
from martloom.llm.common import ship, stored, with_text_columns

SYMBOLS = np.isin(tokens.CODES, [ord(c) for c in "#*$%&|<>"])
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 5
# Limits of the fixed rules.
LEAST_WORDS, MOST_REPEATED = 10, 20

DIMENSIONS = 5
# Least standard deviations of the transformed statistics: smaller differences are not worth a rejection, and a statistic
# that is the same in most documents of a group must not make its covariance singular.
FLOORS = (0.7, 0.25, 0.15, 0.4, 0.3)
SUBSET, STEPS, BINS = 0.75, 4, 256
LEAST_GROUP = 50
# Quantiles of the chi-squared distribution with five degrees of freedom: one in 16 million beyond, and the median.
CUTOFF, MEDIAN = 41.9, 4.351


def text_counts(texts: pa.Array) -> list[pa.Array]:
    """The five counts of each text: words are runs without ASCII white space."""
    words = tokens.find_words(texts, tokens.NOT_SPACE)
    data, offsets = words.data, words.offsets
    chars = tokens.per_text(tokens.NOT_SPACE[data] & ((data & 0xC0) != 0x80), offsets)
    symbols = tokens.per_text(SYMBOLS[data], offsets)
    # Lines: from each begin of a text or byte after a line feed to the next; those with a word are compared.
    feeds = np.flatnonzero(data == 0x0A)
    begins = np.unique(np.concatenate([offsets[:-1], feeds + 1]))
    begins = begins[begins < len(data)]
    doc = np.searchsorted(offsets, begins, side="right") - 1
    stops = np.searchsorted(feeds, begins)
    ends = np.minimum(np.append(feeds, len(data))[stops], offsets[doc + 1])
    worded = np.searchsorted(words.start, begins) < np.searchsorted(words.start, ends)
    begins, ends, doc = begins[worded], ends[worded], doc[worded]
    lines = tokens.span_hashes(data, begins, ends)
    same = np.unique(np.stack([doc.astype(np.uint64), lines]), axis=1)[0].astype(np.int64) if len(doc) else doc
    dup_lines = np.bincount(doc, minlength=words.texts) - np.bincount(same, minlength=words.texts)
    # Windows found more than once in their text; a word is counted once however many of them it is in.
    first, found = tokens.windows(words.hashes(), words.doc, WINDOW)
    repeated = np.zeros(len(words.doc), dtype=bool)
    if len(first):
        order = np.lexsort((found, words.doc[first]))
        at, key = words.doc[first][order], found[order]
        equal = (at[1:] == at[:-1]) & (key[1:] == key[:-1])
        twice = np.zeros(len(order), dtype=bool)
        twice[1:] |= equal
        twice[:-1] |= equal
        for k in range(WINDOW):
            repeated[first[order[twice]] + k] = True
    repeats = np.bincount(words.doc[repeated], minlength=words.texts)
    return [pa.array(x.astype(np.int64)) for x in (words.counts(), chars, symbols, dup_lines, repeats)]


def with_counts(docs: DataFrame, text: str) -> DataFrame:
    def make() -> Callable[[pa.Array], list]:
        return text_counts

    return with_text_columns(docs, text, StructType([StructField(c, LongType()) for c in COUNTS]), make)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def vector() -> list[Column]:
    words = F.greatest("n_words", F.lit(1))
    return [
        F.log1p("n_words"),
        F.log((F.col("word_chars") + 1) / words),
        F.log1p(20 * F.col("n_symbols") / words),
        F.log1p("n_dup_lines"),
        F.log1p(20 * F.col("n_repeat_words") / words),
    ]


X = [f"x{k}" for k in range(DIMENSIONS)]
PAIRS = [(a, b) for a in range(DIMENSIONS) for b in range(a, DIMENSIONS)]
ESTIMATE = "lang_key string, source_key string, centre array<double>, inverse array<double>, rows long, median double"


def start(vectors: DataFrame) -> DataFrame:
    """Medians, and quartile ranges as standard deviations, of values rounded to hundredths."""
    quartiles = [F.percentile(F.round(x, 2), [0.25, 0.5, 0.75]).alias(x) for x in X]
    found = vectors.groupBy("lang_key", "source_key").agg(*quartiles, F.count("*").alias("rows"))
    scale = [F.greatest((F.col(x)[2] - F.col(x)[0]) / 1.349, F.lit(f)) for x, f in zip(X, FLOORS, strict=True)]
    inverse = [
        1 / (scale[a] * scale[a]) if a == b else F.lit(0.0) for a in range(DIMENSIONS) for b in range(DIMENSIONS)
    ]
    return found.select(
        "lang_key", "source_key", F.array(*[F.col(x)[1] for x in X]).alias("centre"), F.array(*inverse).alias("inverse"),
        "rows", F.lit(MEDIAN).alias("median"),
    )


def with_distance(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """vectors with the squared Mahalanobis distance to the estimate of their group, d2."""
    both = vectors.join(estimates.select("lang_key", "source_key", "centre", "inverse", "median"), ["lang_key", "source_key"])
    off = [F.col(x) - F.col("centre")[k] for k, x in enumerate(X)]
    terms = [off[a] * off[b] * F.col("inverse")[a * DIMENSIONS + b] * (1 if a == b else 2) for a, b in PAIRS]
    d2 = terms[0]
    for term in terms[1:]:
        d2 = d2 + term
    return both.withColumn("d2", d2).drop("centre", "inverse")


def concentrate(key: tuple, bins: pd.DataFrame) -> pd.DataFrame:
    """Centre and inverse covariance of the nearest bins of a group, from their sums; at most BINS rows come in."""
    bins = bins.sort_values("bin")
    reached = bins["held"].cumsum()
    total = int(reached.iloc[-1])
    near = bins[(reached - bins["held"]) < SUBSET * total]
    held = float(near["held"].sum())
    centre = np.array([near[f"s{k}"].sum() for k in range(DIMENSIONS)]) / held
    spread = np.zeros((DIMENSIONS, DIMENSIONS))
    for a, b in PAIRS:
        spread[a, b] = spread[b, a] = near[f"p{a}{b}"].sum() / held - centre[a] * centre[b]
    # The floor is added where a statistic varies less; correlations are kept as they are.
    spread += np.diag(np.maximum(np.square(FLOORS) - np.diag(spread), 0))
    middle = bins["bin"][reached >= total / 2].iloc[0]
    median = 2.0 ** ((middle + 1) / 16) - 1
    inverse = np.linalg.inv(spread)
    return pd.DataFrame([{
        "lang_key": key[0], "source_key": key[1], "centre": np.round(centre, 9), "inverse": np.round(inverse, 9).ravel(),
        "rows": total, "median": median,
    }])


def step(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """The next estimates; median is that of the squared distances to the estimates that came in."""
    ship(vectors.sparkSession)
    binned = F.least(F.floor(16 * F.log2(1 + F.greatest("d2", F.lit(0.0)))), F.lit(BINS - 1)).cast("int")
    sums = [F.sum(x).alias(f"s{k}") for k, x in enumerate(X)]
    products = [F.sum(F.col(X[a]) * F.col(X[b])).alias(f"p{a}{b}") for a, b in PAIRS]
    held = with_distance(vectors, estimates).withColumn("bin", binned).groupBy("lang_key", "source_key", "bin")
    bins = held.agg(F.count("*").alias("held"), *sums, *products)
    return bins.groupBy("lang_key", "source_key").applyInPandas(concentrate, ESTIMATE)


def robust_estimates(vectors: DataFrame, steps: int = STEPS) -> DataFrame:
    """Centre, inverse covariance and distance scale of each group, after so many concentration steps."""
    now = stored(start(vectors), "mcd")
    for _ in range(steps):
        now = stored(step(vectors, now), "mcd")
    last = step(vectors, now).select("lang_key", "source_key", F.col("median").alias("seen"))
    return stored(now.drop("median").join(last, ["lang_key", "source_key"]).withColumnRenamed("seen", "median"), "mcd")


def verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """doc_id, the five counts, base_failed, kept and the squared distance (NULL where a fixed rule already failed).

    Documents that fail a fixed rule take no part in the estimates. NULL and empty texts have no words and fail. A NULL
    language or source is a value of its own. Groups of fewer than LEAST_GROUP documents are pooled by language; a pool
    may be smaller still, and then the floors hold. An empty table gives an empty result.
    """
    plain = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
        F.coalesce(F.concat(F.lit("="), F.col(lang).cast("string")), F.lit("")).alias("lang_key"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("source_key"),
    )
    counted = stored(with_counts(plain, "text").drop("text").withColumn("base_failed", base_failed()), "text-counts")
    passed = counted.where("NOT base_failed").select("doc_id", "lang_key", "source_key", *COUNTS, "base_failed", *[v.alias(x) for v, x in zip(vector(), X, strict=True)])
    small = passed.groupBy("lang_key", "source_key").agg(F.count("*").alias("rows")).where(F.col("rows") >= LEAST_GROUP)
    large = small.select("lang_key", "source_key", F.lit(True).alias("large"))
    pooled = passed.join(large, ["lang_key", "source_key"], "left").withColumn(
        "source_key", F.when(F.col("large"), F.col("source_key")).otherwise("*")
    )
    vectors = stored(pooled.drop("large"), "text-vectors")
    judged = with_distance(vectors, robust_estimates(vectors))
    scaled = F.col("d2") / F.greatest(F.col("median") / MEDIAN, F.lit(1.0))
    good = judged.select("doc_id", *COUNTS, "base_failed", (scaled <= CUTOFF).alias("kept"), scaled.alias("distance"))
    bad = counted.where("base_failed").select(
        "doc_id", *COUNTS, "base_failed", F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance")
    )
    return good.unionByName(bad)
