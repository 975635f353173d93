"""Mixing sources to target weights: raking of token weights, then sampling by calibrated probabilities.

Iterative proportional fitting gives every cell (source, language, topic) a weight, so that the weighted tokens meet the
wanted share of each source, each language and each topic. A document's chance to stay is its cell's weight times one
number, at most 1, and that number is solved for the wanted number of tokens. The draw is a hash of the document's id: a
repeated task draws the same.

Only the number of tokens is met after that cut at 1, not the margins: cells beyond it are kept whole and give less than
their weight asks for, the others make up for it. The README has figures.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from martloom.llm import tokens
from martloom.llm.common import fresh, stored, unit_hash, with_text_columns

MARGINS = ("source", "lang", "topic")
# Exponent of the tokens that a source, language or topic has: 1 keeps its share, 0 makes all alike.
TEMPERATURES = {"source": 0.7, "lang": 0.7, "topic": 0.5}
KEEP_TOKENS = 0.8
TOPICS, TOPIC_WORD_BYTES = 8, 6
ROUNDS, TOLERANCE = 40, 1e-6
CANDIDATES, REFINEMENTS = 64, 5
SEED = 71


def token_topics(texts: pa.Array) -> list[pa.Array]:
    """Words of each text, and its topic: the class of words that most of its longer words are in (-1: no such word).

    Words are sorted into classes by their hash; the least class wins a tie. This stands in for a topic model, which may
    be given instead as a column.
    """
    words = tokens.find_words(texts, tokens.NOT_SPACE, tokens.LOWER_ASCII)
    longer = words.end - words.start >= TOPIC_WORD_BYTES
    kinds = (words.hashes()[longer] >> np.uint64(32)).astype(np.int64) % TOPICS
    table = np.bincount(words.doc[longer] * TOPICS + kinds, minlength=words.texts * TOPICS).reshape(words.texts, TOPICS)
    topic = np.where(table.sum(axis=1) > 0, table.argmax(axis=1), -1)
    return [pa.array(words.counts().astype(np.int64)), pa.array(topic.astype(np.int64))]


def with_topics(docs: DataFrame, text: str, tokens_name: str = "n_tokens", topic_name: str = "topic") -> DataFrame:
    def make() -> Callable[[pa.Array], list]:
        return token_topics

    return with_text_columns(docs, text, StructType([StructField(n, LongType()) for n in (tokens_name, topic_name)]), make)


def key(column: Column) -> Column:
    """A value as text that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def margin_targets(cells: DataFrame, name: str, temperature: float) -> DataFrame:
    """Wanted tokens of each value of a margin; they add up to all tokens."""
    sums = cells.groupBy(name).agg(F.sum("tokens").alias("t")).withColumn("p", F.pow(F.col("t").cast("double"), F.lit(temperature)))
    whole = sums.agg(F.sum("t").alias("all_t"), F.sum("p").alias("all_p"))
    return sums.join(F.broadcast(whole)).select(name, (F.col("all_t") * F.col("p") / F.col("all_p")).alias("wanted"))  # one row


def rake(cells: DataFrame, temperatures: dict[str, float], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """cells (source, lang, topic, tokens) with a weight each, so that weighted tokens meet every margin's targets.

    A round adjusts one margin after the other; the rounds end when none moved a weight by more than the tolerance. One
    number a round comes to the driver. Cells without tokens are not there.
    """
    wanted = [f"wanted_{name}" for name in MARGINS]
    for name, column in zip(MARGINS, wanted, strict=True):
        cells = cells.join(margin_targets(cells, name, temperatures[name]).withColumnRenamed("wanted", column), name)
    # Each cell carries its margins' targets, so that a round joins nothing but its own sums.
    now = stored(cells.withColumn("weight", F.lit(1.0)), "cells")
    for _ in range(rounds):
        moved = F.lit(0.0)
        for name, column in zip(MARGINS, wanted, strict=True):
            sums = now.groupBy(name).agg(F.sum(F.col("tokens") * F.col("weight")).alias("has"), F.max(column).alias("w"))
            factors = sums.select(name, (F.col("w") / F.col("has")).alias(f"by_{name}"))
            now = now.join(factors, name).withColumn("weight", F.col("weight") * F.col(f"by_{name}"))
            moved = F.greatest(moved, F.abs(F.col(f"by_{name}") - 1))
        now = stored(now.select(*MARGINS, *wanted, "tokens", "weight", moved.alias("moved")), "cells")
        if (now.agg(F.max("moved")).first()[0] or 0.0) <= tolerance:
            break
        now = now.drop("moved")
    return now.select(*MARGINS, "tokens", "weight")


def calibrated(cells: DataFrame, share: float) -> DataFrame:
    """cells with probability = least(1, f * weight), where f makes the expected tokens the wanted share of all.

    f is found by trying 64 values at a time in one aggregation. A share of 1 or more keeps everything.
    """
    total, low, most = cells.agg(F.sum("tokens"), F.min("weight"), F.max("weight")).first()
    if not total or share >= 1:
        return cells.withColumn("probability", F.lit(1.0))
    lower, upper = 0.0, 1.0 / low
    for _ in range(REFINEMENTS):
        tried = [lower + (upper - lower) * k / CANDIDATES for k in range(1, CANDIDATES + 1)]
        sums = cells.agg(*[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.lit(f) * F.col("weight"))) for f in tried]).first()
        over = next((k for k, s in enumerate(sums) if s >= share * total), CANDIDATES - 1)
        lower, upper = (tried[over - 1] if over else lower), tried[over]
    return cells.withColumn("probability", F.least(F.lit(1.0), F.lit(upper) * F.col("weight")))


def drawn(
    docs: DataFrame, doc_id: str, text: str, source: str, lang: str, temperatures: dict[str, float], share: float, seed: int
) -> tuple[DataFrame, dict[str, str]]:
    """docs with topic, n_tokens, weight, probability and kept under names that docs does not have, and these names."""
    names = {n: fresh(n) for n in ("source", "lang", "topic", "n_tokens", "weight", "probability", "kept")}
    keyed = docs.withColumn(names["source"], key(F.col(source))).withColumn(names["lang"], key(F.col(lang)))

    def with_cells(rows: DataFrame) -> DataFrame:
        return with_topics(rows, text, names["n_tokens"], names["topic"])

    rows = with_cells(keyed.select(text, names["source"], names["lang"]))
    cells = rows.where(F.col(names["n_tokens"]) > 0).groupBy(*[F.col(names[m]).alias(m) for m in MARGINS]).agg(
        F.sum(names["n_tokens"]).alias("tokens")
    )
    chances = stored(calibrated(rake(stored(cells, "cells"), temperatures), share), "chances")
    about = chances.select(*[F.col(c).alias(names[c]) for c in (*MARGINS, "weight", "probability")])
    found = with_cells(keyed).join(about, [names[m] for m in MARGINS], "left")
    # A row without an id is drawn by its text: there may be any number of them.
    draw = unit_hash(F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(text)), seed=seed)
    has_tokens = F.col(names["n_tokens"]) > 0
    return found.withColumn(names["kept"], ~has_tokens | F.coalesce(draw < F.col(names["probability"]), F.lit(True))), names


def sampled(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    temperatures: dict[str, float] = TEMPERATURES,
    share: float = KEEP_TOKENS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, weight, probability and kept for every document.

    A NULL source or language is a value of its own. Texts without words (NULL, empty) weigh no tokens and are kept; they
    have no weight. Rows with the same id are drawn with the same number, each against the probability of its own cell; a row
    without an id is drawn by its text. An empty table gives an empty result.
    """
    plain = docs.select(*dict.fromkeys((doc_id, text, source, lang)))
    found, names = drawn(plain, doc_id, text, source, lang, temperatures, share, seed)
    weighed = F.col(names["n_tokens"]) > 0
    return found.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(lang).alias("lang"),
        F.col(names["topic"]).alias("topic"), F.col(names["n_tokens"]).alias("n_tokens"),
        *[F.when(weighed, F.col(names[c])).alias(c) for c in ("weight", "probability")], F.col(names["kept"]).alias("kept"),
    )


def kept_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
    temperatures: dict[str, float] = TEMPERATURES, share: float = KEEP_TOKENS, seed: int = SEED,
) -> DataFrame:
    """The rows of docs that the sampling keeps, with all their columns: each row by its own draw."""
    found, names = drawn(docs, doc_id, text, source, lang, temperatures, share, seed)
    return found.where(names["kept"]).select(*docs.columns)
