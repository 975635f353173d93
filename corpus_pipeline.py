"""The corpus pipeline: stages over documents, each written to the shared folder and read again by the next.

Every stage gets all that its predecessor kept. All but the last return the columns of documents, with their values as
they were; the last adds the token ids. A table with no rows passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import bpe, exact_dedup, ngram_join, source_mixing, toxicity
from martloom.llm.common import fresh, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier toxic than not go. The classifier learns from labelled documents that it is given."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")
    score = fresh("score")
    return toxicity.with_score(docs, "text", model, score).where(F.col(score) < 0.5).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, one row stays."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates, the document with the least id stays."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled so that sources, languages and topics come near their wanted shares of tokens."""
    return source_mixing.kept_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, token_ids (binary, little-endian), n_tokens, and whether the ids decode to the text."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), "text", path, pattern)
    same = F.coalesce(F.col("text"), F.lit("")).cast("binary") == F.col("decoded")
    return coded.select(
        "doc_id", "lang", "source", "token_ids", F.floor(F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        same.alias("decodes"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("source_mixing", mix_sources),
    ("byte_bpe", tokenise),
]

# A trained classifier and a sampling by fitted weights are among the stages; tests hold run() against a plain version on sf0.001.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
