"""The text operators as queries over the whole documents table, and their check in SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from martloom.llm import (
    bpe, centroid_clusters, exact_dedup, license_scan, lm_scoring, ngram_join, periodic_runs, quality_compression,
    quality_rules, source_mixing, token_counts, token_ids, toxicity,
)
from martloom.llm.common import table


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_compression.scores(documents(spark, folder), table(spark, folder, "labels"))


def op2_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return token_ids.round_trip(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(
        documents(spark, folder), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, folder))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, folder))


def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Target: the documents that are labelled good."""
    target = table(spark, folder, "labels").where(F.col("quality") == 1)
    return lm_scoring.cross_entropy_difference(documents(spark, folder), target)


def op7_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return source_mixing.sampled(documents(spark, folder))


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(documents(spark, folder))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.verdicts(documents(spark, folder))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scores(documents(spark, folder), table(spark, folder, "labels"))


def op11_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_clusters.clustered(table(spark, folder, "embeddings"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.run_digests(documents(spark, folder))


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.document_counts(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_token_ids, op3_byte_bpe, op4_ngram_jaccard_join, op5_exact_dedup,
        op6_lm_scoring, op7_source_mixing, op8_license_scan, op9_quality_rules, op10_toxicity, op11_centroid_clusters,
        op12_periodic_runs, op13_token_counts,
    )
}



def clusters_sql(many: int = 16, rounds: int = 3) -> str:
    """Centroid clusters by plain distances in SQL: one step to assign and one to move for each round."""
    parts = [
        """kept AS (
            SELECT vec_id, row_number() OVER () AS row, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64
        )""",
        f"""centre_0 AS (
            SELECT place - 1 AS c, v
            FROM (SELECT v, row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) AS place FROM kept)
            WHERE place <= {many}
        )""",
    ]
    for k in range(rounds + 1):
        parts.append(f"""near_{k} AS (
            SELECT row, vec_id, any_value(v) AS v, arg_min(c, (d, c)) AS c, min(d) AS d
            FROM (
                SELECT row, vec_id, kept.v AS v, c,
                    CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(kept.v, o.v)]) AS BIGINT) AS d
                FROM kept CROSS JOIN centre_{k} o
            )
            GROUP BY row, vec_id
        )""")
        if k < rounds:
            parts.append(f"""centre_{k + 1} AS (
                SELECT o.c, coalesce(m.v, o.v) AS v
                FROM centre_{k} o LEFT JOIN (
                    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v
                    FROM (
                        SELECT c, i, sum(x) AS s, count(*) AS n
                        FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near_{k}) GROUP BY c, i
                    )
                    GROUP BY c
                ) m ON m.c = o.c
            )""")
    return f"""
        WITH {", ".join(parts)}
        SELECT vec_id, CAST(n.c AS INTEGER) AS cluster, d AS distance,
            CAST(sum(d) OVER (PARTITION BY n.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(o.v, ',')) AS centroid_sha256
        FROM near_{rounds} n JOIN centre_{rounds} o ON o.c = n.c
    """


ORACLE_SQL = {
    "op11_centroid_clusters": clusters_sql(),
    "op5_exact_dedup": r"""
        WITH rows AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm,
                length(coalesce(text, '')) AS points
            FROM documents
        ), ranked AS (
            SELECT doc_id, norm,
                first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
                count(*) OVER (PARTITION BY norm) AS group_size
            FROM rows
        )
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
        FROM ranked
    """,
}
