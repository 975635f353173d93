"""Which periods of a source changed since the last load: digests of its rows, by period.

A digest is the number of rows, and the sum and the exclusive or of a hash of each row. All three are the same whatever the
order of the rows, and parts of a period add up, so rows are folded before anything is shuffled. A row that is added, lost
or different changes the digest of its period; a row that moves changes both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGEST = ("rows", "hash_sum", "hash_xor")
SCHEMA = "period int, rows bigint, hash_sum decimal(38,0), hash_xor bigint"


@dataclass(frozen=True)
class Source:
    """Where the rows of a fact come from: a table with a time, and maybe one of details that have none of their own."""

    table: str
    time_column: str
    details: str | None = None
    key: str | None = None


    @property
    def tables(self) -> list[str]:
        return [self.table, self.details] if self.details else [self.table]


def month_of(time: Column) -> Column:
    return (F.year(time) * 100 + F.month(time)).cast("int")


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns; NULL is unlike any value, and a value is not taken for its neighbour's."""
    parts = [c for name in sorted(df.columns) for c in (F.col(name).isNull(), F.col(name))]
    return F.xxhash64(*parts)


def folded(hashes: Column) -> list[Column]:
    return [
        F.count("*").alias("rows"), F.sum(hashes.cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor(hashes).alias("hash_xor"),
    ]


def period_digests(tables, source: Source) -> DataFrame:
    """One row per month of the source: period (yyyymm), rows, hash_sum, hash_xor. Rows without a time are left out.

    Details belong to the month of the row they share a key with: they are folded by key, and a row's hash takes theirs in.
    """
    main = tables[source.table]
    hashed = main.select(month_of(F.col(source.time_column)).alias("period"), row_hash(main).alias("h"), *([source.key] if source.key else []))
    hashed = hashed.where("period IS NOT NULL")
    if source.details:
        parts = tables[source.details]
        by_key = parts.select(source.key, row_hash(parts).alias("h")).groupBy(source.key).agg(*folded(F.col("h")))
        both = hashed.join(by_key, source.key, "left")
        hashed = both.select("period", F.xxhash64("h", *[c for n in DIGEST for c in (F.col(n).isNull(), F.col(n))]).alias("h"))
    return hashed.groupBy("period").agg(*folded(F.col("h")))


def changed_periods(before: DataFrame, now: DataFrame) -> list[int]:
    """Periods whose digests differ, or that only one side has: at most one number for each period."""
    old = before.select("period", F.struct(*DIGEST).alias("old"))
    new = now.select("period", F.struct(*DIGEST).alias("new"))
    differs = old.join(new, "period", "full").where(~F.col("old").eqNullSafe(F.col("new")))
    return sorted(row["period"] for row in differs.select("period").collect())
