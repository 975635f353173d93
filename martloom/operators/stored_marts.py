"""The budget mart as a stored table that is kept up to date: only campaigns whose inputs changed are worked out again.

A row of the mart depends on all days of its campaign (week, month, weekday and lifetime figures), so the unit is the
campaign. What a campaign's rows are made of is folded into a digest; campaigns whose digest differs from that of the load
before are built from the facts and put in place of their old rows. Rows are stored by a bucket of their campaign: the files
of buckets without such a campaign stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.keys import surrogate_key
from martloom.operators.changes import DIGEST, folded, row_hash
from martloom.operators.incremental import FactTable

BUCKETS = 64
# Times of a run, which say nothing about the rows.
AUDIT = ("dw_insert_date", "dw_update_date", "analysis_date")


def budget_inputs(spend: DataFrame, performance: DataFrame, adset: DataFrame, campaign: DataFrame) -> DataFrame:
    """One row per campaign with the digest of all rows that its part of the budget mart is made of."""
    parents = adset.select("adset_key", "campaign_key")
    parts = [spend, performance.join(parents, "adset_key"), campaign]
    hashed = None
    for nth, part in enumerate(parts):
        plain = part.drop(*AUDIT)
        rows = plain.select("campaign_key", F.xxhash64(F.lit(nth), row_hash(plain)).alias("h"))
        hashed = rows if hashed is None else hashed.unionByName(rows)
    return hashed.where("campaign_key IS NOT NULL").groupBy("campaign_key").agg(*folded(F.col("h")))


class StoredMart:
    """A mart with one row per group and day, stored and updated by group. One load at a time may write to it."""

    def __init__(self, spark: SparkSession, folder: str, group: str, day: str):
        """group: the column whose rows are replaced together; with day it identifies a row."""
        self.spark, self.folder, self.group, self.day = spark, folder.rstrip("/"), group, day
        self.table = FactTable(spark, f"{self.folder}/rows", "mart_key", day, self.bucket())

    def bucket(self):
        return F.pmod(F.xxhash64(F.col(self.group)), F.lit(BUCKETS)).cast("int")

    def read(self) -> DataFrame | None:
        found = self.table.read()
        return None if found is None else found.drop("mart_key")

    def _digests(self, nth: int) -> str:
        return f"{self.folder}/digests/load={nth}"

    def update(self, digests: DataFrame, build: Callable[[DataFrame], DataFrame]) -> int:
        """Bring the table to what its inputs say now; the number of groups that were built.

        ``digests`` has one row per group; ``build`` gets the groups (one column) and returns their rows. A group that is gone
        loses its rows. A load that dies before its digests are written is done again by the next one.
        """
        where, files = self.table._files(f"{self.folder}/digests")
        names = [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []
        done = [int(n[5:]) for n in names if n[5:].isdigit() and files.exists(self.table._files(f"{self.folder}/digests/{n}/_SUCCESS")[0])]
        last = max(done, default=0)
        # Written before anything is built, so that all that follows speaks of one state of the inputs.
        digests.write.mode("overwrite").parquet(f"{self._digests(last + 1)}-read")
        now = self.spark.read.schema(digests.schema).parquet(f"{self._digests(last + 1)}-read")
        before = self.spark.read.schema(digests.schema).parquet(self._digests(last)) if last else now.where("false")
        old, new = (df.select(self.group, F.struct(*DIGEST).alias(n)) for df, n in ((before, "old"), (now, "new")))
        differs = old.join(new, self.group, "full").where(~F.col("old").eqNullSafe(F.col("new"))).select(self.group)
        path = f"{self._digests(last + 1)}-changed"
        differs.write.mode("overwrite").parquet(path)
        changed = self.spark.read.schema(differs.schema).parquet(path)
        count = changed.count()
        if count:
            touched = {row["b"] for row in changed.select(self.bucket().alias("b")).distinct().collect()}
            stored = self.table.read(periods=touched.__contains__)
            gone = None if stored is None else stored.join(changed, self.group, "left_semi").select("mart_key")
            rows = build(changed)
            self.table.upsert(rows.withColumn("mart_key", surrogate_key(self.group, self.day)), gone=gone)
            now.write.mode("overwrite").parquet(self._digests(last + 1))
        return count
