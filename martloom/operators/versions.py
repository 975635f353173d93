"""Type-2 dimensions: every version of a row with the days it is valid, kept up to date by successive snapshots.

A snapshot says how a source table stood on a day, and holds until the day of the next snapshot. Loading one therefore
settles the days from its own to the next one's that is known, or all days to come if there is none; it does not matter in
which order snapshots arrive. Only keys whose state differs from what is stored for these days are touched: their version is
closed, a new one opened, and where a late snapshot lies between two known ones, the old version goes on after it.
Neighbouring versions of equal state are one version.

Open versions are stored as one part and closed ones by the month they end in, so a snapshot of today reads the open
versions only, and a late one the months since.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.functions.keys import surrogate_key
from martloom.operators.incremental import FactTable

OPEN = 0  # the period of versions without an end
VERSION = ("version_key", "state", "effective_date", "expiration_date", "is_current")


def state_of(*columns: str):
    """A hash of the tracked columns: two rows with the same state are one version."""
    return surrogate_key(*columns)


def merged(
    stored: DataFrame, snapshot: DataFrame, key: str, columns: Sequence[str], day: date, until: date | None,
    closes_missing: bool,
) -> tuple[DataFrame, DataFrame]:
    """The versions that a snapshot of ``day`` makes of the stored ones, and the keys of the versions that they replace.

    ``stored`` has at least all versions that touch the days from ``day`` to ``until``; ``snapshot`` has one row per key with
    its state. Nothing comes back for keys that stay as they are.
    """
    begin, end = F.lit(day), F.lit(until).cast("date")
    ends = F.col("expiration_date")
    touching = stored.where((ends.isNull() | (ends >= begin)) & (end.isNull() | (F.col("effective_date") <= end)))
    valid = touching.where((F.col("effective_date") <= begin) & (ends.isNull() | (ends > begin)))
    both = valid.select(key, F.col("state").alias("_old")).join(snapshot.select(key, F.col("state").alias("_new")), key, "full")
    differs = ~F.col("_old").eqNullSafe(F.col("_new"))
    changed = both.where(differs if closes_missing else differs & F.col("_new").isNotNull()).select(key)
    touched = touching.join(changed, key, "left_semi")

    def cut(rows: DataFrame, first, last) -> DataFrame:
        return rows.select(key, *columns, "state", first.alias("effective_date"), last.alias("expiration_date"))

    before = cut(touched.where(F.col("effective_date") < begin), F.col("effective_date"), F.least(F.coalesce(ends, begin), begin))
    here = cut(snapshot.join(changed, key, "left_semi"), begin, end)
    pieces = before.unionByName(here)
    if until is not None:
        after = touched.where(ends.isNull() | (ends > end))
        pieces = pieces.unionByName(cut(after, F.greatest(F.col("effective_date"), end), ends))

    # A handful of pieces for each key: neighbours of one state become one.
    order = Window.partitionBy(key).orderBy("effective_date")
    goes_on = (F.lag("state").over(order) == F.col("state")) & (F.lag("expiration_date").over(order) == F.col("effective_date"))
    grouped = pieces.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn("_version", F.sum("_new").over(order))
    span = Window.partitionBy(key, "_version").orderBy("effective_date")
    whole = span.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    versions = (
        grouped.withColumn("_place", F.row_number().over(span))
        .withColumn("expiration_date", F.last("expiration_date").over(whole))
        .where("_place = 1")
    )
    result = versions.select(
        surrogate_key(key, "effective_date").alias("version_key"), key, *columns, "state", "effective_date",
        "expiration_date", F.col("expiration_date").isNull().alias("is_current"),
    )
    return result, touched.select("version_key")


class HistoryTable:
    """A stored type-2 dimension: the columns of the source, and version_key, state (a hash of the tracked columns),
    effective_date, expiration_date (the first day a version is no longer valid) and is_current.

    One load at a time may write to it.
    """

    def __init__(
        self, spark: SparkSession, folder: str, key: str, tracked: Sequence[str], closes_missing: bool = True
    ):
        """key: identifies a row in every snapshot. closes_missing: a row that a snapshot lacks is no longer valid."""
        self.spark, self.folder = spark, folder.rstrip("/")
        self.key, self.tracked, self.closes_missing = key, list(tracked), closes_missing
        ended = F.coalesce(F.year("expiration_date") * 100 + F.month("expiration_date"), F.lit(OPEN))
        self.table = FactTable(spark, f"{self.folder}/versions", "version_key", "effective_date", ended)

    def days(self) -> list[date]:
        """The days that have a snapshot: one value for each load."""
        where, files = self.table._files(f"{self.folder}/days")
        if not files.exists(where):
            return []
        names = [status.getPath().getName() for status in files.listStatus(where)]
        return sorted(date.fromisoformat(n.split("=")[1]) for n in names if n.startswith("day="))

    def read(self) -> DataFrame | None:
        """All versions; None before the first load."""
        return self.table.read()

    def current(self) -> DataFrame | None:
        """The open versions, without opening the closed ones."""
        return self.table.read(periods=lambda p: p == OPEN)

    def load(self, snapshot: DataFrame, day: date) -> None:
        """Take in how the source stood on a day. A second snapshot of one day replaces the first.

        Rows without a key are left out; of rows that share one, the one with the least state counts. A load that dies half
        way changes nothing or is repeated without harm: the mark of its day is set last.
        """
        columns = [c for c in snapshot.columns if c != self.key]
        clash = set(VERSION).intersection(snapshot.columns)
        if clash:
            raise ValueError(f"the history makes these columns itself: {sorted(clash)}")
        until = min((d for d in self.days() if d > day), default=None)
        stated = snapshot.where(F.col(self.key).isNotNull()).withColumn("state", state_of(*self.tracked))
        row = F.struct("state", *columns)
        stated = stated.groupBy(self.key).agg(F.min(row).alias("_row")).select(self.key, "_row.*")
        since = day.year * 100 + day.month
        stored = self.table.read(periods=lambda p: p == OPEN or p >= since)
        if stored is None:
            kinds = ", ".join(f"`{n}` {k}" for n, k in stated.select(self.key, *columns).dtypes)
            stored = self.spark.createDataFrame(
                [], f"version_key string, {kinds}, state string, effective_date date, expiration_date date, is_current boolean"
            )
        rows, replaced = merged(stored, stated, self.key, columns, day, until, self.closes_missing)
        self.table.upsert(rows, gone=replaced)
        done = self.spark.createDataFrame([(day,)], "at date").coalesce(1)
        done.write.mode("overwrite").parquet(f"{self.folder}/days/day={day.isoformat()}")
