"""Incremental fact tables: a high-water mark and a keyed upsert, on plain Parquet files.

Files lie under ``data/version=N/kind=new*|single|kept/period=P``, where a period is a month (yyyymm) or a day (yyyymmdd). A
load adds the folders of its new rows and rewrites only the periods that hold a row with one of the new keys; all
other periods stay where they are. What is valid is listed in ``log/version=N``, one small file that is written last:
a load that dies before has changed nothing, a reader always sees a whole version, and no path is read and
overwritten at once.

Rows are shuffled once, on their way to the folder of their period. What has to be known of their keys is read from the
stored rows: the key, of 16 bytes if it is a hash, and its period. A large load may come in parts that are built and stored
one after the other; shuffle files of one are gone before the next begins, and all become visible at once.

Which period a key is stored under is kept in an index, ``keys/version=N-packed/bucket=B``, where a bucket holds the keys
whose hash begins with its bits. A load reads and rewrites the buckets of its own keys only, in one pass that finds the
periods with rows to be replaced and the keys that come twice as well. When buckets hold more than ``BUCKET_KEYS`` keys on
average, the index is dealt again with more bits, so a bucket stays of one size however large the table grows.

One load at a time may write to a table.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from martloom.functions.keys import packed, unpacked
from martloom.operators import changes
from martloom.session import shuffles_dropped

# Rows of data have a period, rows of the index a bucket, the number of its keys and the bits of all bucket numbers.
LOG_SCHEMA = "version int, period int, path string, bucket int, keys bigint, bits int"
# A key (packed), the period it is stored under now and, if this load moved or removed it, the one before; the rows it came in.
INDEX_SCHEMA = "_key binary, period int, was int, times bigint, bucket int"
PACKED = "-packed"
BUCKET_KEYS = 1 << 20
# Stored rows hold many hashes as text, of which this takes half.
COMPRESSION = "zstd"


def latest_per_key(rows: DataFrame, key: str, time_column: str) -> DataFrame:
    """One row per key, the latest; needed where one batch may bring several states of a row.

    Each task keeps only its own latest row per key before anything is shuffled, so a key with very many states is no
    load on a single task.
    """
    others = [c for c in rows.columns if c != key]
    latest = Window.partitionBy(key).orderBy(F.desc(time_column), *[F.desc(c) for c in others if c != time_column])
    return rows.withColumn("_state", F.row_number().over(latest)).where("_state = 1").drop("_state")


def month_of_key(date_key: str) -> Column:
    """yyyymm of a yyyymmdd key."""
    return F.floor(F.col(date_key) / 100).cast("int")


@dataclass
class Live:
    """What a version of a table consists of."""

    version: int = 0
    data: list[tuple[int, str]] = field(default_factory=list)  # period, folder
    index: dict[int, tuple[str, int]] = field(default_factory=dict)  # bucket -> folder, number of keys
    bits: int = 0


def bucket_of(key: str | Column, bits: int) -> Column:
    """The first bits of a packed key's hash, as a number."""
    if not bits:
        return F.lit(0)
    return F.shiftrightunsigned(F.xxhash64(key), 64 - bits).cast("int")


class FactTable:
    """A stored fact with a unique key, the time column of its loads and the period a row is stored under.

    The period must grow with the time: the high-water mark is looked for in the last period only.
    """

    def __init__(
        self, spark: SparkSession, folder: str, unique_key: str, time_column: str, period: Column,
        bucket_keys: int = BUCKET_KEYS,
    ):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.unique_key = unique_key
        self.time_column = time_column
        self.period = period
        self.bucket_keys = bucket_keys

    # ---- reading ----

    def _files(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def live(self) -> Live:
        """The latest version: a few entries per period, and one per bucket of the index."""
        where, files = self._files(f"{self.folder}/log")
        if not files.exists(where):
            return Live()
        # Only the newest complete version is opened, however many there are.
        versions = sorted((int(s.getPath().getName().split("=")[1]) for s in files.listStatus(where)), reverse=True)
        for last in versions:
            path = f"{self.folder}/log/version={last}"
            if files.exists(self._files(f"{path}/_SUCCESS")[0]):
                log = self.spark.read.schema(LOG_SCHEMA).option("basePath", f"{self.folder}/log").parquet(path).collect()
                data = [(row["period"], row["path"]) for row in log if row["period"] is not None]
                index = {row["bucket"]: (row["path"], row["keys"]) for row in log if row["bucket"] is not None}
                if not all(PACKED in path for path, _ in index.values()):
                    return Live(last, data)  # an index of whole keys, as it once was: the next load makes one anew
                return Live(last, data, index, max((row["bits"] or 0 for row in log), default=0))
        return Live()

    def _read(self, paths: list[str]) -> DataFrame:
        """Rows of some period folders, with their period."""
        found = self.spark.read.option("basePath", f"{self.folder}/data").parquet(*paths)
        return found.drop("version", "kind")

    def _numbered(self, path: str, name: str) -> list[tuple[int, str]]:
        where, files = self._files(path)
        if not files.exists(where):
            return []
        names = [status.getPath().getName() for status in files.listStatus(where)]
        return [(int(n.split("=")[1]), f"{path}/{n}") for n in names if n.startswith(f"{name}=")]

    def read(self, first_period: int | None = None, periods: Callable[[int], bool] | None = None) -> DataFrame | None:
        """The table as of its last load, from ``first_period`` on or of the periods wanted; None if nothing is there."""
        paths = [
            path for period, path in self.live().data
            if (first_period is None or period >= first_period) and (periods is None or periods(period))
        ]
        return self._read(paths).drop("period") if paths else None

    def high_water(self):
        """Largest time stored, read from the last period alone; None for a table without rows."""
        live = self.live().data
        if not live:
            return None
        last = max(period for period, _ in live)
        return self._read([path for period, path in live if period == last]).agg(F.max(self.time_column)).first()[0]

    # ---- the index ----

    def _entries(self, live: Live, buckets: Collection[int]) -> DataFrame:
        """Packed key and period of the stored rows in some buckets; only their files are opened."""
        paths = [live.index[b][0] for b in sorted(buckets) if b in live.index]
        if not paths:
            return self.spark.createDataFrame([], "_key binary, period int")
        return self.spark.read.schema("_key binary, period int").parquet(*paths).where("period IS NOT NULL")

    def known_keys(self, live: Live, buckets: set[int]) -> DataFrame:
        """Key and period of the stored rows in some buckets; only their files are opened."""
        return self._entries(live, buckets).select(unpacked("_key").alias(self.unique_key), "period")

    def _packed(self, rows: DataFrame, *others: str) -> DataFrame:
        return rows.select(packed(F.col(self.unique_key).cast("string")).alias("_key"), *others)

    def _buckets_of(self, keys: DataFrame, bits: int) -> set[int]:
        """The buckets some keys are in: at most one number per bucket, not per key."""
        return self._buckets(self._packed(keys), bits)

    @staticmethod
    def _buckets(keys: DataFrame, bits: int) -> set[int]:
        if not bits:
            return {0}
        return {row["b"] for row in keys.select(bucket_of("_key", bits).alias("b")).distinct().collect()}

    def _bits_for(self, keys: int, bits: int) -> int:
        while keys > self.bucket_keys << bits:
            bits += 1
        return bits

    def _store_index(
        self, known: DataFrame, added: DataFrame | None, gone: DataFrame | None, bits: int, path: str
    ) -> tuple[dict[int, tuple[str, int]], set[int], bool]:
        """Write the entries of some buckets as they are after a load, in one shuffle of keys.

        Folder and number of keys of each bucket, the periods that hold a row which is replaced or removed, and whether any
        added key came twice.
        """
        nothing = F.lit(None).cast("int")
        marks = known.select("_key", F.col("period").alias("was"), nothing.alias("period"), F.lit(0).alias("kind"))
        if added is not None:
            marks = marks.unionByName(added.select("_key", nothing.alias("was"), "period", F.lit(1).alias("kind")))
        if gone is not None:
            marks = marks.unionByName(gone.select("_key", nothing.alias("was"), nothing.alias("period"), F.lit(2).alias("kind")))
        # A bucket is one task's, and of bounded size.
        dealt = marks.withColumn("bucket", bucket_of("_key", bits)).repartition("bucket")
        merged = dealt.groupBy("bucket", "_key").agg(
            F.max("was").alias("_was"), F.max("period").alias("_period"),
            F.count_if(F.col("kind") == 1).alias("times"), F.max("kind").alias("_kind"),
        )
        stays = F.col("_kind") == 0
        entries = merged.select(
            "_key", F.when(stays, F.col("_was")).otherwise(F.col("_period")).alias("period"),
            F.when(~stays, F.col("_was")).alias("was"), "times", "bucket",
        ).where("period IS NOT NULL OR was IS NOT NULL")
        writer = entries.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", COMPRESSION)
        writer.partitionBy("bucket").parquet(path)
        folders = dict(self._numbered(path, "bucket"))
        # At most one row per bucket, with a number for each period it has rows to replace in.
        found = self._index_of(path).groupBy("bucket").agg(
            F.count("period").alias("keys"), F.collect_set("was").alias("was"), F.max("times").alias("times")
        ).collect()
        index = {row["bucket"]: (folders[row["bucket"]], row["keys"]) for row in found}
        return index, {p for row in found for p in row["was"]}, any(row["times"] > 1 for row in found)

    def _index_of(self, path: str) -> DataFrame:
        return self.spark.read.schema(INDEX_SCHEMA).parquet(path)

    # ---- writing ----

    @staticmethod
    def balanced(rows: DataFrame) -> DataFrame:
        """Rows shuffled for writing: a period goes into few files, and one too big for a task is split."""
        return rows.hint("rebalance", F.col("period"))

    def _store(self, rows: DataFrame, path: str) -> list[tuple[int, str]]:
        # Hashes travel as bytes. Replaces the whole folder, also what a dead load may have left there.
        hashes = {f.name for f in rows.schema if f.name.endswith("_key") and isinstance(f.dataType, StringType)}
        short = rows.select(*[packed(F.col(c)).alias(c) if c in hashes else F.col(c) for c in rows.columns])
        dealt = self.balanced(short)
        whole = dealt.select(*[unpacked(c).alias(c) if c in hashes else F.col(c) for c in rows.columns])
        writer = whole.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", COMPRESSION)
        writer.partitionBy("period").parquet(path)
        return self._numbered(path, "period")

    def _keys_in(self, folders: list[tuple[int, str]]) -> DataFrame | None:
        """Packed key and period of the rows in some folders."""
        return self._packed(self._read([path for _, path in folders]), "period") if folders else None

    def upsert(
        self, rows: DataFrame | Sequence[DataFrame], gone: DataFrame | None = None, replaced: Collection[int] = ()
    ) -> None:
        """Replace the stored rows that share a key with ``rows``, and add ``rows``: of a key that comes twice, the latest.

        Rows may come in several parts, which are stored in turn. Stored rows whose key is in ``gone`` are removed, unless
        ``rows`` has them, and so is all that is stored under the periods ``replaced``: their folders are dropped, and nothing
        of them is read but the keys. A key must not be NULL.
        """
        parts = [rows] if isinstance(rows, DataFrame) else list(rows)
        # A micro-batch has a session of its own.
        with shuffles_dropped(self.spark, *[part.sparkSession for part in parts]):
            self._upsert(parts, gone, replaced)

    def _upsert(self, parts: list[DataFrame], gone: DataFrame | None, replaced: Collection[int]) -> None:
        live = self.live()
        version = live.version + 1
        base, path = f"{self.folder}/data/version={version}", f"{self.folder}/keys/version={version}{PACKED}"
        new = []
        for nth, part in enumerate(parts):
            new += self._store(part.withColumn("period", self.period), f"{base}/kind=new{nth or ''}")
        added = self._keys_in(new)
        leaving = None
        if gone is not None:
            # Worked out once; it is read several times below.
            at = f"{self.folder}/keys/version={version}-gone"
            self._packed(gone).write.mode("overwrite").parquet(at)
            leaving = self.spark.read.schema("_key binary").parquet(at)
        stays = [(period, folder) for period, folder in live.data if period not in replaced]
        dropped = len(stays) < len(live.data)
        if added is None and leaving is None and not dropped:
            return

        bits, indexed = live.bits, set(live.index)
        if live.data and not indexed:
            # A table that was stored without an index: its keys are read once.
            known, buckets = self._keys_in(stays) or self._entries(live, ()), None
        else:
            entries = self._entries(live, indexed)
            buckets = set()
            for keys in (added, leaving, entries.where(F.col("period").isin(*replaced)) if dropped else None):
                if keys is not None:
                    buckets |= self._buckets(keys, bits)
            known = self._entries(live, buckets)
            if dropped:
                known = known.where(~F.col("period").isin(*replaced))
        if buckets is None or buckets >= indexed:
            # All of it is written anew, so it may as well be dealt for as many keys as there can be.
            most = sum(count for _, count in live.index.values()) if indexed else known.count()
            bits = self._bits_for(most + (added.count() if added is not None else 0), bits)
            buckets = None

        stored, touched, repeated = self._store_index(known, added, leaving, bits, path)
        if repeated:
            # Periods with a state of a key that comes in several are stored again, with the latest of each.
            several = self._index_of(path).where("times > 1").select("_key")
            again = {r["period"] for r in added.join(several, "_key", "left_semi").select("period").distinct().collect()}
            states = self._read([folder for period, folder in new if period in again]).drop("period")
            single = latest_per_key(states, self.unique_key, self.time_column).withColumn("period", self.period)
            new = [(p, folder) for p, folder in new if p not in again] + self._store(single, f"{base}/kind=single")
            path = f"{path}-single"
            stored, touched, _ = self._store_index(known, self._keys_in(new), leaving, bits, path)

        data, kept = stays, []
        if touched:
            away = self._index_of(path).where("was IS NOT NULL").select("_key")
            old = self._read([folder for period, folder in data if period in touched])
            left = old.withColumn("_key", packed(F.col(self.unique_key).cast("string"))).join(away, "_key", "left_anti")
            kept = self._store(left.drop("_key"), f"{base}/kind=kept")
            data = [(period, folder) for period, folder in data if period not in touched]
        if not (new or touched or dropped):
            return

        index = stored if buckets is None else {**{b: x for b, x in live.index.items() if b not in buckets}, **stored}
        more = self._bits_for(sum(count for _, count in index.values()), bits)
        if more > bits:
            whole = self._entries(Live(index=index), set(index))
            bits, (index, _, _) = more, self._store_index(whole, None, None, more, f"{path}-{more}")
        log = [(version, period, folder, None, None, bits) for period, folder in (*data, *kept, *new)]
        log += [(version, None, folder, bucket, count, bits) for bucket, (folder, count) in index.items()]
        small = self.spark.createDataFrame(log or [(version, None, None, None, None, bits)], LOG_SCHEMA)
        small.drop("version").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/log/version={version}")

    def load(self, build: Callable[[object], DataFrame | Sequence[DataFrame]], look_back_days: int = 0) -> None:
        """Build the rows above the high-water mark, at once or in parts, and upsert them; a table without rows is loaded in
        full.

        Rows at or below the mark are not read again, so late ones are missed, unless ``look_back_days`` lowers it.
        """
        mark = self.high_water()
        if mark is not None and look_back_days:
            mark -= timedelta(days=look_back_days)
        self.upsert(build(mark))

    def load_changes(self, digests: DataFrame, build: Callable[[list[int]], DataFrame | Sequence[DataFrame]]) -> list[int]:
        """Build the periods whose source has changed since the last such load, and put them in place of what is stored.

        ``digests`` describes the source by period, as ``period_digests`` does; ``build`` gets the periods that differ and
        returns their rows. Late, corrected and deleted source rows arrive, however old; files of other periods stay. The
        first load builds all periods. A load that dies before its digests are written is done again by the next one.
        """
        path = f"{self.folder}/digests"
        where, files = self._files(path)
        names = [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []
        done = [n for n in names if n[5:].isdigit() and files.exists(self._files(f"{path}/{n}/_SUCCESS")[0])]
        last = max((int(n[5:]) for n in done), default=0)
        # Written before anything is built, so that all that follows speaks of one state of the source.
        now = f"{path}/load={last + 1}-read"
        with shuffles_dropped(self.spark):
            digests.write.mode("overwrite").parquet(now)
        now = self.spark.read.schema(changes.SCHEMA).parquet(now)
        before = (
            self.spark.read.schema(changes.SCHEMA).parquet(f"{path}/load={last}") if last
            else self.spark.createDataFrame([], changes.SCHEMA)
        )
        periods = changes.changed_periods(before, now)
        if periods:
            self.upsert(build(periods), replaced=periods)
            now.write.mode("overwrite").parquet(f"{path}/load={last + 1}")
        return periods
