"""Ad insights from a stream of events, and the ad fact kept up to date from it.

Counts by ad and day are kept as streaming state and given up once the watermark has passed the day, so the state is
bounded by ads times open days. Changed rows are written in update mode by the same keyed upsert the batch load uses,
into tables kept by day, so that only open days are rewritten; a micro-batch that is run again after a failure
replaces its own rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.calendar import date_key
from martloom.operators import facts
from martloom.operators.incremental import FactTable
from martloom.sources.star import SCHEMAS, event_counts, insight_columns

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# State is written once locally and once to the checkpoint; a stream goes back by one batch at most.
STATE = {
    STATE_STORE: ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.minBatchesToRetain": "2",
}


def utc_instant(wall: Column) -> Column:
    """The instant of a zoneless time read as UTC, whatever zone the session has (watermarks need instants)."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), wall).cast("timestamp")


def utc_day(instant: Column) -> Column:
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz")))


def ad_daily(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Streaming aggregate: insight records by ad and day, for events at most ``late`` behind the newest."""
    timed = events.withColumn("event_time", utc_instant(F.col("ts"))).withWatermark("event_time", late)
    counted = timed.groupBy(F.window("event_time", "1 day"), F.col("user_id").alias("ad_id")).agg(*event_counts())
    return insight_columns(counted.withColumn("date", utc_day(F.col("window.start"))).drop("window"))


def read_events(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(SCHEMAS["events"])
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_to_end(
    stream: DataFrame, checkpoint: str, write: Callable[[DataFrame], None], mode: str = "update"
) -> None:
    """Process everything there is now, one ``write`` per micro-batch."""
    conf = stream.sparkSession.conf
    before = {name: conf.get(name, None) for name in STATE}
    # Read when the query starts; state that outgrows memory stays on disk.
    for name, value in STATE.items():
        conf.set(name, value)
    try:
        query = (
            stream.writeStream.outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, _: write(batch))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


def insights_table(spark: SparkSession, folder: str) -> FactTable:
    return FactTable(spark, folder, "performance_id", "date", date_key(F.col("date")))


def stream_ad_daily(spark: SparkSession, events: str, folder: str, **reading) -> FactTable:
    """Insight records by ad and day, stored and kept up to date from the event stream."""
    table = insights_table(spark, f"{folder}/insights")
    run_to_end(ad_daily(read_events(spark, events, **reading)), f"{folder}/checkpoint", table.upsert)
    return table


def stream_fact_upsert(
    spark: SparkSession, events: str, folder: str, ad: DataFrame, calendar: DataFrame, **reading
) -> FactTable:
    """The ad fact, stored and kept up to date from the event stream."""
    key, time_column, day = facts.LOADS["fact_ad_performance"]
    table = FactTable(spark, f"{folder}/fact_ad_performance", key, time_column, F.col(day))

    def write(batch: DataFrame) -> None:
        table.upsert(facts.fact_ad_performance(batch, ad, calendar))

    run_to_end(ad_daily(read_events(spark, events, **reading)), f"{folder}/checkpoint", write)
    return table
