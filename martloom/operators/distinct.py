"""Distinct counts that add up over grains: exact bitmaps of ids, merged from months to quarters and years.

A count of distinct customers of three months is not the sum of the three counts, but the bits of their bitmaps can be put
together. Ids are whole numbers; a bitmap holds 256 neighbouring ones in 32 bytes, so ids should lie close to one another,
but ids that lie apart take little more than themselves. Spark's own bitmaps have 4 KB each while they are worked on, so
ids and states are shuffled and sorted before, and one such bitmap at a time is held. An id that comes often is one row of
each task before that: so is a customer with a third of all orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.sales_marts import REGION, located_orders


BITS = 256


def _put_together(rows: DataFrame, keys: Sequence[str], agg) -> DataFrame:
    """Rows by keys, id column and bucket, aggregated where they meet and cut to the bits that are used."""
    names = [*keys, "counted", "bucket"]
    whole = rows.repartition(*names).groupBy(*names).agg(agg.alias("bits"))
    return whole.withColumn("bits", F.substring("bits", 1, BITS // 8))


def bitmaps(rows: DataFrame, keys: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """The state of distinct counts: keys, which id column is counted, its bucket and the bits that occur in it.

    NULL ids are not counted. States of parts of the rows may be put together with ``merged``.
    """
    listed = rows.select(*keys, *[F.col(c).cast("bigint").alias(c) for c in ids]).unpivot(list(keys), list(ids), "counted", "id")
    once = listed.where("id IS NOT NULL").distinct()
    placed = once.select(*keys, "counted", F.expr(f"id - pmod(id, {BITS})").alias("bucket"), F.expr(f"pmod(id, {BITS})").alias("bit"))
    return _put_together(placed, keys, F.bitmap_construct_agg("bit"))


def merged(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state by fewer keys, or of several states in one table."""
    return _put_together(state, keys, F.bitmap_or_agg("bits"))


def distinct_counts(state: DataFrame, keys: Sequence[str], **names: str) -> DataFrame:
    """One row per keys with the number of distinct ids of each column: names gives column=id column."""
    ones = F.bitmap_count("bits")
    counts = [
        F.coalesce(F.sum(F.when(F.col("counted") == column, ones)), F.lit(0)).cast("bigint").alias(name)
        for name, column in names.items()
    ]
    return state.groupBy(*keys).agg(*counts)


GRAINS = {"month": ("year_number", "quarter_number", "month_number"), "quarter": ("year_number", "quarter_number"), "year": ("year_number",)}


def regional_bitmaps(sales: DataFrame, customer: DataFrame, calendar: DataFrame) -> DataFrame:
    """Orders and customers of each region and month, as bitmaps."""
    return bitmaps(located_orders(sales, customer, calendar), [*REGION, *GRAINS["month"]], ["order_id", "customer_id"])


def regional_reach(monthly: DataFrame) -> DataFrame:
    """Distinct orders and customers of each region by month, quarter and year, all from the months' bitmaps.

    A quarter is merged from its months and a year from its quarters; the sales are not read again.
    """
    found, state = None, monthly
    for grain, time in GRAINS.items():
        keys = [*REGION, *time]
        state = state if grain == "month" else merged(state, keys)
        counts = distinct_counts(state, keys, order_count="order_id", customer_count="customer_id")
        for name in GRAINS["month"]:
            if name not in time:
                counts = counts.withColumn(name, F.lit(None).cast("int"))
        rows = counts.select(F.lit(grain).alias("grain"), *REGION, *GRAINS["month"], "order_count", "customer_count")
        found = rows if found is None else found.unionByName(rows)
    return found
