"""Histories: validity periods of a changing attribute, and credit of a purchase to the touches before it.

Both need rows of one key in time order. A key that holds a third of all rows must not end up in one task, so rows are
first brought down to one per key and day, or one per key and hour and one per key and second; only those short
sequences, no longer than the calendar or an hour, are windowed. What is left to a window over events is one second of
one user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.keys import surrogate_key
from martloom.functions.measures import UNITS_PER_ONE, ratio_units
from martloom.operators.common import no_value


def validity_periods(observed: DataFrame, key: str, day: str, *tracked: str) -> DataFrame:
    """Periods over which the tracked columns of a key stay the same.

    ``observed`` has one row per key and day. A period starts on its first day and ends where the next one starts;
    the last one has no end and is current.
    """
    history = Window.partitionBy(key).orderBy(day)
    state = surrogate_key(*tracked)
    changes = observed.withColumn("_before", F.lag(state).over(history)).where(
        F.col("_before").isNull() | (F.col("_before") != state)
    )
    return changes.select(
        key,
        *tracked,
        F.col(day).alias("effective_date"),
        F.lead(day).over(history).alias("expiration_date"),
        F.lead(day).over(history).isNull().alias("is_current"),
    )


def daily_prices(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """The prices each product was sold at on each day, one row per product, day and price."""
    sold = order_items.select("order_id", "product_id", "unit_price").join(
        orders.select("order_id", F.to_date("order_date").alias("day")), "order_id"
    )
    return sold.select("product_id", "day", F.col("unit_price").alias("price")).distinct()


def price_periods(prices: DataFrame) -> DataFrame:
    """Periods between changes of a product's price, from rows (product_id, day, price).

    Prices of one day count as if they came in ascending order, so all but the last of them end on the day they start.
    A day that begins with the price the day before ended with goes on with its period. NULL prices are no prices.
    """
    known = prices.where("price IS NOT NULL").distinct()
    days = known.groupBy("product_id", "day").agg(F.min("price").alias("low"), F.max("price").alias("high"))
    history = Window.partitionBy("product_id").orderBy("day")
    goes_on = F.coalesce(F.col("before") == F.col("low"), F.lit(False))
    changes = (
        days.withColumn("before", F.lag("high").over(history))
        .where(~(goes_on & (F.col("low") == F.col("high"))))
        .withColumn("next_day", F.lead("day").over(history))
    )
    started = known.join(changes, ["product_id", "day"]).where(~(goes_on & (F.col("price") == F.col("low"))))
    ends = F.when(F.col("price") < F.col("high"), F.col("day")).otherwise(F.col("next_day"))
    return started.select(
        "product_id", "price", F.col("day").alias("effective_date"), ends.alias("expiration_date"),
        ends.isNull().alias("is_current"),
    )


def product_price_history(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    return price_periods(daily_prices(order_items, orders))


TOUCHES = ("click", "view")


def touch_attribution(events: DataFrame) -> DataFrame:
    """Purchases and their value per kind of touch: by the user's first touch, by the last one, and in equal parts.

    ``events`` has user_id, ts, event_id, event_type and value. Touches count if they come before the purchase in
    (ts, event_id) order; a purchase without any touch before it is credited to none. What a purchase needs from
    before is a running count per kind and the first and last kind: taken within the user's second, and carried over
    from the seconds of the hour and the hours before it, of which a user has one row each.
    """
    kind = F.when(F.col("event_type").isin(*TOUCHES), F.col("event_type"))
    timed = events.where(F.col("event_type").isin(*TOUCHES, "purchase")).select(
        "user_id", F.date_trunc("hour", "ts").alias("hour"), F.date_trunc("second", "ts").alias("second"),
        F.struct("ts", "event_id").alias("at"), kind.alias("touch"), F.col("value").cast("decimal(18,2)").alias("value"),
    )

    # One row per user and second, also for seconds with purchases only, and from these one per user and hour.
    found = F.when(F.col("touch").isNotNull(), F.struct("at", "touch"))
    seconds = timed.groupBy("user_id", "hour", "second").agg(
        F.min(found).alias("first"),
        F.max(found).alias("last"),
        *[F.count(F.when(F.col("touch") == name, 1)).alias(name) for name in TOUCHES],
    )
    hours = seconds.groupBy("user_id", "hour").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), *[F.sum(name).alias(name) for name in TOUCHES]
    )

    def before(rows: DataFrame, keys: list[str], step: str, level: str) -> DataFrame:
        """What all earlier steps of the same keys add up to."""
        earlier = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
        return rows.select(
            *keys,
            step,
            F.min("first").over(earlier)["touch"].alias(f"{level}_first"),
            F.max("last").over(earlier)["touch"].alias(f"{level}_last"),
            *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{level}_{name}") for name in TOUCHES],
        )

    within = Window.partitionBy("user_id", "hour", "second").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    running = timed.select(
        "*",
        F.first("touch", ignorenulls=True).over(within).alias("own_first"),
        F.last("touch", ignorenulls=True).over(within).alias("own_last"),
        *[F.count(F.when(F.col("touch") == name, 1)).over(within).alias(f"own_{name}") for name in TOUCHES],
    ).where("touch IS NULL")
    bought = (
        running.join(before(seconds, ["user_id", "hour"], "second", "second"), ["user_id", "hour", "second"])
        .join(before(hours, ["user_id"], "hour", "hour"), ["user_id", "hour"])
        .select(
            "value",
            F.coalesce("hour_first", "second_first", "own_first").alias("first_touch"),
            F.coalesce("own_last", "second_last", "hour_last").alias("last_touch"),
            *[(F.col(f"hour_{n}") + F.col(f"second_{n}") + F.col(f"own_{n}")).alias(n) for n in TOUCHES],
        )
        .where("first_touch IS NOT NULL")
    )

    everything = F.col(TOUCHES[0]) + F.col(TOUCHES[1])
    credited = bought.select(
        F.explode(F.array(*[
            F.struct(
                F.lit(name).alias("touch"),
                (F.col("first_touch") == name).cast("int").alias("first"),
                (F.col("last_touch") == name).cast("int").alias("last"),
                ratio_units(F.col(name).cast("double") / everything.cast("double")).alias("share"),
                F.col("value").alias("value"),
            )
            for name in TOUCHES
        ])).alias("c")
    ).select("c.*")
    nothing = no_value("decimal(18,2)")
    return credited.groupBy("touch").agg(
        F.sum("first").alias("first_touch_purchases"),
        F.sum("last").alias("last_touch_purchases"),
        (F.sum("share").cast("double") / F.lit(UNITS_PER_ONE)).alias("linear_purchases"),
        F.sum(F.when(F.col("first") == 1, F.col("value")).otherwise(nothing)).cast("decimal(28,2)").alias(
            "first_touch_value"
        ),
        F.sum(F.when(F.col("last") == 1, F.col("value")).otherwise(nothing)).cast("decimal(28,2)").alias(
            "last_touch_value"
        ),
    )
