"""Credit of a purchase to the ads a person touched in the days before it, to the cent.

All touches of one ad by one person on one day count as one, at the time of the first: a person who sees an ad all day long
gives no more rows than one who sees it once. Touches meet purchases in a join on person and day, a purchase being listed
under each day it looks back on, so there is no range join and hot persons are split like any hot key. Purchases and touches
without a person cannot be told apart and get no credit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.ad_marts import money_sum
from martloom.operators.shares import shared_out

LOOK_BACK_DAYS = 7
HALVED_AFTER_DAYS = 2
# First and last touch of three or more get this many times what all the others get together.
ENDS = 2


def touch_days(touches: DataFrame) -> DataFrame:
    """One row per person, ad and day, with the time and id of the day's first touch."""
    known = touches.where("person_id IS NOT NULL AND ad_id IS NOT NULL AND touched_at IS NOT NULL")
    day = F.to_date("touched_at").alias("touch_day")
    first = F.min(F.struct("touched_at", "touch_id")).alias("touch")
    return known.groupBy("person_id", "ad_id", day).agg(first)


def weights(look_back_days: int, halved_after_days: int) -> dict[str, Column]:
    """The weight of a touch by model, in whole numbers: of a touch at place _p of _n, _age days before the purchase."""
    p, n = F.col("_p"), F.col("_n")
    ends = (p == 1) | (p == n)
    halvings = F.floor((F.lit(look_back_days) - F.col("_age")) / F.lit(halved_after_days)).cast("int")
    return {
        "first_credit": (p == 1).cast("int"),
        "last_credit": (p == n).cast("int"),
        "linear_credit": F.lit(1),
        "position_credit": F.when((n > 2) & ends, ENDS * (n - 2)).otherwise(1),
        "decay_credit": F.expr("shiftleft(1L, _halvings)"),
        "_halvings": halvings,
    }


def attribution_credits(
    touches: DataFrame, purchases: DataFrame, look_back_days: int = LOOK_BACK_DAYS,
    halved_after_days: int = HALVED_AFTER_DAYS,
) -> DataFrame:
    """For each purchase and each ad and day of touches in the days before it, the purchase's value shared out in five ways:
    all to the first or the last touch, equally, by position (first and last get twice what the others get together, two
    get half each), and by age, halved after so many whole days.

    touches: person_id, ad_id, touched_at, touch_id. purchases: purchase_id (unique), person_id, bought_at, value. A touch
    counts if it comes before the purchase and not more than ``look_back_days`` times 24 hours before. Purchases without a
    touch are left out. The credits of a purchase add up to its value.
    """
    made = weights(look_back_days, halved_after_days)
    bought = purchases.where("person_id IS NOT NULL AND value IS NOT NULL").withColumn("day", F.to_date("bought_at"))
    back = F.explode(F.sequence(F.lit(0), F.lit(look_back_days))).alias("_back")
    listed = bought.select("*", back).withColumn("touch_day", F.expr("date_sub(day, _back)")).drop("_back")
    at = F.col("touch.touched_at")
    pairs = listed.join(touch_days(touches), ["person_id", "touch_day"]).where(
        (at < F.col("bought_at")) & (at >= F.col("bought_at") - F.expr(f"INTERVAL {look_back_days} DAYS"))
    )
    purchase = Window.partitionBy("purchase_id")
    # No more columns than credits need: a sort holds all of a task's pairs.
    placed = pairs.select(
        "purchase_id", "ad_id", "day", "value", "touch", F.row_number().over(purchase.orderBy("touch", "ad_id")).alias("_p"),
        F.count("*").over(purchase).cast("int").alias("_n"), F.expr("EXTRACT(DAY FROM bought_at - touch.touched_at)").alias("_age"),
    ).withColumn("_halvings", made.pop("_halvings"))
    credited = shared_out(placed, "value", made, ["purchase_id"], ["_p"], ["purchase_id", "ad_id", "day", "touch"])
    return credited.select("purchase_id", "ad_id", "day", at.alias("touched_at"), *made)


CREDITS = ("first_credit", "last_credit", "linear_credit", "position_credit", "decay_credit")


def attributed_daily(credits: DataFrame, ad: DataFrame, adset: DataFrame, campaign: DataFrame) -> DataFrame:
    """Credits by day of purchase, campaign and ad set."""
    by_ad = credits.groupBy("ad_id", "day").agg(*[money_sum(c).alias(c) for c in CREDITS])
    parents = (
        ad.select("ad_id", "adset_key")
        .join(adset.select("adset_key", "ad_set_id", "campaign_key"), "adset_key")
        .join(campaign.select("campaign_key", "campaign_id"), "campaign_key")
    )
    return by_ad.join(parents, "ad_id").groupBy(F.col("day").alias("date"), "campaign_id", "ad_set_id").agg(
        *[money_sum(c).alias(c) for c in CREDITS]
    )
