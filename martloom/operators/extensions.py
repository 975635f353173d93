"""Tables that are described alongside the models but belong to none of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.measures import ratio_or_null
from martloom.operators.ad_marts import ad_parents, money_sum, ratios
from martloom.operators.attribution import CREDITS, attributed_daily
from martloom.operators.facts import totals
from martloom.operators.shares import shared_out


def customer_ltv(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """First order and lifetime revenue of every customer; 0 for one who never ordered."""
    bought = orders.groupBy("customer_id").agg(
        F.to_date(F.min("order_date")).alias("first_order_date"), money_sum("grand_total").alias("total")
    )
    return customers.select("customer_id").join(bought, "customer_id", "left").select(
        "customer_id",
        "first_order_date",
        F.coalesce("total", F.lit(0).cast("decimal(28,2)")).alias("total_ltv"),
    )


def orders_with_profit(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue and profit per order, from its lines."""
    costed = order_items.join(products.select("product_id", "cost"), "product_id")
    cost = F.col("cost") * F.col("quantity").cast("decimal(10,0)")
    by_order = costed.groupBy("order_id").agg(
        money_sum("line_item_total").alias("total_revenue"),
        F.sum(F.col("line_item_total") - cost).cast("decimal(28,2)").alias("total_profit"),
    )
    return orders.select("order_id", "customer_id", "order_date").join(by_order, "order_id")


def _ad_days(performance: DataFrame, ad: DataFrame, adset: DataFrame, campaign: DataFrame) -> DataFrame:
    """Sums by ad and day with the keys of ad set and campaign."""
    sums = ("impressions", "clicks", "spend", "conversions", "conversion_value")
    daily = performance.groupBy("ad_key", "ad_id", "date").agg(*totals(*sums))
    return daily.join(ad_parents(ad, adset, campaign), "ad_key")


def ads_daily(performance: DataFrame, ad: DataFrame, adset: DataFrame, campaign: DataFrame) -> DataFrame:
    """Spend, views and clicks per ad and day with the cost ratios."""
    days = _ad_days(performance, ad, adset, campaign)
    return days.join(campaign.select("campaign_key", "campaign_id"), "campaign_key").select(
        "date", "ad_id", "campaign_id", "spend", "impressions", "clicks", *ratios("cpc", "cpm", "ctr")
    )


def sales_ads_daily(
    performance: DataFrame, summaries: DataFrame, ad: DataFrame, adset: DataFrame, campaign: DataFrame,
    credits: DataFrame | None = None,
) -> DataFrame:
    """Ad spend, conversions and their value per day and ad set, with its part of the shop's revenue of the day.

    The shop's revenue is shared out to the ad sets of the day by their conversions; on a day without any, by their spend;
    without spend, equally. Parts are whole cents and add up to the revenue, so they can be summed over ad sets, unlike
    ``store_revenue`` itself, which each row of a day repeats. ``credits`` (one row per purchase and ad, as
    ``attribution_credits`` makes them) adds what purchases of the day credit to the ad set; an ad set that only gets
    credit on a day has a row then, too.
    """
    by_ad_set = (
        _ad_days(performance, ad, adset, campaign)
        .groupBy("date", "campaign_key", "adset_key")
        .agg(
            money_sum("spend").alias("total_spend"),
            F.sum("conversions").alias("total_conversions"),
            money_sum("conversion_value").alias("total_attributed_revenue"),
        )
        .join(adset.select("adset_key", "ad_set_id"), "adset_key")
        .join(campaign.select("campaign_key", "campaign_id"), "campaign_key")
        .drop("adset_key", "campaign_key")
    )
    # One row per day.
    shop = summaries.groupBy(F.to_date("order_date").alias("date")).agg(money_sum("grand_total").alias("store_revenue"))
    day = Window.partitionBy("date")
    weight = (
        F.when(F.sum("total_conversions").over(day) > 0, F.col("total_conversions"))
        .when(F.sum("total_spend").over(day) > 0, F.col("total_spend") * 100)
        .otherwise(1)
    )
    dated = by_ad_set.join(F.broadcast(shop), "date", "left").withColumn("_weight", weight)
    found = shared_out(dated, "store_revenue", {"revenue_share": F.col("_weight")}, ["date"], ["ad_set_id"]).drop("_weight")
    columns = "date campaign_id ad_set_id total_spend total_conversions total_attributed_revenue store_revenue".split()
    names = [*columns, "revenue_share"]
    if credits is not None:
        credited = attributed_daily(credits, ad, adset, campaign)
        found = found.drop("store_revenue").join(credited, ["date", "campaign_id", "ad_set_id"], "full")
        found = found.join(F.broadcast(shop), "date", "left")
        names += CREDITS
    amounts = {"total_spend", "total_attributed_revenue", *CREDITS}
    zero = {n: F.lit(0).cast("decimal(28,2)") for n in amounts} | {"total_conversions": F.lit(0).cast("bigint")}
    filled = [F.coalesce(n, zero[n]).alias(n) if n in zero else F.col(n).alias(n) for n in names]
    return found.select(*filled).withColumn("direct_roas", ratio_or_null("revenue_share", "total_spend"))


def acquisition_cost(spend: DataFrame, orders: DataFrame) -> DataFrame:
    """Ad spend per first-time customer, by month. Both sides have one row per month when they meet."""
    spent = spend.groupBy(F.trunc("date", "MONTH").alias("month_start")).agg(
        money_sum("amount_spent").alias("total_spend")
    )
    first = orders.groupBy("customer_id").agg(F.to_date(F.min("order_date")).alias("first_day"))
    gained = first.groupBy(F.trunc("first_day", "MONTH").alias("month_start")).agg(F.count("*").alias("new_customers"))
    return spent.join(gained, "month_start", "full").select(
        "month_start",
        F.coalesce("total_spend", F.lit(0).cast("decimal(28,2)")).alias("total_spend"),
        F.coalesce("new_customers", F.lit(0).cast("bigint")).alias("new_customers"),
    ).withColumn("cac", ratio_or_null("total_spend", "new_customers"))
