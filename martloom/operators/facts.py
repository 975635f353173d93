"""Fact tables.

Every fact takes ``after``: only source rows whose time column lies above it are built (the incremental load). The
filter sits on the source, ahead of all joins.

Joins are written so that a hot key never needs one task: plain key joins with the large side on the left, which
Spark's skew-join rule splits, and aggregates that combine rows before they are shuffled.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.keys import packed, surrogate_key, unpacked
from martloom.functions.measures import ratio_or_zero
from martloom.functions.rules import SOURCE_SYSTEM
from martloom.operators.as_of import with_version
from martloom.operators.common import current, days_table, moment, stamped, with_member_key

AUDIT = ("dw_insert_date", "dw_update_date")
BEGINNING = "0001-01-01"  # the day a first version is taken to begin on


def newer(df: DataFrame, column: str, after) -> DataFrame:
    """Rows above the high-water mark (a date or a time); all rows without one."""
    if after is None:
        return df
    return df.where(F.col(column) > (moment(after) if isinstance(after, datetime) else F.lit(after)))


def lines_of(order_items: DataFrame, orders: DataFrame, after) -> DataFrame:
    """Lines that an incremental load may need.

    Lines carry no time: those of the new orders are found by id. Spark broadcasts the ids if they turn out few.
    """
    if after is None:
        return order_items
    ids = newer(orders, "order_date", after).select(F.col("order_id").cast("bigint"))
    return order_items.join(ids, "order_id", "left_semi")


def dated(df: DataFrame, day, calendar: DataFrame, key: str) -> DataFrame:
    """Keep rows whose day is in the calendar, with its date key."""
    days = days_table(calendar, F.col("full_date").alias("_day"), F.col("date_key").alias(key))
    return df.join(days, day == F.col("_day"))


def _keyed_orders(orders, customer, calendar, status, payment_method, after) -> DataFrame:
    """Orders with their four dimension keys, resolved once per order and not once per line."""
    found = dated(newer(orders, "order_date", after), F.to_date("order_date"), calendar, "order_date_key")
    found = with_member_key(found, "status", "status_key", status, "status_id")
    found = with_member_key(found, "payment_method", "payment_method_key", payment_method, "payment_method_id")
    return found.join(current(customer).select("customer_id", _short("customer_key")), "customer_id")


# Keys that are looked up before rows are shuffled again travel as bytes, half as long as their text.
def _short(key: str) -> Column:
    return packed(F.col(key).cast("string")).alias(key)


def _long(df: DataFrame, *keys: str) -> DataFrame:
    return df.withColumns({key: unpacked(key) for key in keys})


def fact_sales(
    order_items: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    product: DataFrame,
    calendar: DataFrame,
    status: DataFrame | None = None,
    payment_method: DataFrame | None = None,
    after: datetime | None = None,
    run_ts: datetime | None = None,
) -> DataFrame:
    """One row per order line.

    A full build looks products up first, so the result stays partitioned by order. An incremental load joins the few
    new orders first, so only their lines go on to the product lookup.
    """
    products = current(product).select("product_id", _short("product_key"))
    headers = _keyed_orders(orders, customer, calendar, status, payment_method, after)
    if after is None:
        lines = order_items.join(products, "product_id").join(headers, "order_id")
    else:
        lines = lines_of(order_items, orders, after).join(headers, "order_id").join(products, "product_id")
    return _sale_rows(lines, run_ts)


def fact_sales_of_pairs(
    pairs: DataFrame, customer: DataFrame, product: DataFrame, calendar: DataFrame, run_ts: datetime | None = None
) -> DataFrame:
    """The same rows from lines that stand beside the columns of their order already."""
    keyed = _keyed_orders(pairs, customer, calendar, None, None, None)
    return _sale_rows(keyed.join(current(product).select("product_id", _short("product_key")), "product_id"), run_ts)


def _sale_rows(lines: DataFrame, run_ts: datetime | None) -> DataFrame:
    out = _long(lines, "customer_key", "product_key").select(
        surrogate_key("order_id", "order_item_id").alias("sales_key"),
        *"order_id order_item_id customer_key product_key order_date_key status_key payment_method_key".split(),
        *"quantity unit_price line_item_tax line_item_shipping line_item_discount line_item_total".split(),
        *"order_date shipping_address shipping_city shipping_state shipping_zip shipping_country".split(),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
    )
    return stamped(out, run_ts, *AUDIT)


def order_item_counts(order_items: DataFrame) -> DataFrame:
    return order_items.groupBy("order_id").agg(F.count("*").alias("item_count"))


def fact_order_summary(
    orders: DataFrame,
    order_items: DataFrame,
    customer: DataFrame,
    calendar: DataFrame,
    status: DataFrame | None = None,
    payment_method: DataFrame | None = None,
    after: datetime | None = None,
    run_ts: datetime | None = None,
) -> DataFrame:
    """One row per order that has at least one line."""
    headers = _keyed_orders(orders, customer, calendar, status, payment_method, after)
    counts = order_item_counts(lines_of(order_items, orders, after))
    out = _long(headers.join(counts, "order_id"), "customer_key").select(
        surrogate_key("order_id").alias("order_summary_key"),
        *"order_id customer_key order_date_key status_key payment_method_key".split(),
        *"total_amount tax_amount shipping_amount discount_amount grand_total".split(),
        F.col("item_count").alias("order_item_count"),
        "order_date",
        F.lit(SOURCE_SYSTEM).alias("source_system"),
    )
    return stamped(out, run_ts, *AUDIT)


def fact_inventory(
    inventory: DataFrame,
    product: DataFrame,
    calendar: DataFrame,
    warehouse: DataFrame | None = None,
    after: datetime | None = None,
    run_ts: datetime | None = None,
) -> DataFrame:
    """One row per stock record."""
    stock = dated(newer(inventory, "last_restocked", after), F.to_date("last_restocked"), calendar, "date_key")
    stock = with_member_key(stock, "warehouse_location", "warehouse_key", warehouse, "warehouse_id")
    out = stock.join(current(product).select("product_id", "product_key"), "product_id").select(
        surrogate_key("inventory_id").alias("inventory_key"),
        *"inventory_id product_key warehouse_key date_key quantity_available reorder_level last_restocked".split(),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
    )
    return stamped(out, run_ts, *AUDIT)


def fact_ad_performance(
    insights: DataFrame,
    ad: DataFrame,
    calendar: DataFrame,
    after=None,
    run_ts: datetime | None = None,
) -> DataFrame:
    """One row per ad and day, with four ratios."""
    known = dated(newer(insights, "date", after), F.col("date"), calendar, "date_key")
    known = known.join(current(ad).select("ad_id", "ad_key", "adset_key"), "ad_id")
    out = known.select(
        surrogate_key("performance_id").alias("ad_performance_key"),
        *"performance_id ad_key adset_key date_key ad_id date impressions clicks ctr spend conversions".split(),
        *"conversion_value cost_per_conversion reach frequency unique_clicks".split(),
        ratio_or_zero("clicks", "impressions", 100).alias("calculated_ctr"),
        ratio_or_zero("spend", "clicks").alias("cost_per_click"),
        ratio_or_zero("conversion_value", "conversions").alias("avg_conversion_value"),
        F.when(F.col("conversion_value") > 0, ratio_or_zero("conversion_value", "spend")).otherwise(0.0).alias("roas"),
    )
    return stamped(out, run_ts, *AUDIT)


COUNTS = ("impressions", "clicks", "conversions", "reach", "unique_clicks")
AMOUNTS = ("spend", "conversion_value")


def totals(*names: str) -> list:
    """Sums under their own names; amounts keep two decimals however often they are summed again."""
    return [
        F.sum(name).cast("decimal(28,2)" if name in AMOUNTS else "bigint").alias(name) for name in names
    ]


def ad_daily_totals(insights: DataFrame) -> DataFrame:
    """Insights summed by ad and day: at most one row per day is left of even the busiest ad."""
    return insights.groupBy("ad_id", "date").agg(*totals(*COUNTS, *AMOUNTS))


def fact_adset_performance(
    insights: DataFrame,
    ads: DataFrame,
    adset: DataFrame,
    calendar: DataFrame,
    after=None,
    run_ts: datetime | None = None,
) -> DataFrame:
    """One row per ad set and day: sums by ad and day, then by ad set and day. ``after`` is applied to the insights."""
    by_ad = dated(ad_daily_totals(newer(insights, "date", after)), F.col("date"), calendar, "date_key")
    by_ad_set = by_ad.join(ads.select("ad_id", "ad_set_id"), "ad_id").groupBy("ad_set_id", "date", "date_key").agg(
        *totals(*COUNTS, *AMOUNTS)
    )
    known = by_ad_set.join(current(adset).select("ad_set_id", "adset_key"), "ad_set_id")
    out = known.select(
        surrogate_key("ad_set_id", "date").alias("adset_performance_key"),
        *"adset_key date_key ad_set_id date impressions clicks".split(),
        ratio_or_zero("clicks", "impressions", 100).alias("ctr"),
        *"spend conversions conversion_value".split(),
        ratio_or_zero("spend", "conversions").alias("cost_per_conversion"),
        "reach",
        ratio_or_zero("impressions", "reach").alias("frequency"),
        "unique_clicks",
        ratio_or_zero("conversions", "clicks", 100).alias("conversion_rate"),
        ratio_or_zero("conversion_value", "spend").alias("roas"),
    )
    return stamped(out, run_ts, *AUDIT)


def fact_campaign_spend(
    spend: DataFrame,
    campaign: DataFrame,
    adset: DataFrame,
    calendar: DataFrame,
    after=None,
    run_ts: datetime | None = None,
) -> DataFrame:
    """One row per spend record; its ad set may be unknown, its campaign may not."""
    known = dated(newer(spend, "date", after), F.col("date"), calendar, "date_key")
    known = known.join(current(campaign).select("campaign_id", "campaign_key"), "campaign_id")
    known = known.join(current(adset).select("ad_set_id", "adset_key"), "ad_set_id", "left")
    out = known.select(
        surrogate_key("spend_id").alias("campaign_spend_key"),
        *"spend_id campaign_key adset_key date_key campaign_id ad_set_id date".split(),
        *"daily_budget amount_spent remaining_budget".split(),
        ratio_or_zero("amount_spent", "daily_budget", 100).alias("budget_utilization_percentage"),
    )
    return stamped(out, run_ts, *AUDIT)


# Table name -> unique key, time column of the incremental load, and the date key its months are taken from.
LOADS = {
    "fact_sales": ("sales_key", "order_date", "order_date_key"),
    "fact_order_summary": ("order_summary_key", "order_date", "order_date_key"),
    "fact_inventory": ("inventory_key", "last_restocked", "date_key"),
    "fact_ad_performance": ("ad_performance_key", "date", "date_key"),
    "fact_adset_performance": ("adset_performance_key", "date", "date_key"),
    "fact_campaign_spend": ("campaign_spend_key", "date", "date_key"),
}


def fact_sales_as_of(order_items: DataFrame, orders: DataFrame, product_history: DataFrame) -> DataFrame:
    """One row per order line with the version of its product that was valid on the day of the order.

    Before its first version a product is taken as its first version has it: nothing earlier is known. Lines of products
    without a history are left out, as are lines without an order.
    """
    first = F.row_number().over(Window.partitionBy("product_id").orderBy("effective_date")) == 1
    begins = F.when(first, F.lit(BEGINNING).cast("date")).otherwise(F.col("effective_date"))
    versions = product_history.select(
        "product_id", begins.alias("begins"), F.col("version_key").alias("product_version_key"),
        F.col("price").alias("list_price"), "cost", F.col("effective_date").alias("version_since"),
    )
    days = orders.select("order_id", F.to_date("order_date").alias("order_day"))
    lines = order_items.select(
        *"order_id order_item_id product_id quantity unit_price line_item_total".split()
    ).join(days, "order_id")
    found = with_version(
        lines, versions, "product_id", "order_day", "begins", ["product_version_key", "list_price", "cost", "version_since"]
    )
    profit = F.col("line_item_total") - F.col("cost") * F.col("quantity").cast("decimal(10,0)")
    return found.select(
        surrogate_key("order_id", "order_item_id").alias("sales_key"),
        *"order_id order_item_id product_id product_version_key order_day quantity unit_price line_item_total".split(),
        *"list_price cost version_since".split(),
        profit.cast("decimal(28,2)").alias("line_profit"),
    )
