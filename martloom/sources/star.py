"""The ten input tables derived from a star-schema sample (orders, lineitem, part, customer, ..., events).

Attributes the sample lacks are invented from its ids; every such stand-in is marked with (*) in the comments. All
expressions are exact (integers and decimals), so another SQL engine gives the same values.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Given, so that no job has to open files just to learn them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
                " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
                " l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


Raw = Callable[[str], DataFrame]


CENT = "CAST(0.01 AS DECIMAL(3,2))"
BASIS = "CAST(0.0001 AS DECIMAL(5,4))"


def cents(amount: str) -> str:
    """Whole cents, as DECIMAL(18,2)."""
    return f"CAST(CAST({amount} AS DECIMAL(18,0)) * {CENT} AS DECIMAL(18,2))"


def hundredths(value: str) -> str:
    """A double with two decimals as a whole number of hundredths."""
    return f"CAST(floor({value} * 100 + 0.5D) AS BIGINT)"


def customers(raw: Raw) -> DataFrame:
    """Region is the country, nation the state, market segment the city (*); contact details from the id (*)."""
    place = raw("customer").join(
        raw("nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).join(raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return place.selectExpr(
        "c_custkey AS customer_id",
        "substring_index(c_name, '#', 1) AS first_name",
        "substring_index(c_name, '#', -1) AS last_name",
        "concat('c', c_custkey, '@example.com') AS email",
        "concat('555-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) AS phone",
        "TIMESTAMP_NTZ '1994-01-01 00:00:00' AS created_at",
        "TIMESTAMP_NTZ '1994-06-01 00:00:00' AS updated_at",
        "concat(c_custkey, ' Main St') AS address",
        "c_mktsegment AS city",
        "n_name AS state",
        "lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') AS zip_code",
        "r_name AS country",
    )


def products(raw: Raw) -> DataFrame:
    """Cost is 1.6 times the list price (*), which gives every margin class."""
    return raw("part").selectExpr(
        "p_partkey AS product_id",
        "p_name AS product_name",
        "concat(p_name, ' ', p_type) AS description",
        "p_type AS category",
        "CAST(p_retailprice AS DECIMAL(18,2)) AS price",
        "CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(1.60 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS cost",
        "concat('SKU-', p_size, '-', p_partkey) AS sku",
        "TIMESTAMP_NTZ '1994-01-01 00:00:00' AS created_at",
        "TIMESTAMP_NTZ '1994-06-01 00:00:00' AS updated_at",
        "p_size > 2 AS is_active",
        "p_brand AS vendor",
    )


def orders(raw: Raw) -> DataFrame:
    """Ship-to nation from the order id, missing for every seventh order (*); priority is the payment method (*);
    tax, shipping and discount are shares of the total (*)."""
    total = "CAST(o_totalprice AS DECIMAL(18,2))"
    staged = raw("orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "o_orderdate AS order_date",
        "o_orderstatus AS status",
        "o_orderpriority AS payment_method",
        f"{total} AS grand_total",
        f"CAST({total} * CAST(0.08 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS tax_amount",
        "CAST(CASE WHEN o_orderkey % 3 = 0 THEN 10 ELSE 0 END AS DECIMAL(18,2)) AS shipping_amount",
        f"CAST({total} * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS discount_amount",
        "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 25 AS INT) END AS ship_nation",
    )
    shipped = staged.join(
        raw("nation"), F.col("ship_nation") == F.col("n_nationkey"), "left"
    ).join(raw("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return shipped.selectExpr(
        "order_id",
        "customer_id",
        "order_date",
        "CAST(grand_total - tax_amount - shipping_amount + discount_amount AS DECIMAL(18,2)) AS total_amount",
        "status",
        "concat(order_id, ' ', n_name) AS shipping_address",
        "concat(n_name, '-', order_id % 4) AS shipping_city",
        "n_name AS shipping_state",
        "CASE WHEN n_name IS NOT NULL THEN lpad(CAST(order_id % 100000 AS STRING), 5, '0') END AS shipping_zip",
        "r_name AS shipping_country",
        "payment_method",
        "tax_amount",
        "shipping_amount",
        "discount_amount",
        "grand_total",
    )


def order_items(raw: Raw) -> DataFrame:
    """One row per lineitem; order and line number do not identify a line, so five columns make its id.

    Amounts are worked out in whole cents and rounded half up; decimals are made once, at the end.
    """
    price, off, tax = hundredths("l_extendedprice"), hundredths("l_discount"), hundredths("l_tax")
    priced = raw("lineitem").selectExpr(
        "*", f"{price} AS price", f"{off} AS off", f"{tax} AS tax", "CAST(l_quantity AS BIGINT) AS units"
    )
    return priced.selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE)) AS order_item_id",
        "l_orderkey AS order_id",
        "l_partkey AS product_id",
        "CAST(units AS INT) AS quantity",
        cents("price DIV units") + " AS unit_price",
        cents("(price * (100 - off) * tax + 5000) DIV 10000") + " AS line_item_tax",
        "CAST(0 AS DECIMAL(18,2)) AS line_item_shipping",
        cents("(price * off + 50) DIV 100") + " AS line_item_discount",
        cents("(price * (100 - off) * (100 + tax) + 5000) DIV 10000") + " AS line_item_total",
    )


def inventory(raw: Raw) -> DataFrame:
    """One stock record per part and supplier that shipped it; stock level from the shipped quantity (*)."""
    shipped = (
        raw("lineitem")
        .groupBy("l_partkey", "l_suppkey")
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("shipped"), F.max("l_shipdate").alias("last_ship"))
    )
    return (
        shipped.join(raw("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(raw("part"), F.col("l_partkey") == F.col("p_partkey"))
        .selectExpr(
            "concat_ws('-', l_partkey, l_suppkey) AS inventory_id",
            "l_partkey AS product_id",
            "CAST(shipped % 200 AS INT) AS quantity_available",
            "p_size AS reorder_level",
            "last_ship AS last_restocked",
            "s_name AS warehouse_location",
        )
    )


# Users of the events table stand for ads (*); 50 ad sets and 10 campaigns group them (*).
AD_SET = "user_id % 50"
CAMPAIGN = "ad_set_id % 10"


def campaigns(raw: Raw) -> DataFrame:
    ids = raw("events").selectExpr(f"({AD_SET}) % 10 AS campaign_id").distinct()
    return ids.selectExpr(
        "campaign_id",
        "concat('Campaign ', campaign_id) AS campaign_name",
        "CASE campaign_id % 3 WHEN 0 THEN 'CONVERSIONS' WHEN 1 THEN 'REACH' ELSE 'TRAFFIC' END AS objective",
        "CASE campaign_id % 4 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'PAUSED' WHEN 2 THEN 'COMPLETED' ELSE 'ARCHIVED' END"
        " AS status",
        "CASE WHEN campaign_id % 2 = 0 THEN 'DAILY' ELSE 'LIFETIME' END AS budget_type",
        "CASE WHEN campaign_id % 2 = 0 THEN CAST(100 + 10 * campaign_id AS DECIMAL(18,2)) END AS daily_budget",
        "CASE WHEN campaign_id % 2 = 1 THEN CAST(5000 + 100 * campaign_id AS DECIMAL(18,2)) END AS lifetime_budget",
        "DATE '2024-01-01' AS start_date",
        "DATE '2024-03-31' AS end_date",
        "TIMESTAMP_NTZ '2023-12-15 09:00:00' AS created_at",
        "TIMESTAMP_NTZ '2023-12-20 09:00:00' AS updated_at",
    )


def adsets(raw: Raw) -> DataFrame:
    ids = raw("events").selectExpr(f"{AD_SET} AS ad_set_id").distinct()
    return ids.selectExpr(
        "ad_set_id",
        f"{CAMPAIGN} AS campaign_id",
        "concat('Ad set ', ad_set_id) AS ad_set_name",
        "CAST(16 + (ad_set_id * 7) % 45 AS INT) AS targeting_age_min",
        "CAST(16 + (ad_set_id * 7) % 45 + 5 + ad_set_id % 20 AS INT) AS targeting_age_max",
        "CASE ad_set_id % 4 WHEN 0 THEN 'ALL' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'MALE' END AS targeting_gender",
        "CASE WHEN ad_set_id % 2 = 0 THEN 'New York,Boston' ELSE 'Austin,Denver' END AS targeting_locations",
        "CASE WHEN ad_set_id % 6 < 5 THEN concat('Interest ', ad_set_id % 6, ',Shopping') END AS targeting_interests",
        "CASE WHEN ad_set_id % 2 = 0 THEN 'LOWEST_COST' ELSE 'COST_CAP' END AS bid_strategy",
        "CAST(5 + ad_set_id AS DECIMAL(18,2)) AS bid_amount",
        "CAST(20 + 10 * (ad_set_id % 20) AS DECIMAL(18,2)) AS daily_budget",
        "DATE '2024-01-01' AS start_date",
        "DATE '2024-03-31' AS end_date",
        "CASE ad_set_id % 3 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'PAUSED' ELSE 'DELETED' END AS status",
    )


def ads(raw: Raw) -> DataFrame:
    ids = raw("events").selectExpr("user_id AS ad_id").distinct()
    return ids.selectExpr(
        "ad_id",
        "ad_id % 50 AS ad_set_id",
        "concat('Ad ', ad_id) AS ad_name",
        "CASE ad_id % 3 WHEN 0 THEN 'IMAGE' WHEN 1 THEN 'VIDEO' ELSE 'CAROUSEL' END AS ad_type",
        "concat('Text ', ad_id) AS creative_primary_text",
        "concat('Headline ', ad_id) AS creative_headline",
        "concat('Description ', ad_id) AS creative_description",
        "concat('example.com/', ad_id) AS display_url",
        "concat('https://www.example.com/', ad_id) AS destination_url",
        "CASE ad_id % 4 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'PAUSED' WHEN 2 THEN 'IN_REVIEW' ELSE 'ARCHIVED' END"
        " AS status",
        "TIMESTAMP_NTZ '2023-12-16 10:00:00' AS created_at",
        "TIMESTAMP_NTZ '2023-12-21 10:00:00' AS updated_at",
    )


def event_counts() -> list[Column]:
    """Aggregates of the events of one ad and day.

    Distinct hours with a click are bits of one integer, so no second, per-hour grouping is needed.
    """

    def count_of(kind: str) -> Column:
        return F.count_if(F.col("event_type") == kind)

    def value_of(*kinds: str) -> Column:
        value = F.when(F.col("event_type").isin(*kinds), F.col("value").cast("decimal(18,2)"))
        return F.coalesce(F.sum(value).cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))

    click_hour = F.when(F.col("event_type") == "click", F.expr("shiftleft(1, hour(ts))"))
    return [
        count_of("view").alias("views"),
        count_of("click").alias("clicks"),
        value_of("click", "view").alias("spend"),
        count_of("purchase").alias("conversions"),
        value_of("purchase").alias("conversion_value"),
        F.coalesce(F.bit_count(F.bit_or(click_hour)), F.lit(0)).cast("bigint").alias("unique_clicks"),
    ]


def daily_counts(events: DataFrame) -> DataFrame:
    """Events counted by ad and day: one shuffle of partial sums, also when one ad holds most events."""
    return events.groupBy(F.col("user_id").alias("ad_id"), F.to_date("ts").alias("date")).agg(*event_counts())


def insight_columns(counted: DataFrame) -> DataFrame:
    """Insight records from daily counts; impressions and reach are multiples of the counts (*)."""
    shown = counted.selectExpr("*", "120 * views + 20 * clicks AS impressions").selectExpr(
        "*", "impressions * 8 DIV 10 AS reach"
    )
    per_conversion = cents("CASE WHEN conversions > 0 THEN CAST(spend * 100 AS BIGINT) DIV conversions ELSE 0 END")
    return shown.selectExpr(
        "concat_ws('-', ad_id, date) AS performance_id",
        "ad_id",
        "date",
        "impressions",
        "clicks",
        "CAST((CASE WHEN impressions > 0 THEN CAST(clicks * 1000000 DIV impressions AS DECIMAL(18,0)) ELSE 0 END)"
        f" * {BASIS} AS DECIMAL(9,4)) AS ctr",
        "spend",
        "conversions",
        "conversion_value",
        f"{per_conversion} AS cost_per_conversion",
        "reach",
        "CAST((CASE WHEN reach > 0 THEN CAST(impressions * 10000 DIV reach AS DECIMAL(18,0)) ELSE 0 END)"
        f" * {BASIS} AS DECIMAL(9,4)) AS frequency",
        "unique_clicks",
    )


def ad_insights(raw: Raw) -> DataFrame:
    return insight_columns(daily_counts(raw("events")))


def ad_spend(raw: Raw) -> DataFrame:
    """Spend by ad set and day; some ad sets have no budget (*)."""
    spend = F.when(F.col("event_type").isin("click", "view"), F.col("value").cast("decimal(18,2)"))
    spent = (
        raw("events")
        .groupBy(F.expr(AD_SET).alias("ad_set_id"), F.to_date("ts").alias("date"))
        .agg(F.coalesce(F.sum(spend).cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")).alias("amount_spent"))
    )
    budget = "CAST(CASE WHEN ad_set_id % 13 = 0 THEN 0 ELSE 20 + 10 * (ad_set_id % 20) END AS DECIMAL(18,2))"
    return spent.selectExpr(
        "concat_ws('-', ad_set_id, date) AS spend_id",
        f"{CAMPAIGN} AS campaign_id",
        "ad_set_id",
        "date",
        f"{budget} AS daily_budget",
        "amount_spent",
        f"CAST({budget} - amount_spent AS DECIMAL(18,2)) AS remaining_budget",
    )


BUILDERS = {
    "Customers": customers,
    "Products": products,
    "Inventory": inventory,
    "Orders": orders,
    "Order_Items": order_items,
    "Campaigns": campaigns,
    "AdSets": adsets,
    "Ads": ads,
    "Ad_Insights": ad_insights,
    "Ad_Spend": ad_spend,
}


class StarTables(Mapping):
    """All ten inputs, by table name; each is only set up when it is asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.opened: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A table of the sample itself."""
        if name not in self.opened:
            self.opened[name] = self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")
        return self.opened[name]

    def __getitem__(self, name: str) -> DataFrame:
        return BUILDERS[name](self.raw)

    def __iter__(self):
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)


# How products and campaigns stood on three days (*): prices and budgets that change, some that change back, rows that
# are new and rows that are gone.
PRODUCT_DAYS = (date(1996, 1, 1), date(1998, 1, 1), date(2000, 1, 1))
CAMPAIGN_DAYS = (date(2024, 1, 1), date(2024, 1, 11), date(2024, 1, 21))


def product_snapshot(raw: Raw, nth: int) -> DataFrame:
    """Products of the nth day: a quarter costs a tenth more on the second day and what it did again on the third, another
    quarter is cheaper from the third on. A tenth is not there before the second day, another not after it."""
    factors = ("CAST(1 AS DECIMAL(4,2))", "CAST(CASE product_id % 4 WHEN 1 THEN 1.10 ELSE 1 END AS DECIMAL(4,2))",
               "CAST(CASE product_id % 4 WHEN 2 THEN 0.95 ELSE 1 END AS DECIMAL(4,2))")
    there = ("product_id % 10 <> 3", "true", "product_id % 10 <> 7")
    return products(raw).where(there[nth]).selectExpr(
        "product_id", "product_name", "category", f"CAST(price * {factors[nth]} AS DECIMAL(18,2)) AS price", "cost"
    )


def campaign_snapshot(raw: Raw, nth: int) -> DataFrame:
    """Campaigns of the nth day: a third has a fifth more budget on the second day only, a fifth has it from the third on."""
    more = ("false", "campaign_id % 3 = 0", "campaign_id % 5 = 4")
    factor = f"CAST(CASE WHEN {more[nth]} THEN 1.20 ELSE 1 END AS DECIMAL(4,2))"
    return campaigns(raw).selectExpr(
        "campaign_id", "campaign_name", "budget_type",
        *[f"CAST({b} * {factor} AS DECIMAL(18,2)) AS {b}" for b in ("daily_budget", "lifetime_budget")],
    )


def touches(raw: Raw) -> DataFrame:
    """Clicks and views of ads. Three neighbouring ads are seen by one person (*)."""
    return raw("events").where("event_type IN ('click', 'view')").selectExpr(
        "user_id DIV 3 AS person_id", "user_id AS ad_id", "ts AS touched_at", "event_id AS touch_id"
    )


def purchases(raw: Raw) -> DataFrame:
    return raw("events").where("event_type = 'purchase'").selectExpr(
        "event_id AS purchase_id", "user_id DIV 3 AS person_id", "ts AS bought_at", "CAST(value AS DECIMAL(18,2)) AS value"
    )


# The time columns that facts join to the calendar.
DATED = (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))


def date_bounds(raw: Raw, *tables: str) -> DataFrame:
    """One row: first day of the data (of some tables or all), the day after the last one, and the last day with an order."""
    found = None
    for name, column in DATED:
        if tables and name not in tables:
            continue
        part = raw(name).agg(
            F.lit(name).alias("name"), F.min(column).alias("first"), F.max(column).alias("last")
        )
        found = part if found is None else found.union(part)
    return found.agg(
        F.to_date(F.min("first")).alias("start_date"),
        F.date_add(F.to_date(F.max("last")), 1).alias("end_date"),
        F.to_date(F.max(F.when(F.col("name") == "orders", F.col("last")))).alias("last_order"),
    )


def report_day(raw: Raw) -> DataFrame:
    """One row: the day reports are made for, the one after the last order."""
    return raw("orders").agg(F.date_add(F.to_date(F.max("o_orderdate")), 1).alias("day"))


@dataclass(frozen=True)
class RunDates:
    """Dates a run is told: calendar range (end not included) and the day the reports are made for."""

    start: date
    end: date
    as_of: date


def run_dates(raw: Raw) -> RunDates:
    """Run dates read from the data: one row of three scalars."""
    bounds = date_bounds(raw).first()
    return RunDates(bounds["start_date"], bounds["end_date"], bounds["last_order"] + timedelta(days=1))
