"""Every runnable query by name, and its check in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators import (
    ad_marts, attribution, dimensions, distinct, extensions, facts, history, quality, sales_marts, versions,
)
from martloom.operators.incremental import COMPRESSION, FactTable, month_of_key
from martloom.operators.report_order import in_report_order
from martloom.operators.staging import STAGED
from martloom.operators.stored_marts import StoredMart
from martloom.plans import oracle_parts as sql
from martloom.plans.warehouse import DIMENSIONS, FACTS, MARTS, SOURCES, StarWarehouse, Warehouse
from martloom.session import shuffles_dropped, size_shuffles, stored_bytes, tune, work_folder
from martloom.sources import star
from martloom.sources.files import save_table
from martloom.streaming import ads as streams
from martloom.streaming import sales as sales_stream

Query = Callable[[SparkSession, str], DataFrame]

# Limits that split the sample into all classes, which the standard limits do not.
SAMPLE_REVENUE_TIERS = ((2000000, "High"), (1400000, "Medium"))
SAMPLE_HIGH_VALUE, SAMPLE_MEDIUM_VALUE = (3000000, 0.25), (1500000, 0.15)


def over_warehouse(build: Callable[[StarWarehouse], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        warehouse = StarWarehouse(tune(spark), folder)
        size_shuffles(spark, stored_bytes(*[warehouse.inputs.raw(name) for name, _ in star.DATED]))
        return build(warehouse)

    return run


def targeting(w: StarWarehouse) -> DataFrame:
    return ad_marts.targeting_metrics(w["fact_ad_performance"], *w.hierarchy)


def daily_budget(w: StarWarehouse) -> DataFrame:
    return ad_marts.budget_daily(w["fact_campaign_spend"], w["dim_campaign"], w.calendar("budget_utilization"))


def regional(w: StarWarehouse) -> DataFrame:
    return sales_marts.regional_sales(w["fact_sales"], w["dim_customer"], w.calendar("sales_by_region"))


def customers(w: StarWarehouse) -> DataFrame:
    return sales_marts.customer_metrics(w["fact_order_summary"], w["dim_customer"], w.calendar("customer_segmentation"), w.as_of)


STEPS: dict[str, Callable[[StarWarehouse], DataFrame]] = {
    "dim_date_dynamic": lambda w: dimensions.dim_date_dynamic(star.date_bounds(w.inputs.raw)),
    "order_item_counts": lambda w: facts.order_item_counts(w["stg_order_items"]),
    "ad_daily_totals": lambda w: facts.ad_daily_totals(w["stg_ad_insights"]),
    "product_sales": lambda w: sales_marts.product_sales(w["fact_sales"], w["dim_product"], w.calendar("product_performance")),
    "product_inventory": lambda w: sales_marts.product_inventory(w["fact_inventory"], w["dim_product"]),
    "customer_metrics": customers,
    "customer_frequency": lambda w: sales_marts.customer_frequency(customers(w)),
    "product_preferences": lambda w: sales_marts.product_preferences(
        w["fact_sales"], w["fact_order_summary"], w["dim_product"]
    ),
    "regional_sales": regional,
    "regional_previous_period": lambda w: sales_marts.regional_previous_period(regional(w)),
    "inventory_status": lambda w: sales_marts.inventory_status(
        w["fact_inventory"], w["dim_product"], w["dim_warehouse"], w.as_of
    ),
    "sales_velocity": lambda w: sales_marts.sales_velocity(
        w["fact_sales"], w["dim_product"], w.calendar("inventory_analysis"), w.as_of
    ),
    "ad_metrics": lambda w: ad_marts.ad_metrics(w["fact_ad_performance"], *w.hierarchy),
    "targeting_metrics": targeting,
    "targeting_by_age": lambda w: ad_marts.targeting_by_age(targeting(w)),
    "targeting_by_gender": lambda w: ad_marts.targeting_by_gender(targeting(w)),
    "targeting_by_interest": lambda w: ad_marts.targeting_by_interest(targeting(w)),
    "campaign_metrics": lambda w: ad_marts.campaign_metrics(w["fact_ad_performance"], *w.hierarchy, w.calendar("campaign_performance")),
    "campaign_month_spend": lambda w: ad_marts.campaign_month_spend(
        w["fact_campaign_spend"], w["dim_campaign"], w.calendar("budget_utilization")
    ),
    "budget_daily": daily_budget,
    "budget_weekly": lambda w: ad_marts.budget_weekly(daily_budget(w)),
    "budget_monthly": lambda w: ad_marts.budget_monthly(daily_budget(w)),
    "budget_weekday": lambda w: ad_marts.budget_weekday(daily_budget(w)),
    "campaign_conversions": lambda w: ad_marts.campaign_conversions(w["fact_ad_performance"], *w.hierarchy),
    "product_performance_sample_tiers": lambda w: w.mart(
        "product_performance", revenue_tiers=SAMPLE_REVENUE_TIERS
    ),
    "customer_segmentation_sample_limits": lambda w: w.mart(
        "customer_segmentation", high=SAMPLE_HIGH_VALUE, medium=SAMPLE_MEDIUM_VALUE
    ),
}


# Fact -> the input that carries its time column.
TIMED_INPUT = {
    "fact_sales": ("Orders", "order_date"),
    "fact_order_summary": ("Orders", "order_date"),
    "fact_inventory": ("Inventory", "last_restocked"),
    "fact_ad_performance": ("Ad_Insights", "date"),
    "fact_adset_performance": ("Ad_Insights", "date"),
    "fact_campaign_spend": ("Ad_Spend", "date"),
}


def load_twice(w: StarWarehouse, name: str) -> DataFrame:
    """The fact after two loads: the input as it stood halfway through its dates, then all of it."""
    source, column = TIMED_INPUT[name]
    first, last = w.inputs[source].agg(F.to_date(F.min(column)), F.to_date(F.max(column))).first()
    halfway = first + (last - first) / 2
    earlier = Warehouse(
        w.spark, {**w.inputs, source: w.inputs[source].where(F.col(column) < F.lit(halfway))}, w.dates
    )
    key, time_column, date_key = facts.LOADS[name]
    table = FactTable(w.spark, work_folder(w.spark, name), key, time_column, month_of_key(date_key))
    table.load(lambda mark: earlier.fact_in_parts(name, mark))
    table.load(lambda mark: w.fact_in_parts(name, mark))
    return table.read()


# What an earlier look at an input saw: a fifth of its rows had not come yet, and a seventh had another value.
SEEN_EARLIER = {
    "Orders": ("order_id", "grand_total"), "Order_Items": ("order_item_id", "line_item_total"),
    "Inventory": ("inventory_id", "quantity_available"), "Ad_Insights": ("performance_id", "spend"),
    "Ad_Spend": ("spend_id", "amount_spent"),
}


def seen_earlier(rows: DataFrame, table: str) -> DataFrame:
    """The table without late rows, and with values that were corrected since."""
    key, value = SEEN_EARLIER[table]
    code = F.crc32(F.col(key).cast("string").cast("binary"))
    kind = rows.schema[value].dataType.simpleString()
    wrong = F.when(code % 7 == 1, (F.col(value) * 2).cast(kind)).otherwise(F.col(value))
    return rows.where(code % 5 != 0).withColumn(value, wrong)


def load_corrected(w: StarWarehouse, name: str) -> DataFrame:
    """The fact after a load of inputs that were incomplete and partly wrong, and a load of what they are now."""
    source = SOURCES[name]
    tables = [t for t in (source.table, source.details) if t]
    earlier = Warehouse(w.spark, {**w.inputs, **{t: seen_earlier(w.inputs[t], t) for t in tables}}, w.dates)
    key, time_column, date_key = facts.LOADS[name]
    table = FactTable(w.spark, work_folder(w.spark, f"corrected-{name}"), key, time_column, month_of_key(date_key))
    earlier.load_changes(name, table)
    Warehouse(w.spark, w.inputs, w.dates).load_changes(name, table)
    return table.read()


def updated_budget(w: StarWarehouse) -> DataFrame:
    """The stored budget mart after a load of inputs that were incomplete and partly wrong for every third campaign, and a
    load of what they are now."""
    wrong = F.col("campaign_id") % 3 == 0
    spend = w.inputs["Ad_Spend"]
    earlier = seen_earlier(spend.where(wrong), "Ad_Spend").unionByName(spend.where(~wrong))
    table = StoredMart(w.spark, work_folder(w.spark, "budget"), "campaign_key", "full_date")
    for inputs in ({**w.inputs, "Ad_Spend": earlier}, w.inputs):
        Warehouse(w.spark, inputs, w.dates).update_budget(table)
    return table.read()


# The sample's orders lie years before its ads: an order is moved to a day of the ads, three days have none.
SAMPLE_ORDER_DAY = "date_add(DATE'2024-01-01', CAST(order_id % 27 AS INT))"


def ad_credits(w: StarWarehouse) -> DataFrame:
    return attribution.attribution_credits(star.touches(w.inputs.raw), star.purchases(w.inputs.raw))


# Snapshots arrive out of order: the middle one last.
ARRIVAL = (0, 2, 1)


def product_history(w: StarWarehouse) -> DataFrame:
    table = versions.HistoryTable(w.spark, work_folder(w.spark, "product-history"), "product_id", ("price",))
    for nth in ARRIVAL:
        table.load(star.product_snapshot(w.inputs.raw, nth), star.PRODUCT_DAYS[nth])
    return table.read()


def campaign_history(w: StarWarehouse) -> DataFrame:
    folder = work_folder(w.spark, "campaign-history")
    table = versions.HistoryTable(w.spark, folder, "campaign_id", ("daily_budget", "lifetime_budget"))
    for nth in ARRIVAL:
        table.load(star.campaign_snapshot(w.inputs.raw, nth), star.CAMPAIGN_DAYS[nth])
    return table.read()


def quality_report(w: StarWarehouse) -> DataFrame:
    """All checks after a run: dimensions and facts are built once, and their checks read what is stored."""
    return quality.report(w.run(work_folder(w.spark, "tables")).__getitem__, work_folder(w.spark, "checks"))


def event_files(w: StarWarehouse) -> str:
    """A pattern, since a stream takes a folder or a pattern but not the name of one file."""
    return f"{w.inputs.folder}/event[s].parquet"


def streamed_fact(w: StarWarehouse) -> DataFrame:
    return streams.stream_fact_upsert(
        w.spark, event_files(w), work_folder(w.spark, "stream"), w["dim_ad"], w.calendar("fact_ad_performance")
    ).read()


def streamed_insights(w: StarWarehouse) -> DataFrame:
    return streams.stream_ad_daily(w.spark, event_files(w), work_folder(w.spark, "stream")).read()


# Years in which the sample's orders and lines are received in turn.
ARRIVALS = (1998, 9999)


def streamed_sales(w: StarWarehouse) -> DataFrame:
    """The sales fact from streams that are read after each of two arrivals; a line is received a day before its order, with
    it, or a day after it, so that some orders wait for their lines, and some lines for their order, from one to the next."""
    folder = work_folder(w.spark, "stream-sales")
    day = F.col("order_date").cast("timestamp")
    orders = w["stg_orders"].withColumn("received_at", day)
    shift = F.make_dt_interval(days=(F.crc32(F.col("order_item_id").cast("binary")) % 3 - 1).cast("int"))
    lines = w["stg_order_items"].join(orders.select("order_id", day.alias("_day")), "order_id")
    lines = lines.withColumn("received_at", F.col("_day") + shift).drop("_day")

    def stream(name: str, like: DataFrame) -> DataFrame:
        return w.spark.readStream.schema(like.schema).parquet(f"{folder}/{name}")

    last, table = 0, None
    for year in ARRIVALS:
        for name, rows in (("orders", orders), ("lines", lines)):
            arrived = rows.where((F.year("received_at") >= last) & (F.year("received_at") < year))
            with shuffles_dropped(w.spark):
                arrived.write.mode("append").option("compression", COMPRESSION).parquet(f"{folder}/{name}")
        table = sales_stream.stream_fact_sales(
            stream("orders", orders), stream("lines", lines), folder, w["dim_customer"], w["dim_product"], w.calendar("fact_sales")
        )
        last = year
    return table.read()


def regional_reach(w: StarWarehouse) -> DataFrame:
    """The months' bitmaps are stored, and read by all grains."""
    monthly = distinct.regional_bitmaps(w["fact_sales"], w["dim_customer"], w.calendar("sales_by_region"))
    return distinct.regional_reach(save_table(monthly, work_folder(w.spark, "regional-bitmaps")))


STEPS.update({
    "updated_budget_utilization": updated_budget,
    "regional_reach": regional_reach,
    "stream_fact_sales": streamed_sales,
    "dq_not_null": lambda w: quality.all_not_null(w.__getitem__),
    "dq_unique": lambda w: quality.all_unique(w.__getitem__, work_folder(w.spark, "unique")),
    "dq_relationships": lambda w: quality.all_relationships(w.__getitem__),
    "dq_report": quality_report,
    "stream_ad_daily": streamed_insights,
    "stream_fact_upsert": streamed_fact,
    "customer_ltv": lambda w: extensions.customer_ltv(w["stg_customers"], w["stg_orders"]),
    "orders_with_profit": lambda w: extensions.orders_with_profit(
        w["stg_orders"], w["stg_order_items"], w["stg_products"]
    ),
    "ads_daily": lambda w: extensions.ads_daily(w["fact_ad_performance"], *w.hierarchy),
    "attribution_credits": ad_credits,
    "attributed_daily": lambda w: attribution.attributed_daily(ad_credits(w), *w.hierarchy),
    "sales_ads_daily": lambda w: extensions.sales_ads_daily(
        w["fact_ad_performance"], w["fact_order_summary"], *w.hierarchy, ad_credits(w)
    ),
    "sales_ads_daily_sample_days": lambda w: extensions.sales_ads_daily(
        w["fact_ad_performance"], w["fact_order_summary"].withColumn("order_date", F.expr(SAMPLE_ORDER_DAY)), *w.hierarchy,
        ad_credits(w),
    ),
    "scd2_product": product_history,
    "scd2_campaign_budget": campaign_history,
    "fact_sales_as_of": lambda w: facts.fact_sales_as_of(w["stg_order_items"], w["stg_orders"], product_history(w)),
    "scd2": lambda w: history.product_price_history(w["stg_order_items"], w["stg_orders"]),
    "attribution": lambda w: history.touch_attribution(w.inputs.raw("events")),
    "cac": lambda w: extensions.acquisition_cost(w["stg_ad_spend"], w["stg_orders"]),
})


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name in (*STAGED, *DIMENSIONS, *FACTS, *MARTS):
        found[name] = over_warehouse(lambda w, name=name: w[name])
    for name, build in STEPS.items():
        found[name] = over_warehouse(build)
    # The bounds are part of the plan, as for the calendar over dates that are themselves data.
    found["dim_date"] = found["dim_date_dynamic"]
    for name in FACTS:
        found[f"incr_{name}"] = over_warehouse(lambda w, name=name: load_twice(w, name))
        found[f"corrected_{name}"] = over_warehouse(lambda w, name=name: load_corrected(w, name))
    for name in MARTS:
        found[f"{name}_in_order"] = over_warehouse(lambda w, name=name: in_report_order(name, w[name]))
    return found


def oracle_sql() -> dict[str, str]:
    known = {name: sql.statement(name) for name in queries() if name in sql.PARTS}
    known["dim_date_dynamic"] = sql.statement("dim_date")
    known["product_performance_sample_tiers"] = sql.with_parts(
        sql.product_report(SAMPLE_REVENUE_TIERS, sql.rules.PROFIT_TIERS)
    )
    known["customer_segmentation_sample_limits"] = sql.with_parts(
        sql.customer_report(SAMPLE_HIGH_VALUE, SAMPLE_MEDIUM_VALUE)
    )
    moved = {"shop_days": sql.PARTS["shop_days"].replace("CAST(order_date AS DATE)", "DATE '2024-01-01' + CAST(order_id % 27 AS INTEGER)")}
    known["sales_ads_daily_sample_days"] = sql.with_parts(sql.PARTS["sales_ads_daily"], moved)
    for name in FACTS:
        known[f"incr_{name}"] = known[f"corrected_{name}"] = known[name]
    for name in MARTS:
        known[f"{name}_in_order"] = known[name]
    known["updated_budget_utilization"] = known["budget_utilization"]
    known["stream_ad_daily"] = known["stg_ad_insights"]
    known["stream_fact_sales"] = known["fact_sales"]
    known["stream_fact_upsert"] = known["fact_ad_performance"]
    return known
