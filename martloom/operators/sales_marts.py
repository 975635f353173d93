"""Sales marts.

Facts are summed by key first and meet their dimension afterwards: one row per product or customer is joined, not one
per order line. That gives the same result because a key has one row in its dimension.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions import rules
from martloom.functions.measures import mean, ratio_or_null
from martloom.operators.common import current, days_table, stamped


def in_calendar(fact: DataFrame, key: str, calendar: DataFrame, *columns: str) -> DataFrame:
    """Calendar columns for the fact's date key."""
    days = days_table(calendar, F.col("date_key").alias(key), *columns)
    return fact.join(days, key)


# ---- product performance ----------------------------------------------------------------------------------------


def _sold(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    return (
        in_calendar(sales, "order_date_key", calendar)
        .groupBy("product_key")
        .agg(
            F.sum("quantity").alias("total_units_sold"),
            F.sum("line_item_total").cast("decimal(28,2)").alias("total_revenue"),
            F.count_distinct("order_id").alias("order_count"),
            mean("unit_price").alias("avg_selling_price"),
            # Profit is by line: a line without a quantity or a total has none.
            F.sum(F.when(F.col("quantity").isNotNull(), F.col("line_item_total"))).alias("profit_revenue"),
            F.sum(F.when(F.col("line_item_total").isNotNull(), F.col("quantity"))).alias("profit_units"),
        )
    )


def _held(stock: DataFrame) -> DataFrame:
    return stock.groupBy("product_key").agg(
        F.sum("quantity_available").alias("total_inventory"), mean("reorder_level").alias("avg_reorder_level")
    )


def _product_columns() -> list:
    """Sold products with their dimension row. Cost is one number per product: profit follows from the two sums."""
    profit = F.col("profit_revenue") - F.col("cost") * F.col("profit_units").cast("decimal(18,0)")
    return [
        *"product_id product_name category vendor total_units_sold total_revenue".split(),
        profit.cast("decimal(28,2)").alias("total_profit"),
        "order_count",
        "avg_selling_price",
        F.col("price").alias("list_price"),
        ratio_or_null("avg_selling_price", "price").alias("avg_discount_ratio"),
    ]


def _described(product: DataFrame) -> DataFrame:
    return product.select(*"product_key product_id product_name category vendor cost price".split())


def product_sales(sales: DataFrame, product: DataFrame, calendar: DataFrame) -> DataFrame:
    """Units, revenue, profit and prices per product."""
    return _sold(sales, calendar).join(_described(product), "product_key").select(*_product_columns())


def product_inventory(stock: DataFrame, product: DataFrame) -> DataFrame:
    """Stock on hand per product."""
    return _held(stock).join(product.select("product_key", "product_id"), "product_key").select(
        "product_id", "total_inventory", "avg_reorder_level"
    )


def product_performance(
    sales: DataFrame,
    stock: DataFrame,
    product: DataFrame,
    calendar: DataFrame,
    revenue_tiers=rules.REVENUE_TIERS,
    profit_tiers=rules.PROFIT_TIERS,
    run_ts: datetime | None = None,
) -> DataFrame:
    """Sales next to stock. Both are summed and joined by product key, so both sums leave them partitioned alike."""
    margin = ratio_or_null("total_profit", "total_revenue")
    described = _sold(sales, calendar).join(_described(product), "product_key")
    both = described.join(_held(stock), "product_key", "left").select(
        *_product_columns(), "total_inventory", "avg_reorder_level"
    )
    out = both.select(
        *"product_id product_name category vendor total_units_sold total_revenue total_profit".split(),
        margin.alias("profit_margin"),
        *"order_count avg_selling_price list_price avg_discount_ratio total_inventory avg_reorder_level".split(),
        ratio_or_null("total_units_sold", "total_inventory").alias("inventory_turnover"),
        rules.above(F.col("total_revenue"), revenue_tiers, rules.REVENUE_TIER_ELSE).alias("revenue_tier"),
        rules.above(margin, profit_tiers, rules.PROFIT_TIER_ELSE).alias("profit_tier"),
    )
    return stamped(out, run_ts, "analysis_date")


# ---- customer segmentation --------------------------------------------------------------------------------------


def customer_metrics(summaries: DataFrame, customer: DataFrame, calendar: DataFrame, as_of: date) -> DataFrame:
    """Orders, spend and order dates per customer, as known on the day ``as_of``."""
    bought = (
        in_calendar(summaries, "order_date_key", calendar, "full_date")
        .groupBy("customer_key")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("grand_total").cast("decimal(28,2)").alias("total_spend"),
            mean("grand_total").alias("avg_order_value"),
            F.min("full_date").alias("first_order_date"),
            F.max("full_date").alias("last_order_date"),
        )
    )
    who = customer.select(*"customer_key customer_id first_name last_name email city state country".split())
    return bought.join(who, "customer_key").select(
        *"customer_key customer_id first_name last_name email city state country".split(),
        *"total_orders total_spend avg_order_value first_order_date last_order_date".split(),
        F.datediff("last_order_date", "first_order_date").alias("customer_tenure_days"),
        F.datediff(F.lit(as_of), "last_order_date").alias("days_since_last_order"),
    )


def monthly_frequency():
    """Orders per 30 days of tenure; a customer of one day counts with all orders."""
    orders = F.col("total_orders").cast("double")
    tenure = F.col("customer_tenure_days")
    return F.when(tenure == 0, orders).otherwise(F.try_divide(orders, tenure.cast("double") / F.lit(30.0)))


def customer_frequency(metrics: DataFrame) -> DataFrame:
    return metrics.select("customer_key", monthly_frequency().alias("monthly_frequency"))


def product_preferences(sales: DataFrame, summaries: DataFrame, product: DataFrame) -> DataFrame:
    """Order lines per customer and category, ranked within the customer; ties go by category name.

    Both facts are joined on the order before anything else, where a full build leaves them partitioned alike. Lines
    are counted before they are shuffled by customer and category, and ranks 1 are picked in each task before the
    final sort.
    """
    lines = sales.select("order_id", "product_key").join(summaries.select("order_id", "customer_key"), "order_id")
    counts = (
        lines.join(product.select("product_key", "category"), "product_key")
        .groupBy("customer_key", "category")
        .agg(F.count("*").alias("category_count"))
    )
    order = Window.partitionBy("customer_key").orderBy(F.desc("category_count"), F.asc_nulls_last("category"))
    return counts.withColumn("category_rank", F.row_number().over(order))


def customer_segmentation(
    summaries: DataFrame,
    sales: DataFrame,
    customer: DataFrame,
    product: DataFrame,
    calendar: DataFrame,
    as_of: date,
    high=rules.HIGH_VALUE,
    medium=rules.MEDIUM_VALUE,
    run_ts: datetime | None = None,
) -> DataFrame:
    favourite = (
        product_preferences(sales, summaries, product)
        .where("category_rank = 1")
        .select("customer_key", F.col("category").alias("preferred_category"))
    )
    metrics = customer_metrics(summaries, customer, calendar, as_of).withColumn(
        "monthly_frequency", monthly_frequency()
    )
    out = metrics.join(favourite, "customer_key", "left").select(
        *"customer_key customer_id first_name last_name email city state country".split(),
        *"total_orders total_spend avg_order_value first_order_date last_order_date".split(),
        *"customer_tenure_days monthly_frequency preferred_category".split(),
        rules.value_segment(F.col("total_spend"), F.col("monthly_frequency"), high, medium).alias(
            "customer_value_segment"
        ),
        rules.recency_segment(F.col("days_since_last_order")).alias("recency_segment"),
    )
    return stamped(out, run_ts, "analysis_date")


# ---- sales by region --------------------------------------------------------------------------------------------

REGION = ("country", "state", "city")
MONTH = ("year_number", "quarter_number", "month_number", "month_name")


def located_orders(sales: DataFrame, customer: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales by order with its month and its region: the ship-to place, or else the customer's.

    Lines are summed by order first: the customer lookup and distinct counts then see one row per order, and nothing at all is
    shuffled for it where the lines are already partitioned by order.
    """
    by_order = sales.groupBy("order_id", "customer_key", "order_date_key", *[f"shipping_{c}" for c in REGION]).agg(
        F.sum("line_item_total").alias("order_sales"), F.sum("quantity").alias("order_units")
    )
    where = customer.select("customer_key", "customer_id", *REGION)
    located = in_calendar(by_order, "order_date_key", calendar, *MONTH).join(where, "customer_key")
    return located.select(
        "order_id", "customer_id", "order_sales", "order_units", *MONTH,
        *[F.coalesce(f"shipping_{name}", name).alias(name) for name in REGION],
    )


def regional_sales(sales: DataFrame, customer: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales by region and month."""
    return located_orders(sales, customer, calendar).groupBy(*REGION, *MONTH).agg(
        F.sum("order_sales").cast("decimal(28,2)").alias("total_sales"),
        F.count_distinct("order_id").alias("order_count"),
        F.count_distinct("customer_id").alias("customer_count"),
        F.sum("order_units").alias("units_sold"),
    )


def _history():
    """Months of one region in order: at most one row per month, so a window holds a few hundred rows."""
    return Window.partitionBy(*REGION).orderBy("year_number", "month_number")


def regional_previous_period(regional: DataFrame) -> DataFrame:
    """Sales one and twelve rows earlier. Rows are months with sales: a month without any is not there to step over."""
    return regional.select(
        *REGION,
        *"year_number quarter_number month_number".split(),
        F.lag("total_sales").over(_history()).alias("prev_month_sales"),
        F.lag("total_sales", 12).over(_history()).alias("prev_year_sales"),
    )


def sales_by_region(
    sales: DataFrame, customer: DataFrame, calendar: DataFrame, run_ts: datetime | None = None
) -> DataFrame:
    """Regional sales with growth on the previous month and year.

    A region with an unknown part has no previous period: it could not be matched to itself.
    """
    known = F.col("country").isNotNull() & F.col("state").isNotNull() & F.col("city").isNotNull()

    def before(steps: int):
        return F.when(known, F.lag("total_sales", steps).over(_history()))

    def growth(previous: str):
        change = F.col("total_sales") - F.col(previous)
        return ratio_or_null(change, previous)

    out = (
        regional_sales(sales, customer, calendar)
        .select("*", before(1).alias("prev_month_sales"), before(12).alias("prev_year_sales"))
        .select(
            *REGION,
            *MONTH,
            *"total_sales order_count customer_count units_sold".split(),
            ratio_or_null("total_sales", "order_count").alias("avg_order_value"),
            ratio_or_null("total_sales", "customer_count").alias("revenue_per_customer"),
            "prev_month_sales",
            "prev_year_sales",
            growth("prev_month_sales").alias("month_over_month_growth"),
            growth("prev_year_sales").alias("year_over_year_growth"),
        )
    )
    return stamped(out, run_ts, "analysis_date")


# ---- inventory analysis -----------------------------------------------------------------------------------------

# Fixed value: days of sales the rate is taken from.
RATE_DAYS = 90


STOCK_COLUMNS = (
    "product_key product_id product_name category vendor warehouse_location quantity_available reorder_level"
    " last_restocked"
).split()


def _described_stock(stock: DataFrame, product: DataFrame) -> DataFrame:
    return stock.join(
        current(product).select(*"product_key product_id product_name category vendor".split()), "product_key"
    )


def _days_since_restock(as_of: date):
    """Negative for a delivery yet to come."""
    return F.datediff(F.lit(as_of), F.to_date("last_restocked")).alias("days_since_restock")


def inventory_status(stock: DataFrame, product: DataFrame, warehouse: DataFrame, as_of: date) -> DataFrame:
    """Stock records with product and warehouse, and days since the last delivery."""
    places = warehouse.select("warehouse_key", "warehouse_location")
    placed = _described_stock(stock, product).join(places, "warehouse_key")
    return placed.select(*STOCK_COLUMNS, _days_since_restock(as_of))


def _recent_sales(sales: DataFrame, calendar: DataFrame, as_of: date) -> DataFrame:
    """Units per day with sales, over the last 90 days, by product key.

    The window is also a condition on the date key, so a fact stored by date reads only those days.
    """
    since = as_of - timedelta(days=RATE_DAYS)
    recent = sales.where(F.col("order_date_key") >= since.year * 10000 + since.month * 100 + since.day)
    days = calendar.where(F.col("full_date") >= F.lit(since))
    return (
        in_calendar(recent, "order_date_key", days, "full_date")
        .groupBy("product_key")
        .agg(
            F.sum("quantity").alias("total_quantity_sold"), F.count_distinct("full_date").alias("days_with_sales")
        )
        .withColumn("daily_sales_rate", ratio_or_null("total_quantity_sold", "days_with_sales"))
    )


def sales_velocity(sales: DataFrame, product: DataFrame, calendar: DataFrame, as_of: date) -> DataFrame:
    ids = product.select("product_key", "product_id")
    return _recent_sales(sales, calendar, as_of).join(ids, "product_key").select(
        "product_id", "total_quantity_sold", "days_with_sales", "daily_sales_rate"
    )


def inventory_analysis(
    stock: DataFrame,
    sales: DataFrame,
    product: DataFrame,
    warehouse: DataFrame,
    calendar: DataFrame,
    as_of: date,
    run_ts: datetime | None = None,
) -> DataFrame:
    """Stock against recent sales. Product and sales are both joined by product key, from one shuffle of the stock."""
    rate, on_hand, reorder = F.col("daily_sales_rate"), F.col("quantity_available"), F.col("reorder_level")
    supply = F.when(rate > 0, on_hand.cast("double") / rate)
    places = warehouse.select("warehouse_key", "warehouse_location")
    held = _described_stock(stock, product).join(_recent_sales(sales, calendar, as_of), "product_key", "left")
    out = held.join(places, "warehouse_key").select(
        *STOCK_COLUMNS,
        _days_since_restock(as_of),
        "total_quantity_sold",
        "daily_sales_rate",
        supply.alias("days_of_supply"),
        rules.inventory_status(on_hand, reorder).alias("inventory_status"),
        rules.inventory_velocity(rate, supply).alias("inventory_velocity"),
    )
    return stamped(out, run_ts, "analysis_date")
