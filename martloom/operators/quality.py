"""Data-quality checks: not null, unique, and existing parent.

All checks of one kind on one table share one pass: the checked columns are turned into (column, value) rows, counted
per value before they are shuffled. A value that fills a third of a table is one row per task by then. Hashes are shuffled
as bytes, half as long as their text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.keys import packed
from martloom.session import shuffles_dropped

# The declared checks. Table -> columns.
NOT_NULL = {
    "stg_customers": ["customer_id"],
    "stg_products": ["product_id"],
    "stg_inventory": ["inventory_id"],
    "stg_orders": ["order_id"],
    "stg_order_items": ["order_item_id"],
    "stg_campaigns": ["campaign_id"],
    "stg_adsets": ["ad_set_id", "campaign_id"],
    "stg_ads": ["ad_id", "ad_set_id"],
    "stg_ad_insights": ["performance_id", "ad_id"],
    "stg_ad_spend": ["spend_id"],
    "dim_customer": ["customer_key", "customer_id"],
    "dim_product": ["product_key", "product_id"],
    "dim_date": ["date_key", "full_date"],
    "dim_order_status": ["status_key", "status_id"],
    "dim_payment_method": ["payment_method_key", "payment_method_id"],
    "dim_warehouse": ["warehouse_key", "warehouse_id"],
    "dim_campaign": ["campaign_key", "campaign_id"],
    "dim_adset": ["adset_key", "ad_set_id", "campaign_key"],
    "dim_ad": ["ad_key", "ad_id", "adset_key"],
    "dim_status": ["status_key", "status"],
    "fact_sales": ["sales_key", "order_id", "order_item_id", "customer_key", "product_key"],
    "fact_inventory": ["inventory_key", "product_key", "warehouse_key"],
    "fact_order_summary": ["order_summary_key", "order_id", "customer_key"],
    "fact_ad_performance": ["ad_performance_key", "ad_key", "adset_key", "date_key"],
    "fact_campaign_spend": ["campaign_spend_key", "campaign_key", "date_key"],
    "fact_adset_performance": ["adset_performance_key", "adset_key", "date_key"],
    "product_performance": ["product_id"],
    "customer_segmentation": ["customer_key"],
    "campaign_performance": ["campaign_key"],
    "ad_effectiveness": ["ad_key"],
    "targeting_analysis": ["adset_key"],
    "budget_utilization": ["campaign_key"],
}
UNIQUE = {
    "stg_customers": ["customer_id"],
    "stg_products": ["product_id"],
    "stg_inventory": ["inventory_id"],
    "stg_orders": ["order_id"],
    "stg_order_items": ["order_item_id"],
    "stg_campaigns": ["campaign_id"],
    "stg_adsets": ["ad_set_id"],
    "stg_ads": ["ad_id"],
    "stg_ad_insights": ["performance_id"],
    "stg_ad_spend": ["spend_id"],
    "dim_customer": ["customer_key"],
    "dim_product": ["product_key"],
    "dim_date": ["date_key", "full_date"],
    "dim_order_status": ["status_key", "status_id"],
    "dim_payment_method": ["payment_method_key", "payment_method_id"],
    "dim_warehouse": ["warehouse_key", "warehouse_id"],
    "dim_campaign": ["campaign_key"],
    "dim_adset": ["adset_key"],
    "dim_ad": ["ad_key"],
    "dim_status": ["status_key"],
    "fact_sales": ["sales_key"],
    "fact_inventory": ["inventory_key"],
    "fact_order_summary": ["order_summary_key"],
    "fact_ad_performance": ["ad_performance_key"],
    "fact_campaign_spend": ["campaign_spend_key"],
    "fact_adset_performance": ["adset_performance_key"],
    "product_performance": ["product_id"],
    "customer_segmentation": ["customer_key"],
}
# Table -> column -> (parent table, parent column).
RELATIONSHIPS = {
    "stg_adsets": {"campaign_id": ("stg_campaigns", "campaign_id")},
    "stg_ads": {"ad_set_id": ("stg_adsets", "ad_set_id")},
    "stg_ad_insights": {"ad_id": ("stg_ads", "ad_id")},
    "fact_sales": {
        "customer_key": ("dim_customer", "customer_key"),
        "product_key": ("dim_product", "product_key"),
        "order_date_key": ("dim_date", "date_key"),
    },
    "fact_inventory": {
        "product_key": ("dim_product", "product_key"),
        "warehouse_key": ("dim_warehouse", "warehouse_key"),
    },
    "fact_order_summary": {
        "customer_key": ("dim_customer", "customer_key"),
        "order_date_key": ("dim_date", "date_key"),
    },
}


def _as_report(failures: DataFrame, table: str, test: str, columns: list[str]) -> DataFrame:
    """One row per check from one row with a failure count per column."""
    counted = failures.select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in columns])
    listed = counted.unpivot([], columns, "column_name", "failures")
    return listed.select(F.lit(table).alias("table_name"), "column_name", F.lit(test).alias("test"), "failures")


def _value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """How often each value (packed) occurs in each column, NULL left out."""
    values = df.select(*[packed(F.col(c).cast("string")).alias(c) for c in columns])
    if len(columns) == 1:
        (name,) = columns
        found = values.select(F.col(name).alias("value")).where("value IS NOT NULL").groupBy("value").agg(F.count("*").alias("n"))
        return found.select(F.lit(name).alias("column_name"), "value", "n")
    listed = values.unpivot([], columns, "column_name", "value").where("value IS NOT NULL")
    return listed.groupBy("column_name", "value").agg(F.count("*").alias("n"))


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows without a value, per column."""
    return _as_report(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), table, "not_null", columns)


def unique(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Values that occur more than once, per column."""
    counts = _value_counts(df, columns)
    repeated = [F.count_if((F.col("column_name") == c) & (F.col("n") > 1)).alias(c) for c in columns]
    return _as_report(counts.agg(*repeated), table, "unique", columns)


def relationships(df: DataFrame, table: str, parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows whose value is missing in the parent column, per column."""
    columns = list(parents)
    known = [
        parent.select(F.lit(c).alias("column_name"), packed(F.col(name).cast("string")).alias("value"))
        for c, (parent, name) in parents.items()
    ]
    orphans = _value_counts(df, columns).join(reduce(DataFrame.union, known), ["column_name", "value"], "left_anti")
    rows = [F.sum(F.when(F.col("column_name") == c, F.col("n"))).alias(c) for c in columns]
    return _as_report(orphans.agg(*rows), table, "relationships", columns)


Tables = Callable[[str], DataFrame]


def _checks_not_null(tables: Tables) -> Iterator[DataFrame]:
    return (not_null(tables(t), t, columns) for t, columns in NOT_NULL.items())


def _checks_unique(tables: Tables) -> Iterator[DataFrame]:
    return (unique(tables(t), t, columns) for t, columns in UNIQUE.items())


def _checks_relationships(tables: Tables) -> Iterator[DataFrame]:
    for t, parents in RELATIONSHIPS.items():
        yield relationships(tables(t), t, {c: (tables(parent), name) for c, (parent, name) in parents.items()})


def _together(checks: Iterable[DataFrame], folder: str | None) -> DataFrame:
    """All rows of some checks. With a folder, each check's few rows are stored there before the next one is set up: one plan of
    all of them would hold the files they shuffle and the tables they broadcast until the last has ended."""
    if folder is None:
        return reduce(DataFrame.union, checks)
    for check in checks:
        spark = check.sparkSession
        with shuffles_dropped(spark):
            check.coalesce(1).write.mode("append").parquet(folder)
    return spark.read.schema(check.schema).parquet(folder)


def all_not_null(tables: Tables, folder: str | None = None) -> DataFrame:
    return _together(_checks_not_null(tables), folder)


def all_unique(tables: Tables, folder: str | None = None) -> DataFrame:
    return _together(_checks_unique(tables), folder)


def all_relationships(tables: Tables, folder: str | None = None) -> DataFrame:
    return _together(_checks_relationships(tables), folder)


def report(tables: Tables, folder: str | None = None) -> DataFrame:
    """Every declared check with its number of failures; 0 is a pass. With a folder, a new one, checks run one after the other
    and what they find is stored there."""
    return _together(chain(_checks_not_null(tables), _checks_unique(tables), _checks_relationships(tables)), folder)
