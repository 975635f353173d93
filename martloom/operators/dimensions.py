"""Dimension tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.calendar import calendar_columns
from martloom.functions.keys import surrogate_key
from martloom.functions.rules import SOURCE_SYSTEM, status_description
from martloom.operators.common import current, moment, no_value, stamped

AUDIT = ("dw_insert_date", "dw_update_date")


def _versioned(effective):
    """Columns of a dimension row that is valid from ``effective`` on."""
    return [effective.alias("effective_date"), no_value("timestamp_ntz").alias("expiration_date"),
            F.lit(True).alias("is_current")]


def dim_customer(customers: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    out = customers.select(
        surrogate_key("customer_id").alias("customer_key"),
        *("customer_id first_name last_name email phone address city state zip_code country").split(),
        *_versioned(F.col("created_at")),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
    )
    return stamped(out, run_ts, *AUDIT)


def dim_product(products: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    out = products.select(
        surrogate_key("product_id").alias("product_key"),
        *"product_id product_name description category price cost sku is_active vendor".split(),
        *_versioned(F.col("created_at")),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
    )
    return stamped(out, run_ts, *AUDIT)


def dim_campaign(campaigns: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    out = campaigns.select(
        surrogate_key("campaign_id").alias("campaign_key"),
        *"campaign_id campaign_name objective status budget_type".split(),
        *"daily_budget lifetime_budget start_date end_date".split(),
        *_versioned(F.col("created_at")),
    )
    return stamped(out, run_ts, *AUDIT)


def dim_adset(
    adsets: DataFrame, campaign: DataFrame, loaded_at: datetime | Column, run_ts: datetime | None = None
) -> DataFrame:
    """Ad sets with the key of their campaign; an ad set without a current campaign is left out.

    A row counts as effective from the time it was loaded.
    """
    parent = current(campaign).select("campaign_id", "campaign_key")
    out = adsets.join(parent, "campaign_id").select(
        surrogate_key("ad_set_id").alias("adset_key"),
        *"ad_set_id campaign_key campaign_id ad_set_name targeting_age_min targeting_age_max".split(),
        *"targeting_gender targeting_locations targeting_interests bid_strategy bid_amount".split(),
        *"daily_budget start_date end_date status".split(),
        *_versioned(loaded_at if isinstance(loaded_at, Column) else moment(loaded_at)),
    )
    return stamped(out, run_ts, *AUDIT)


def dim_ad(ads: DataFrame, adset: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Ads with the key of their ad set; an ad without a current ad set is left out."""
    parent = current(adset).select("ad_set_id", "adset_key")
    out = ads.join(parent, "ad_set_id").select(
        surrogate_key("ad_id").alias("ad_key"),
        *"ad_id adset_key ad_set_id ad_name ad_type creative_primary_text creative_headline".split(),
        *"creative_description display_url destination_url status".split(),
        *_versioned(F.col("created_at")),
    )
    return stamped(out, run_ts, *AUDIT)


# Range of the standard calendar; the last day is not part of it.
CALENDAR_START, CALENDAR_END = date(2018, 1, 1), date(2028, 12, 31)


def dim_date(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end``."""
    bounds = spark.range(0, 1, 1, 1).select(F.lit(start).alias("start_date"), F.lit(end).alias("end_date"))
    return dim_date_dynamic(bounds)


def dim_date_dynamic(bounds: DataFrame) -> DataFrame:
    """The same calendar over a range that is itself data: one row (start_date, end_date)."""
    days = bounds.where("start_date < end_date").select(
        F.explode(F.sequence("start_date", F.date_sub("end_date", 1))).alias("day")
    )
    return days.select(*calendar_columns(F.col("day")))


def _listed(source: DataFrame, value: str, key: str, *names: str, run_ts: datetime | None) -> DataFrame:
    """A dimension of the distinct values of one column, NULL included."""
    out = source.select(value).distinct().select(
        surrogate_key(value).alias(key), *[F.col(value).alias(name) for name in names]
    )
    return stamped(out, run_ts, *AUDIT)


def dim_order_status(orders: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    return _listed(orders, "status", "status_key", "status_id", "status_description", run_ts=run_ts)


def dim_payment_method(orders: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    return _listed(
        orders, "payment_method", "payment_method_key", "payment_method_id", "payment_method_description",
        run_ts=run_ts,
    )


def dim_warehouse(inventory: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    return _listed(
        inventory, "warehouse_location", "warehouse_key", "warehouse_id", "warehouse_location",
        "warehouse_description", run_ts=run_ts,
    )


def dim_status(campaigns: DataFrame, adsets: DataFrame, ads: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Every status used by a campaign, ad set or ad, once; each task sends only its distinct values."""
    statuses = campaigns.select("status").union(adsets.select("status")).union(ads.select("status")).distinct()
    out = statuses.select(
        surrogate_key("status").alias("status_key"), "status", status_description().alias("status_description")
    )
    return stamped(out, run_ts, *AUDIT)
