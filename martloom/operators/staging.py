"""Staging: the input table cut to its declared columns, so a new source column changes nothing downstream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martloom.sources.schemas import TABLES

# Model name -> input table.
STAGED = {
    "stg_customers": "Customers",
    "stg_products": "Products",
    "stg_inventory": "Inventory",
    "stg_orders": "Orders",
    "stg_order_items": "Order_Items",
    "stg_campaigns": "Campaigns",
    "stg_adsets": "AdSets",
    "stg_ads": "Ads",
    "stg_ad_insights": "Ad_Insights",
    "stg_ad_spend": "Ad_Spend",
}


def stage(model: str, source: DataFrame) -> DataFrame:
    return source.select(*TABLES[STAGED[model]])
