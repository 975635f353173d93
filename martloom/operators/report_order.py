"""The order in which a mart is shown.

Marts are stored unsorted. Sorting is a separate last step for a reader: Spark sorts by ranges, so it needs no single
task, but a stored table gains nothing from it. NULLs come last going up and first going down. The key of the mart ends
every order: rows with equal values then have a fixed order, and ranges can be cut within them, so a value that fills
a third of the rows is not one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.rules import LOW_STOCK, REORDER


def up(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def down(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def urgency() -> Column:
    status = F.col("inventory_status")
    return F.when(status == REORDER, 1).when(status == LOW_STOCK, 2).otherwise(3).asc()


ORDERS = {
    "product_performance": lambda: [down("total_revenue"), up("product_id")],
    "customer_segmentation": lambda: [down("total_spend"), up("customer_key")],
    "sales_by_region": lambda: [up(c) for c in "country state city year_number month_number".split()],
    "inventory_analysis": lambda: [
        urgency(), up("category"), up("product_name"), up("product_key"), up("warehouse_location"),
    ],
    "campaign_performance": lambda: [up("year_number"), up("month_number"), down("spend"), up("campaign_key")],
    "ad_effectiveness": lambda: [down("roas"), up("ad_key")],
    "targeting_analysis": lambda: [down("roas"), up("adset_key")],
    "budget_utilization": lambda: [up("campaign_name"), up("full_date"), up("campaign_key")],
}


def in_report_order(mart: str, df: DataFrame) -> DataFrame:
    return df.orderBy(*ORDERS[mart]())
