"""Small hand-made input tables."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from martloom.plans.warehouse import Warehouse
from martloom.sources.schemas import TABLES, ddl
from martloom.sources.star import RunDates

DATES = RunDates(date(2024, 1, 1), date(2025, 1, 1), date(2024, 7, 1))


def money(text) -> Decimal:
    return Decimal(str(text)).quantize(Decimal("0.01"))


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


# Values used where a row does not say otherwise.
DEFAULTS = {
    "bigint": 0, "int": 0, "string": "x", "decimal(18,2)": Decimal("0.00"), "decimal(9,4)": Decimal("0.0000"),
    "boolean": True, "date": date(2024, 1, 1), "timestamp_ntz": datetime(2024, 1, 1),
}


def table(spark, name: str, *rows: dict):
    """An input table; columns a row leaves out get a plain default."""
    kinds = TABLES[name]
    values = [tuple(row.get(c, DEFAULTS[kind]) for c, kind in kinds.items()) for row in rows]
    return spark.createDataFrame(values, ddl(name))


def shop(spark, orders, lines, customers=None, products=None, inventory=(), **other) -> Warehouse:
    customers = customers or [{"customer_id": 1, "city": "C", "state": "S", "country": "L"}]
    products = products or [{"product_id": 1, "category": "a", "price": money(10), "cost": money(4)}]
    inputs = {
        "Orders": table(spark, "Orders", *orders),
        "Order_Items": table(spark, "Order_Items", *lines),
        "Customers": table(spark, "Customers", *customers),
        "Products": table(spark, "Products", *products),
        "Inventory": table(spark, "Inventory", *inventory),
        **other,
    }
    return Warehouse(spark, inputs, DATES)


def order(order_id, customer_id=1, day="2024-02-01", total=100, **more) -> dict:
    place = {"shipping_city": None, "shipping_state": None, "shipping_country": None}
    return {"order_id": order_id, "customer_id": customer_id, "order_date": at(day), "grand_total": money(total),
            "status": "Delivered", "payment_method": "Card", **place, **more}


def line(order_item_id, order_id, product_id=1, quantity=1, total=10, price=10) -> dict:
    return {"order_item_id": order_item_id, "order_id": order_id, "product_id": product_id, "quantity": quantity,
            "line_item_total": money(total), "unit_price": money(price)}


def media(spark, insights=(), spend=(), ads=None, adsets=None, campaigns=None) -> Warehouse:
    campaigns = campaigns or [{"campaign_id": 1, "campaign_name": "one"}, {"campaign_id": 2, "campaign_name": "two"}]
    adsets = adsets or [
        {"ad_set_id": 1, "campaign_id": 1, "targeting_age_min": 20, "targeting_age_max": 30, "targeting_gender": "F"},
        {"ad_set_id": 2, "campaign_id": 2, "targeting_age_min": None, "targeting_age_max": None,
         "targeting_gender": None, "targeting_interests": None},
    ]
    ads = ads or [{"ad_id": 1, "ad_set_id": 1}, {"ad_id": 2, "ad_set_id": 2}]
    inputs = {
        "Campaigns": table(spark, "Campaigns", *campaigns),
        "AdSets": table(spark, "AdSets", *adsets),
        "Ads": table(spark, "Ads", *ads),
        "Ad_Insights": table(spark, "Ad_Insights", *insights),
        "Ad_Spend": table(spark, "Ad_Spend", *spend),
    }
    return Warehouse(spark, inputs, DATES)


def insight(performance_id, ad_id=1, day="2024-02-01", impressions=0, clicks=0, spend=0, conversions=0, value=0,
            reach=0) -> dict:
    return {"performance_id": performance_id, "ad_id": ad_id, "date": date.fromisoformat(day),
            "impressions": impressions, "clicks": clicks, "spend": money(spend), "conversions": conversions,
            "conversion_value": money(value), "reach": reach}


def spent(spend_id, campaign_id=1, ad_set_id=1, day="2024-02-01", budget=100, amount=50) -> dict:
    return {"spend_id": spend_id, "campaign_id": campaign_id, "ad_set_id": ad_set_id,
            "date": date.fromisoformat(day), "daily_budget": money(budget), "amount_spent": money(amount)}


def only(df) -> dict:
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def by(df, key: str) -> dict:
    rows = df.collect()
    found = {row[key]: row.asDict() for row in rows}
    assert len(found) == len(rows)
    return found


def bag(df) -> list:
    return sorted(map(repr, df.collect()))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
