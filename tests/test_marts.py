from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from __spark_entry__ import queries
from martloom.operators import ad_marts, sales_marts
from martloom.operators.report_order import in_report_order
from tests.samples import at, bag, by, insight, line, media, money, only, order, shop, spent


def test_product_performance(spark):
    products = [
        {"product_id": 1, "category": "a", "price": money(10), "cost": money(4)},
        {"product_id": 2, "category": "a", "price": money(0), "cost": money(4)},
        {"product_id": 3, "category": "b", "price": money(5), "cost": money(1)},
    ]
    lines = [line(1, 1, 1, 2, 30, 12), line(2, 1, 1, 1, 10, 10), line(3, 2, 2, 1, 0, 3), line(4, 2, 1, 1, 20, 8)]
    stock = [
        {"inventory_id": 1, "product_id": 1, "quantity_available": 3, "reorder_level": 1},
        {"inventory_id": 2, "product_id": 1, "quantity_available": 5, "reorder_level": 2},
        {"inventory_id": 3, "product_id": 2, "quantity_available": 0, "reorder_level": 2},
    ]
    w = shop(spark, [order(1), order(2)], lines, products=products, inventory=stock)
    found = by(w["product_performance"], "product_id")
    assert set(found) == {1, 2}
    one, two = found[1], found[2]
    assert (one["total_units_sold"], one["total_revenue"], one["total_profit"], one["order_count"]) == (
        4, Decimal("60.00"), Decimal("44.00"), 2
    )
    assert (one["profit_margin"], one["avg_selling_price"], one["avg_discount_ratio"]) == (44 / 60, 10.0, 1.0)
    assert (one["total_inventory"], one["avg_reorder_level"], one["inventory_turnover"]) == (8, 1.5, 0.5)
    assert (one["revenue_tier"], one["profit_tier"]) == ("Low", "High Margin")
    # No revenue, a price of 0 and no stock: no ratios, lowest classes.
    assert [two[c] for c in ("profit_margin", "avg_discount_ratio", "inventory_turnover")] == [None] * 3
    assert two["profit_tier"] == "Low Margin" and two["total_profit"] == Decimal("-4.00")
    tiers = by(w.mart("product_performance", revenue_tiers=((59, "High"), (10, "Medium"))), "product_id")
    assert tiers[1]["revenue_tier"] == "High"


def test_profit_is_by_line(spark):
    """A line without a quantity or a total has no profit, and a product without a cost has none at all."""
    lines = [line(1, 1, 1, 1, 10), line(2, 1, 1, None, 20), {**line(3, 1, 1, 5), "line_item_total": None}, line(4, 1, 2)]
    products = [{"product_id": 1, "price": money(10), "cost": money(4)}, {"product_id": 2, "price": money(1), "cost": None}]
    found = by(shop(spark, [order(1)], lines, products=products)["product_performance"], "product_id")
    assert (found[1]["total_profit"], found[1]["total_revenue"]) == (Decimal("6.00"), Decimal("30.00"))
    assert found[2]["total_profit"] is None


def test_customer_segmentation(spark):
    customers = [{"customer_id": i, "city": "C", "state": "S", "country": "L"} for i in (1, 2, 3)]
    products = [{"product_id": i, "category": c, "price": money(1)} for i, c in ((1, "b"), (2, "a"), (3, None))]
    orders = [
        order(1, 1, "2024-06-10", 600), order(2, 1, "2024-06-25", 600),   # 15 days: 4 orders a month
        order(3, 2, "2024-01-02", 100),                                   # a single day
        order(4, 3, "2024-01-01", 200), order(5, 3, "2024-06-29", 350),   # 180 days: 1/3 a month
    ]
    lines = [line(1, 1, 1), line(2, 2, 2), line(3, 3, 1), line(4, 3, 1), line(5, 3, 2), line(6, 4, 3), line(7, 5, 3)]
    w = shop(spark, orders, lines, customers, products)
    found = by(w["customer_segmentation"], "customer_id")
    assert [found[i]["preferred_category"] for i in (1, 2, 3)] == ["a", "b", None]  # a tie goes by name
    assert [found[i]["customer_tenure_days"] for i in (1, 2, 3)] == [15, 0, 180]
    assert [round(found[i]["monthly_frequency"], 6) for i in (1, 2, 3)] == [4.0, 1.0, 0.333333]
    assert [found[i]["customer_value_segment"] for i in (1, 2, 3)] == ["High Value", "Medium Value", "Medium Value"]
    assert [found[i]["recency_segment"] for i in (1, 2, 3)] == ["Active", "Inactive", "Active"]
    assert found[1]["avg_order_value"] == 600.0
    frequencies = by(sales_marts.customer_frequency(
        sales_marts.customer_metrics(w["fact_order_summary"], w["dim_customer"], w["dim_date"], date(2024, 7, 1))
    ), "customer_key")
    assert {f["monthly_frequency"] for f in frequencies.values()} == {f["monthly_frequency"] for f in found.values()}


def test_growth_steps_over_rows(spark):
    """March has no sales: April is compared with February."""
    orders = [order(i, day=d) for i, d in enumerate(("2024-01-05", "2024-02-05", "2024-02-06", "2024-04-05"), 1)]
    lines = [line(1, 1, total=100), line(2, 2, total=50), line(3, 3, total=100), line(4, 4, total=0)]
    found = by(shop(spark, orders, lines)["sales_by_region"], "month_number")
    assert [found[m]["month_over_month_growth"] for m in (1, 2, 4)] == [None, 0.5, -1.0]
    assert found[4]["prev_month_sales"] == Decimal("150.00") and found[4]["avg_order_value"] == 0.0


def test_growth_over_twelve_rows(spark):
    orders = [order(m, day=f"2024-{m:02d}-01") for m in range(1, 13)]
    w = shop(spark, orders + [order(13, day="2024-12-02")], [line(i, i, total=i) for i in range(1, 14)])
    regional = sales_marts.regional_sales(w["fact_sales"], w["dim_customer"], w["dim_date"])
    later = regional.where("month_number = 1").selectExpr(
        *[f"{c} + 1 AS {c}" if c == "year_number" else c for c in regional.columns]
    )
    found = sales_marts.regional_previous_period(regional.union(later)).where("year_number = 2025").collect()
    assert [r["prev_year_sales"] for r in found] == [Decimal("1.00")]


def test_unknown_place_has_no_growth(spark):
    customers = [{"customer_id": 1, "city": "C", "state": None, "country": "L"}]
    orders = [order(1, day="2024-01-05"), order(2, day="2024-02-05"),
              order(3, day="2024-02-06", shipping_country="M", shipping_state="T", shipping_city="D")]
    w = shop(spark, orders, [line(i, i) for i in (1, 2, 3)], customers)
    rows = w["sales_by_region"].collect()
    assert {(r["country"], r["state"], r["city"]) for r in rows} == {("L", None, "C"), ("M", "T", "D")}
    assert [r["prev_month_sales"] for r in rows] == [None] * 3
    previous = sales_marts.regional_previous_period(
        sales_marts.regional_sales(w["fact_sales"], w["dim_customer"], w["dim_date"])
    )
    assert previous.where("state IS NULL AND prev_month_sales IS NOT NULL").count() == 1


def test_inventory_analysis(spark):
    products = [{"product_id": i, "price": money(1)} for i in (1, 2, 3)]
    stock = [
        {"inventory_id": i, "product_id": i, "quantity_available": 40, "reorder_level": 10, "warehouse_location": "W",
         "last_restocked": at("2024-07-03T23:00:00")} for i in (1, 2, 3)
    ]
    orders = [order(1, day="2024-06-01"), order(2, day="2024-06-02"), order(3, day="2024-04-01"),
              order(4, day="2024-04-02")]
    lines = [line(1, 1, 1, 2), line(2, 2, 1, 2), line(3, 1, 1, 2), line(4, 3, 2, 9), line(5, 4, 3, 2),
             line(6, 2, 3, -2)]
    w = shop(spark, orders, lines, products=products, inventory=stock)
    found = by(w["inventory_analysis"], "product_id")
    # 90 days before July 1 is April 2: that day counts, April 1 does not.
    assert [found[i]["total_quantity_sold"] for i in (1, 2, 3)] == [6, None, 0]
    assert [found[i]["daily_sales_rate"] for i in (1, 2, 3)] == [3.0, None, 0.0]
    assert [found[i]["days_of_supply"] for i in (1, 2, 3)] == [40 / 3.0, None, None]
    assert [found[i]["inventory_velocity"] for i in (1, 2, 3)] == ["Fast Moving", "Slow Moving", "No Movement"]
    assert {r["inventory_status"] for r in found.values()} == {"Adequate"}
    assert {r["days_since_restock"] for r in found.values()} == {-2}


def test_ad_effectiveness(spark):
    w = media(spark, [insight(1, 1, impressions=100, clicks=10, spend=10, conversions=5, value=8),
                      insight(2, 2, impressions=100, clicks=10)])
    found = by(w["ad_effectiveness"], "ad_id")
    assert round(found[1]["effectiveness_score"], 9) == 57.0  # (0.1*0.2 + 0.5*0.3 + 0.8*0.5) * 100
    assert (found[1]["effectiveness_tier"], found[2]["effectiveness_tier"]) == ("High Performing", "No Data")
    assert (found[2]["effectiveness_score"], found[2]["roas"], found[2]["ctr"]) == (0.0, 0.0, 10.0)


def test_targeting_analysis(spark):
    adsets = [
        {"ad_set_id": 1, "campaign_id": 1, "targeting_age_min": 20, "targeting_age_max": 30, "targeting_gender": "F"},
        {"ad_set_id": 2, "campaign_id": 1, "targeting_age_min": 20, "targeting_age_max": 30, "targeting_gender": "F"},
        {"ad_set_id": 3, "campaign_id": 1, "targeting_age_min": None, "targeting_age_max": None,
         "targeting_gender": None, "targeting_interests": None},
        {"ad_set_id": 4, "campaign_id": 1, "targeting_age_min": 60, "targeting_age_max": 70, "targeting_gender": "M"},
        {"ad_set_id": 5, "campaign_id": 1, "targeting_age_min": 20, "targeting_age_max": 30, "targeting_gender": "F"},
    ]
    ads = [{"ad_id": i, "ad_set_id": i} for i in range(1, 6)]
    rows = [insight(1, 1, spend=10, value=30), insight(2, 2, spend=10, value=10), insight(3, 3, spend=10, value=10),
            insight(4, 4, spend=10, value=0), insight(5, 5)]
    found = by(media(spark, rows, ads=ads, adsets=adsets)["targeting_analysis"], "ad_set_id")
    assert [found[i]["gender_roas_index"] for i in range(1, 6)] == [150.0, 50.0, 100.0, None, 100.0]
    assert [found[i]["age_roas_index"] for i in range(1, 6)] == [150.0, 50.0, 100.0, None, 100.0]
    assert found[3]["interest_roas_index"] == 100.0 and found[3]["age_range"] == "All Ages"
    assert found[1]["targeting_effectiveness_score"] == 120.0


def test_campaign_performance_keeps_months_without_spend_records(spark):
    w = media(spark, [insight(1, 1, "2024-02-01", spend=5), insight(2, 1, "2024-03-01", spend=7)],
              [spent(1, day="2024-02-03"), spent(2, day="2024-02-04", amount=100)])
    found = by(w["campaign_performance"], "month_number")
    assert (found[2]["total_spend"], found[2]["avg_budget_utilization"]) == (Decimal("150.00"), 75.0)
    assert found[3]["total_spend"] is None and found[3]["spend"] == Decimal("7.00")


def test_budget_rollups_are_the_grouped_ones(spark):
    days = ["2024-02-25", "2024-02-26", "2024-03-03", "2024-03-04", "2024-03-05"]
    rows = [spent(i, day=d, amount=10 * i, budget=0 if i == 5 else 40) for i, d in enumerate(days, 1)]
    rows += [spent(9, ad_set_id=2, day=days[0], amount=3, budget=7), spent(10, campaign_id=2, day=days[0])]
    w = media(spark, [insight(1, 1, spend=10, conversions=3, value=50)], rows)
    got = w["budget_utilization"]
    daily = ad_marts.budget_daily(w["fact_campaign_spend"], w["dim_campaign"], w["dim_date"])
    week = ad_marts.budget_weekly(daily)
    columns = week.columns
    assert bag(got.select(columns).distinct()) == bag(week)
    month = ad_marts.budget_monthly(daily)
    assert bag(got.select(month.columns).distinct()) == bag(month)
    weekday = ad_marts.budget_weekday(daily).toDF(
        "campaign_key", "day_of_week", "day_name", "avg_spend_for_day_of_week", "avg_utilization_for_day_of_week"
    )
    assert bag(got.select(weekday.columns).distinct()) == bag(weekday)
    one = by(got.where("campaign_id = 1"), "full_date")
    assert one[date(2024, 2, 25)]["week_start_date"] == date(2024, 2, 19)
    assert one[date(2024, 2, 26)]["conversions_per_spend_dollar"] == 3 / 20
    assert one[date(2024, 3, 4)]["budget_efficiency_rating"] == "Optimal"
    assert one[date(2024, 3, 5)]["budget_efficiency_rating"] == "No Budget"
    assert one[date(2024, 3, 5)]["budget_recommendation"] == "Maintain Budget"
    two = only(got.where("campaign_id = 2"))
    assert two["total_conversions"] is None and two["value_per_spend_dollar"] is None


def test_report_order(spark):
    w = shop(spark, [order(1), order(2), order(3)],
             [line(1, 1, total=5), line(2, 2, 2, total=9), line(3, 3, 3, total=5)],
             products=[{"product_id": i, "price": money(1)} for i in (3, 2, 1)])
    rows = in_report_order("product_performance", w["product_performance"]).collect()
    assert [r["product_id"] for r in rows] == [2, 1, 3]
    # NULLs last going up.
    w = shop(spark, [order(1), order(2, customer_id=2)], [line(1, 1), line(2, 2)],
             [{"customer_id": 1, "city": "C", "state": "S", "country": None},
              {"customer_id": 2, "city": "C", "state": "S", "country": "Z"}])
    assert [r["country"] for r in in_report_order("sales_by_region", w["sales_by_region"]).collect()] == ["Z", None]


# Mart -> columns of its order; a minus means from high to low.
REPORT_ORDERS = {
    "product_performance": "-total_revenue product_id",
    "customer_segmentation": "-total_spend customer_key",
    "sales_by_region": "country state city year_number month_number",
    "inventory_analysis": "urgency category product_name product_key warehouse_location",
    "campaign_performance": "year_number month_number -spend campaign_key",
    "ad_effectiveness": "-roas ad_key",
    "targeting_analysis": "-roas adset_key",
    "budget_utilization": "campaign_name full_date campaign_key",
}


@pytest.mark.parametrize("name", REPORT_ORDERS)
def test_all_report_orders(spark, name):
    """Sorted rows against a sort in Python, one column after the other from the last; NULLs are the highest values."""
    rows = [r.asDict() for r in queries()[f"{name}_in_order"](spark, "/root/testdata/sf0.001").collect()]
    for r in rows:
        r["urgency"] = {"Reorder": 1, "Low Stock": 2}.get(r.get("inventory_status"), 3)
    wanted = list(rows)
    for column in reversed(REPORT_ORDERS[name].split()):
        c = column.lstrip("-")
        held, empty = [r for r in wanted if r[c] is not None], [r for r in wanted if r[c] is None]
        held.sort(key=lambda r: r[c], reverse=column.startswith("-"))
        wanted = empty + held if column.startswith("-") else held + empty
    assert len(rows) > 1 and rows == wanted
