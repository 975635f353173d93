from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from martloom.operators import extensions, history
from martloom.sources.star import SCHEMAS
from tests.samples import by, insight, line, media, money, order, shop, spent


def test_validity_periods(spark):
    seen = [(1, 1, 5), (1, 2, 5), (1, 4, 6), (1, 5, None), (1, 6, None), (1, 9, 5), (2, 3, 1)]
    df = spark.createDataFrame([(k, date(2024, 1, d), p) for k, d, p in seen], "id int, day date, price int")
    got = sorted(
        (r["id"], r["effective_date"].day, r["expiration_date"] and r["expiration_date"].day, r["price"],
         r["is_current"])
        for r in history.validity_periods(df, "id", "day", "price").collect()
    )
    assert got == [(1, 1, 4, 5, False), (1, 4, 5, 6, False), (1, 5, 9, None, False), (1, 9, None, 5, True),
                   (2, 3, None, 1, True)]


def test_price_periods_keep_every_price_of_a_day(spark):
    seen = [(1, 1, 5), (1, 1, 7), (1, 1, 6), (1, 2, 7), (1, 4, 7), (1, 4, 8), (1, 5, 2), (1, 6, None), (2, 3, 1), (2, 4, 1)]
    df = spark.createDataFrame([(k, date(2024, 1, d), p) for k, d, p in seen * 2], "product_id int, day date, price int")
    got = sorted(
        (r["product_id"], r["effective_date"].day, r["price"], r["expiration_date"] and r["expiration_date"].day, r["is_current"])
        for r in history.price_periods(df).collect()
    )
    assert got == [(1, 1, 5, 1, False), (1, 1, 6, 1, False), (1, 1, 7, 4, False), (1, 4, 8, 5, False), (1, 5, 2, None, True),
                   (2, 3, 1, None, True)]
    assert history.price_periods(df.where("false")).collect() == []


def touches(spark, *rows):
    start = datetime(2024, 1, 1)
    data = [(i, start + timedelta(minutes=m), u, k, v, "") for i, (m, u, k, v) in enumerate(rows)]
    found = by(history.touch_attribution(spark.createDataFrame(data, SCHEMAS["events"])), "touch")
    return {t: (r["first_touch_purchases"], r["last_touch_purchases"], round(r["linear_purchases"], 6),
                r["first_touch_value"], r["last_touch_value"]) for t, r in found.items()}


def test_attribution_within_and_across_hours(spark):
    got = touches(
        spark,
        (0, 1, "purchase", 9.0),                               # nothing before it
        (1, 1, "view", 0.0), (2, 1, "view", 0.0), (3, 1, "click", 0.0),
        (4, 1, "purchase", 10.0),                              # view first, click last, 2/3 and 1/3
        (4, 1, "click", 0.0),                                  # same minute, later event: after the purchase
        (200, 1, "purchase", 1.0),                             # hours later, no touch in its own hour
        (700, 1, "view", 0.0), (701, 1, "purchase", 2.0),      # last touch in its hour, the rest carried over
        (0, 2, "click", 0.0), (90, 2, "error", 0.0), (100, 2, "purchase", 4.0),
    )
    assert got["view"] == (3, 1, round(2 / 3 + 1 / 2 + 3 / 5, 6), Decimal("13.00"), Decimal("2.00"))
    assert got["click"] == (1, 3, round(1 / 3 + 1 / 2 + 2 / 5 + 1, 6), Decimal("4.00"), Decimal("15.00"))


def test_customers_and_orders(spark):
    customers = [{"customer_id": 1}, {"customer_id": 2}]
    w = shop(spark, [order(1, total=5), order(2, day="2024-01-03", total=7), order(3)],
             [line(1, 1, total=10, quantity=2), line(2, 1, total=3), line(3, 2, product_id=8)], customers)
    ltv = by(extensions.customer_ltv(w["stg_customers"], w["stg_orders"]), "customer_id")
    assert (ltv[1]["first_order_date"], ltv[1]["total_ltv"]) == (date(2024, 1, 3), Decimal("112.00"))
    assert (ltv[2]["first_order_date"], ltv[2]["total_ltv"]) == (None, Decimal("0.00"))
    profit = by(extensions.orders_with_profit(w["stg_orders"], w["stg_order_items"], w["stg_products"]), "order_id")
    assert set(profit) == {1}
    assert (profit[1]["total_revenue"], profit[1]["total_profit"]) == (Decimal("13.00"), Decimal("1.00"))


def test_ad_days_and_acquisition_cost(spark):
    m = media(spark, [insight(1, spend=3, clicks=2), insight(2, spend=4), insight(3, 2, "2024-02-02", value=9)],
              [spent(1, amount=60), spent(2, day="2024-03-01", amount=5)])
    w = shop(spark, [order(1, total=20), order(2, 2, "2024-02-20"), order(3, 2, "2024-04-01", 1)], [line(1, 1)])
    ads = by(extensions.ads_daily(m["fact_ad_performance"], *m.hierarchy), "ad_id")
    assert (ads[1]["spend"], ads[1]["cpc"], ads[1]["campaign_id"]) == (money(7), 3.5, 1)
    days = by(extensions.sales_ads_daily(m["fact_ad_performance"], w["fact_order_summary"], *m.hierarchy), "date")
    assert days[date(2024, 2, 1)]["store_revenue"] == money(20) and days[date(2024, 2, 2)]["store_revenue"] is None
    assert days[date(2024, 2, 2)]["total_attributed_revenue"] == money(9)
    cost = by(extensions.acquisition_cost(m["stg_ad_spend"], w["stg_orders"]), "month_start")
    assert {k.month: (r["total_spend"], r["new_customers"], r["cac"]) for k, r in cost.items()} == {
        2: (money(60), 2, 30.0), 3: (money(5), 0, None)
    }


def test_attribution_within_one_second_and_between_seconds(spark):
    got = touches(
        spark,
        (0, 1, "view", 0.0), (0, 1, "purchase", 1.0), (0, 1, "click", 0.0), (0, 1, "purchase", 2.0),
        (0.5, 1, "purchase", 4.0),                             # another second of the same hour
    )
    assert got["view"] == (3, 1, 2.0, Decimal("7.00"), Decimal("1.00"))
    assert got["click"] == (0, 2, 1.0, None, Decimal("6.00"))
