from __future__ import annotations

from decimal import Decimal

from martloom.operators import facts
from tests.samples import at, bag, by, insight, line, media, money, only, order, shop, spent


def test_sales_need_every_dimension(spark):
    orders = [
        order(1), order(2, customer_id=9), order(3, day="2031-01-01"), order(4, status=None),
        order(5, payment_method=None), order(6, day="2024-02-01T23:59:59"),
    ]
    lines = [line(i, i) for i in range(1, 7)] + [line(7, 1, product_id=9), line(8, 99)]
    w = shop(spark, orders, lines)
    assert sorted(r["order_item_id"] for r in w["fact_sales"].collect()) == [1, 6]
    assert sorted(r["order_id"] for r in w["fact_order_summary"].collect()) == [1, 6]
    assert by(w["fact_sales"], "order_item_id")[6]["order_date_key"] == 20240201


def test_order_without_lines_vanishes(spark):
    w = shop(spark, [order(1), order(2)], [line(1, 1), line(2, 1)])
    assert only(w["fact_order_summary"])["order_item_count"] == 2


def test_given_status_lists_give_the_same_keys(spark):
    """Looking keys up in the stored lists is the same as deriving them; a shortened list drops its orders."""
    orders = [order(1), order(2, status="Open"), order(3, status=None), order(4, payment_method="Cash")]
    w = shop(spark, orders, [line(i, i) for i in range(1, 5)])
    args = (w["stg_order_items"], w["stg_orders"], w["dim_customer"], w["dim_product"], w["dim_date"])
    joined = facts.fact_sales(*args, status=w["dim_order_status"], payment_method=w["dim_payment_method"])
    assert bag(joined.select(w["fact_sales"].columns)) == bag(w["fact_sales"])
    few = w["dim_order_status"].where("status_id = 'Open'")
    assert [r["order_id"] for r in facts.fact_sales(*args, status=few).collect()] == [2]
    # The list itself keeps its NULL row.
    assert w["dim_order_status"].count() == 3


def test_incremental_filter_comes_first(spark):
    w = shop(spark, [order(1), order(2, day="2024-03-01"), order(3, day="2024-03-02")],
             [line(i, i) for i in range(1, 4)])
    later = w.fact("fact_sales", after=at("2024-03-01"))
    assert [r["order_id"] for r in later.collect()] == [3]
    assert bag(later) == bag(w["fact_sales"].where("order_id = 3"))


def test_inventory(spark):
    stock = [
        {"inventory_id": 1, "product_id": 1, "warehouse_location": "W", "last_restocked": at("2024-05-05T10:00:00")},
        {"inventory_id": 2, "product_id": 1, "warehouse_location": None},
        {"inventory_id": 3, "product_id": 9, "warehouse_location": "W"},
    ]
    w = shop(spark, [order(1)], [line(1, 1)], inventory=stock)
    row = only(w["fact_inventory"])
    assert (row["inventory_id"], row["date_key"], row["source_system"]) == (1, 20240505, "RAW_DATA")
    listed = facts.fact_inventory(w["stg_inventory"], w["dim_product"], w["dim_date"], w["dim_warehouse"])
    assert bag(listed.select(w["fact_inventory"].columns)) == bag(w["fact_inventory"])


def test_ad_ratios_without_denominator(spark):
    w = media(spark, [insight(1), insight(2, impressions=200, clicks=4, spend=8, conversions=2, value=20, reach=100),
                      insight(3, spend=5), insight(4, ad_id=77, clicks=1)])
    found = by(w["fact_ad_performance"], "performance_id")
    assert set(found) == {1, 2, 3}
    ratios = ("calculated_ctr", "cost_per_click", "avg_conversion_value", "roas")
    assert [found[1][r] for r in ratios] == [0.0] * 4
    assert [found[2][r] for r in ratios] == [2.0, 2.0, 10.0, 2.5]
    assert [found[3][r] for r in ratios] == [0.0] * 4


def test_ad_set_facts_add_up(spark):
    ads = [{"ad_id": 1, "ad_set_id": 1}, {"ad_id": 2, "ad_set_id": 1}, {"ad_id": 3, "ad_set_id": 99}]
    rows = [insight(1, 1, impressions=10, clicks=1, spend="1.10", reach=5),
            insight(2, 1, impressions=20, clicks=2, spend="2.20", reach=5),
            insight(3, 2, impressions=30, clicks=3, spend="3.30", reach=10), insight(4, 3, clicks=9)]
    w = media(spark, rows, ads=ads)
    row = only(w["fact_adset_performance"])
    assert (row["impressions"], row["clicks"], row["spend"], row["reach"]) == (60, 6, Decimal("6.60"), 20)
    assert (row["ctr"], row["frequency"], row["conversion_rate"], row["cost_per_conversion"]) == (10.0, 3.0, 0.0, 0.0)
    total = w["fact_ad_performance"].agg({"spend": "sum"}).first()[0]
    assert total == row["spend"]


def test_spend_keeps_unknown_ad_sets(spark):
    w = media(spark, spend=[spent(1), spent(2, ad_set_id=None), spent(3, ad_set_id=55, budget=0),
                            spent(4, campaign_id=55)])
    found = by(w["fact_campaign_spend"], "spend_id")
    assert set(found) == {1, 2, 3}
    assert found[1]["adset_key"] and found[2]["adset_key"] is None and found[3]["adset_key"] is None
    assert [found[i]["budget_utilization_percentage"] for i in (1, 2, 3)] == [50.0, 50.0, 0.0]


def test_ad_set_without_campaign_is_left_out(spark):
    w = media(spark, adsets=[{"ad_set_id": 1, "campaign_id": 1}, {"ad_set_id": 2, "campaign_id": 77}])
    assert [r["ad_set_id"] for r in w["dim_adset"].collect()] == [1]
    assert [r["ad_id"] for r in w["dim_ad"].collect()] == [1]


def test_status_list(spark):
    w = media(spark, campaigns=[{"campaign_id": 1, "status": "ACTIVE"}],
              adsets=[{"ad_set_id": 1, "campaign_id": 1, "status": "ACTIVE"}],
              ads=[{"ad_id": 1, "ad_set_id": 1, "status": "DELETED"}, {"ad_id": 2, "ad_set_id": 1, "status": "odd"},
                   {"ad_id": 3, "ad_set_id": 1, "status": None}])
    found = by(w["dim_status"], "status")
    assert {s: r["status_description"] for s, r in found.items()} == {
        "ACTIVE": "Currently running", "DELETED": "Deleted from the system", "odd": "Other status",
        None: "Other status",
    }


def test_cost_and_price_are_kept(spark):
    w = shop(spark, [order(1)], [line(1, 1)])
    row = only(w["dim_product"])
    assert (row["price"], row["cost"], row["is_current"], row["expiration_date"]) == (money(10), money(4), True, None)
