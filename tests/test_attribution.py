"""Credit of purchases to ads, and revenue shared out, to the cent."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

from martloom.operators import extensions
from martloom.operators.attribution import CREDITS, attributed_daily, attribution_credits
from martloom.operators.shares import shared_out
from pyspark.sql import functions as F
from tests.samples import bag, by, insight, line, media, money, order, plan, shop

START = datetime(2024, 1, 10, 12)


def frames(spark, touches, purchases):
    return (
        spark.createDataFrame(touches, "person_id bigint, ad_id bigint, touched_at timestamp_ntz, touch_id bigint"),
        spark.createDataFrame(purchases, "purchase_id bigint, person_id bigint, bought_at timestamp_ntz, value decimal(18,2)"),
    )


def largest_remainders(cents: int, weights: list[int]) -> list[int]:
    total = sum(weights)
    parts = [cents * w // total for w in weights]
    rest = sorted(range(len(weights)), key=lambda k: (-(cents * weights[k] % total), k))
    for k in rest[: cents - sum(parts)]:
        parts[k] += 1
    return parts


def plain_credits(touches, purchases, back=7, half=2) -> dict:
    days = {}
    for person, ad, at, touch in touches:
        if None not in (person, ad, at):
            key = (person, ad, at.date())
            days[key] = min(days.get(key, (at, touch)), (at, touch))
    found = {}
    for purchase, person, at, value in purchases:
        if person is None or value is None:
            continue
        mine = sorted((t, ad) for (p, ad, _), t in days.items() if p == person and at - timedelta(days=back) <= t[0] < at)
        n = len(mine)
        if not n:
            continue
        ages = [(at - t[0]) // timedelta(days=1) for t, _ in mine]
        models = [
            [int(k == 0) for k in range(n)], [int(k == n - 1) for k in range(n)], [1] * n,
            [2 * (n - 2) if n > 2 and k in (0, n - 1) else 1 for k in range(n)], [2 ** ((back - a) // half) for a in ages],
        ]
        sign = -1 if value < 0 else 1
        shares = [largest_remainders(int(abs(value) * 100), w) for w in models]
        for k, (t, ad) in enumerate(mine):
            found[purchase, ad, t[0]] = tuple(sign * Decimal(s[k]) / 100 for s in shares)
    return found


def test_credits_against_a_plain_version(spark):
    draw = random.Random(1)

    def moment():
        return START + timedelta(minutes=draw.randrange(20 * 24 * 60))

    touches = [(draw.randrange(6), draw.randrange(5), moment(), n) for n in range(400)]
    touches += [(None, 1, START, 900), (1, None, START, 901), (1, 1, None, 902), touches[0]]
    purchases = [(n, draw.randrange(7), moment(), money(draw.randrange(1, 5000) / 100)) for n in range(80)]
    purchases += [(900, None, START, money(5)), (901, 1, START, None), (902, 1, START + timedelta(days=9), money(-7.01)), (903, 2, START + timedelta(days=9), money(0))]
    # Exactly at the start of the look-back interval, and exactly at the purchase.
    touches += [(50, 1, START, 950), (50, 2, START + timedelta(days=7), 951)]
    purchases += [(950, 50, START + timedelta(days=7), money(3))]
    df = attribution_credits(*frames(spark, touches, purchases))
    got = {(r["purchase_id"], r["ad_id"], r["touched_at"]): tuple(r[c] for c in CREDITS) for r in df.collect()}
    assert got == plain_credits(touches, purchases) and len(got) == df.count()
    sums = defaultdict(lambda: [Decimal(0)] * len(CREDITS))
    for (purchase, _, _), credit in got.items():
        sums[purchase] = [a + b for a, b in zip(sums[purchase], credit, strict=True)]
    values = {p: v for p, _, _, v in purchases}
    assert sums and all(set(s) == {values[p]} for p, s in sums.items())


def test_touches_of_a_day_count_once_and_no_range_join(spark):
    often = [(1, 1, START + timedelta(seconds=n), n) for n in range(500)] + [(1, 2, START - timedelta(hours=2), 999)]
    touches, purchases = frames(spark, often, [(1, 1, START + timedelta(hours=5), money(1))])
    df = attribution_credits(touches, purchases)
    assert by(df, "ad_id")[1]["linear_credit"] == money(0.5) and df.count() == 2
    assert "NestedLoop" not in plan(df) and "CartesianProduct" not in plan(df)
    assert attribution_credits(touches.where("false"), purchases).collect() == []
    assert attribution_credits(touches, purchases.where("false")).collect() == []


def test_shares_add_up(spark):
    draw = random.Random(2)
    rows = [(k, n, money(whole), draw.choice([0, 0, 1, 3, 7])) for k, whole in enumerate((100, 0.05, 0, -33.33, 12345678.91)) for n in range(7)]
    rows += [(90, 0, None, 1), (91, 0, money(5), 0), (92, 0, money(5), 3)]
    df = spark.createDataFrame(rows, "k int, n int, whole decimal(28,2), w bigint")
    got = shared_out(df, "whole", {"part": F.col("w"), "even": F.lit(1)}, ["k"], ["n"])
    assert got.columns == ["k", "n", "whole", "w", "part", "even"]
    held = defaultdict(list)
    for r in got.orderBy("k", "n").collect():
        held[r["k"]].append(r)
    for k, group in held.items():
        whole = group[0]["whole"]
        for name, weights in (("part", [r["w"] for r in group]), ("even", [1] * len(group))):
            if whole is None or not sum(weights):
                assert {r[name] for r in group} == {None}, k
                continue
            sign = -1 if whole < 0 else 1
            assert [r[name] for r in group] == [sign * Decimal(c) / 100 for c in largest_remainders(int(abs(whole) * 100), weights)]
            assert sum(r[name] for r in group) == whole


def sales_and_ads(spark):
    ads = [{"ad_id": n, "ad_set_id": 1 + n % 3} for n in range(1, 7)]
    adsets = [{"ad_set_id": n, "campaign_id": 1 + n % 2} for n in (1, 2, 3)]
    insights = [
        *[insight(10 + n, n, "2024-02-01", spend=n, conversions=n) for n in range(1, 4)],
        *[insight(20 + n, n, "2024-02-02", spend=n) for n in range(1, 4)],
        *[insight(30 + n, n, "2024-02-03") for n in range(1, 4)],
        insight(40, 1, "2024-02-04", spend=1),
    ]
    m = media(spark, insights, ads=ads, adsets=adsets)
    orders = [order(n, day=f"2024-02-0{n}", total=total) for n, total in ((1, 100), (2, 0.05), (3, 10))]
    w = shop(spark, orders, [line(n, n) for n in (1, 2, 3)])
    return m, w


def test_revenue_of_a_day_is_shared_out(spark):
    m, w = sales_and_ads(spark)
    df = extensions.sales_ads_daily(m["fact_ad_performance"], w["fact_order_summary"], *m.hierarchy)
    shares = {(r["date"].day, r["ad_set_id"]): r["revenue_share"] for r in df.collect()}
    # By conversions, by spend, equally, and no revenue at all; ad n is in set 1 + n % 3.
    assert [shares[1, s] for s in (2, 3, 1)] == [money("16.67"), money("33.33"), money("50.00")]
    assert sorted(shares[2, s] for s in (1, 2, 3)) == [money("0.01"), money("0.02"), money("0.02")]
    assert sorted(shares[3, s] for s in (1, 2, 3)) == [money("3.33"), money("3.33"), money("3.34")]
    assert shares[4, 2] is None
    per_day = defaultdict(Decimal)
    for (day, _), share in shares.items():
        per_day[day] += share or 0
    assert per_day == {1: money(100), 2: money("0.05"), 3: money(10), 4: 0}


def test_credits_are_part_of_the_daily_table(spark):
    m, w = sales_and_ads(spark)
    at = datetime(2024, 2, 2, 9)
    touches, purchases = frames(spark, [(1, 1, at, 1), (1, 2, at, 2), (1, 3, at, 3)], [
        (1, 1, at + timedelta(hours=1), money(10)), (2, 1, at + timedelta(days=4), money("0.05")),
    ])
    credits = attribution_credits(touches, purchases)
    plainly = extensions.sales_ads_daily(m["fact_ad_performance"], w["fact_order_summary"], *m.hierarchy)
    df = extensions.sales_ads_daily(m["fact_ad_performance"], w["fact_order_summary"], *m.hierarchy, credits)
    assert df.agg(*[F.sum(c).alias(c) for c in CREDITS]).first().asDict() == {c: money("10.05") for c in CREDITS}
    spent = df.where("total_spend > 0 OR total_conversions > 0 OR revenue_share IS NOT NULL").select(plainly.columns)
    assert bag(spent) == bag(plainly.where("total_spend > 0 OR total_conversions > 0 OR revenue_share IS NOT NULL"))
    only_credit = df.where(F.col("date") == F.lit(date(2024, 2, 6))).collect()
    assert len(only_credit) == 3 and {r["total_spend"] for r in only_credit} == {money(0)}
    days = attributed_daily(credits, *m.hierarchy)
    assert {(r["date"].day, r["ad_set_id"]) for r in days.collect()} == {(2, 1), (2, 2), (2, 3), (6, 1), (6, 2), (6, 3)}


def test_shares_are_sorted_once_by_key(spark):
    """One list per key serves all parts: no sort for each weight, and no wide rows in one."""
    df = spark.createDataFrame([(1, n, 10) for n in range(4)], "k int, n int, whole int").selectExpr("k", "n", "CAST(whole AS DECIMAL(18,2)) AS whole")
    got = shared_out(df, "whole", {"a": F.col("n"), "b": F.lit(1), "c": F.lit(2)}, ["k"], ["n"])
    text = plan(got)
    assert "Window" not in text and text.count("Exchange hashpartitioning") == 1
    assert [tuple(map(float, r[3:])) for r in got.orderBy("n").collect()] == [
        (0.0, 2.5, 2.5), (1.67, 2.5, 2.5), (3.33, 2.5, 2.5), (5.0, 2.5, 2.5)
    ]


def test_odd_cents_of_equal_touches_go_by_place(spark):
    """A purchase that is listed twice: its rows differ by their place only, and the first gets the cent that is left."""
    touches = spark.sql("SELECT 1L person_id, 56L ad_id, TIMESTAMP_NTZ'2024-01-01 08:00:00' touched_at, 5L touch_id")
    once = spark.sql("SELECT 92L purchase_id, 1L person_id, TIMESTAMP_NTZ'2024-01-01 12:00:00' bought_at, CAST(45.01 AS DECIMAL(18,2)) value")
    got = attribution_credits(touches, once.union(once)).orderBy("first_credit").collect()
    assert [[str(r[c]) for c in CREDITS] for r in got] == [
        ["0.00", "45.01", "22.50", "22.50", "22.50"], ["45.01", "0.00", "22.51", "22.51", "22.51"]
    ]
