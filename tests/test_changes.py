"""Loads that follow late, corrected and deleted source rows by digests of periods."""

from __future__ import annotations

from datetime import date
from pathlib import Path

from pyspark.sql import functions as F

from martloom.operators.changes import Source, changed_periods, period_digests
from martloom.operators.incremental import FactTable, month_of_key
from martloom.plans.warehouse import SOURCES
from tests.samples import bag, line, order, plan, shop


def digests(spark, rows, details=()):
    main = spark.createDataFrame(rows, "id int, at date, a string, b string").select("id", F.col("at").cast("timestamp_ntz").alias("at"), "a", "b")
    parts = spark.createDataFrame(list(details), "id int, v string")
    return period_digests({"main": main, "parts": parts}, Source("main", "at", "parts", "id"))


BASE = [(1, date.fromisoformat("2024-01-05"), "x", None), (2, date.fromisoformat("2024-01-06"), "y", "z"), (3, date.fromisoformat("2024-02-01"), "x", "y"), (4, None, "x", "y")]


def test_digests_see_every_kind_of_change(spark):
    parts = [(1, "p"), (1, "q"), (3, "r"), (77, "s")]
    before = digests(spark, BASE, parts)

    def changed(rows, details=parts):
        return changed_periods(before, digests(spark, rows, details))

    assert changed(list(reversed(BASE)), list(reversed(parts))) == []
    assert changed([*BASE, (5, date.fromisoformat("2023-12-31"), "new", "")]) == [202312]
    assert changed(BASE[1:]) == [202401] and changed([]) == [202401, 202402]
    assert changed([(1, date.fromisoformat("2024-01-05"), None, "x"), *BASE[1:]]) == [202401]  # values that changed places
    assert changed([(1, date.fromisoformat("2024-02-05"), "x", None), *BASE[1:]]) == [202401, 202402]
    assert changed([*BASE, BASE[2], BASE[2]]) == [202402]  # an even number of equal rows
    assert changed(BASE, [(1, "p"), (1, "Q"), (3, "r")]) == [202401]
    assert changed(BASE, [(1, "p"), (1, "q")]) == [202402]
    assert changed(BASE, [*parts, (99, "of no row")]) == []
    assert changed([*BASE, (6, None, "no", "time")]) == []


def test_late_changed_and_deleted_rows_arrive(spark, tmp_path):
    orders = [order(n, day=f"2024-0{1 + n % 4}-1{n % 5}") for n in range(1, 13)]
    lines = [line(n, 1 + n % 12) for n in range(1, 30)]
    table = FactTable(spark, str(tmp_path), "sales_key", "order_date", month_of_key("order_date_key"))

    def load(orders, lines):
        w = shop(spark, orders, lines)
        periods = w.load_changes("fact_sales", table)
        stored = table.read()
        assert ([] if stored is None else bag(stored.select(w["fact_sales"].columns))) == bag(w["fact_sales"])
        return periods

    months = sorted({200000 + 2400 + o["order_date"].month for o in orders})
    late = [o for o in orders if o["order_id"] != 4]
    assert load(late, lines) == months
    files = {p: p.stat().st_mtime_ns for p in Path(tmp_path, "data").rglob("*.parquet")}
    assert load(late, lines) == [] and table.live().version == 1
    # An order that comes late, in a month before the newest one.
    assert load(orders, lines) == [202401]
    untouched = {p: t for p, t in files.items() if "period=202401" not in str(p)}
    assert untouched and all(p.stat().st_mtime_ns == t for p, t in untouched.items())
    live = {path for period, path in table.live().data if period != 202401}
    assert all("version=1" in p for p in live)
    # A line whose amount is corrected, a line that is deleted, and an order that moves to another month.
    fixed = [{**r, "quantity": 9} if r["order_item_id"] == 5 else r for r in lines if r["order_item_id"] != 6]
    assert len(load(orders, fixed)) == 2
    moved = [order(1, day="2024-04-20") if o["order_id"] == 1 else o for o in orders]
    assert load(moved, fixed) == [202402, 202404]
    assert load([], fixed) == months and table.read() is None


def test_a_load_that_died_before_its_digests_is_repeated(spark, tmp_path):
    table = FactTable(spark, str(tmp_path), "sales_key", "order_date", month_of_key("order_date_key"))
    w = shop(spark, [order(1), order(2, day="2024-03-01")], [line(1, 1), line(2, 2)])
    table.upsert(w.fact_of_periods("fact_sales", [202402]))
    assert w.load_changes("fact_sales", table) == [202402, 202403]
    assert bag(table.read().select(w["fact_sales"].columns)) == bag(w["fact_sales"])


def test_runs_that_follow_corrections(spark, tmp_path):
    from tests.samples import insight, media, spent

    ads = media(spark, [insight(1, spend=3)], [spent(1)])

    def run(total):
        w = shop(spark, [order(1, total=total), order(2, day="2024-03-01")], [line(1, 1), line(2, 2)], **ads.inputs)
        return w.run(str(tmp_path), corrections=True), w

    run(10)
    kept, whole = run(77)
    assert bag(kept["fact_order_summary"].select(whole["fact_order_summary"].columns)) == bag(whole["fact_order_summary"])


def test_digests_fold_before_they_shuffle(spark):
    w = shop(spark, [order(1)], [line(1, 1)])
    for name, source in SOURCES.items():
        if source.table in ("Orders", "Inventory"):
            text = plan(period_digests(w.inputs, source))
            assert text.count("partial_bit_xor") >= 1, name


def test_budget_mart_is_built_again_for_changed_campaigns_only(spark, tmp_path):
    from martloom.operators.stored_marts import StoredMart
    from tests.samples import insight, media, spent

    campaigns = [{"campaign_id": n, "campaign_name": f"c{n}"} for n in range(1, 7)]
    adsets = [{"ad_set_id": n, "campaign_id": n} for n in range(1, 7)]
    ads = [{"ad_id": n, "ad_set_id": n} for n in range(1, 7)]
    table = StoredMart(spark, str(tmp_path), "campaign_key", "full_date")

    def load(spends, insights, named=campaigns):
        w = media(spark, insights, spends, ads, adsets, named)
        built = w.update_budget(table)
        stored = table.read()
        assert ([] if stored is None else bag(stored.select(w["budget_utilization"].columns))) == bag(w["budget_utilization"])
        return built

    spends = [spent(10 * n + d, n, n, f"2024-02-0{d}") for n in range(1, 7) for d in (1, 2, 3)]
    insights = [insight(n, n, conversions=n, value=5) for n in range(1, 7)]
    assert load(spends, insights) == 6
    before = {p: p.stat().st_mtime_ns for p in Path(tmp_path, "rows", "data").rglob("*.parquet")}
    assert load(spends, insights) == 0
    # A late day of one campaign, and a conversion of another: its lifetime figures stand in all its rows.
    assert load([*spends, spent(99, 2, 2, "2024-01-15")], [*insights, insight(77, 5, "2024-02-02", conversions=1, value=9)]) == 2
    live = {path for _, path in table.table.live().data}
    kept = [p for p in before if any(str(p).startswith(path.removeprefix("file:")) for path in live)]
    assert kept and all(p.stat().st_mtime_ns == before[p] for p in kept)
    renamed = [{**c, "campaign_name": "other"} if c["campaign_id"] == 3 else c for c in campaigns]
    assert load(spends, insights, renamed) == 3
    assert load([s for s in spends if s["campaign_id"] != 4], insights, renamed) == 1
    assert load([], [], renamed) == 6
