"""Type-2 histories from snapshots in any order, and facts that find the version valid on their day."""

from __future__ import annotations

import random
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martloom.operators import facts
from martloom.operators.as_of import as_of, with_version
from martloom.operators.versions import HistoryTable
from tests.samples import line, money, order, plan, table

DAYS = [date(2024, 1, 10), date(2024, 2, 10), date(2024, 2, 20), date(2024, 4, 1)]


def snapshot(spark, states: dict):
    return spark.createDataFrame([(k, p, f"n{k}") for k, p in states.items()], "id int, price int, name string")


def history(spark, folder, loads, **choices):
    kept = HistoryTable(spark, str(folder), "id", ["price"], **choices)
    for day, states in loads:
        kept.load(snapshot(spark, states), day)
    return kept


def periods(df) -> list:
    found = [(r["id"], r["price"], r["effective_date"], r["expiration_date"], r["is_current"]) for r in df.collect()]
    assert len({r["version_key"] for r in df.select("version_key").collect()}) == len(found)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_history(loads) -> list:
    """The same from all snapshots at once."""
    known = dict(loads)
    days, found = sorted(known), []
    for k in sorted({k for states in known.values() for k in states}):
        open_row = None
        for day in days:
            state = (known[day][k],) if k in known[day] else None
            if open_row and state != open_row[1]:
                found.append((k, open_row[1][0], open_row[0], day, False))
                open_row = None
            if state and not open_row:
                open_row = (day, state)
        if open_row:
            found.append((k, open_row[1][0], open_row[0], None, True))
    return found


def test_a_price_that_goes_and_comes_back_gives_three_versions(spark, tmp_path):
    loads = list(zip(DAYS, [{1: 5, 2: 7}, {1: 6, 2: 7}, {1: 5, 2: 7, 3: 1}], strict=False))
    kept = history(spark, tmp_path, loads)
    first, second, third = DAYS[:3]
    assert periods(kept.read()) == [
        (1, 5, first, second, False), (1, 6, second, third, False), (1, 5, third, None, True),
        (2, 7, first, None, True), (3, 1, third, None, True),
    ]
    assert {(r["id"], r["price"]) for r in kept.current().collect()} == {(1, 5), (2, 7), (3, 1)}
    assert kept.days() == DAYS[:3]


@pytest.mark.parametrize("order", [(0, 2, 1), (2, 1, 0)])
def test_order_of_arrival_does_not_matter(spark, tmp_path, order):
    loads = list(zip(DAYS, [{1: 5, 2: 7, 4: 1}, {1: 6, 3: 2, 4: None}, {1: 5, 2: 7, 3: 2, 4: 1}], strict=False))
    assert periods(history(spark, tmp_path, [loads[k] for k in order]).read()) == plain_history(loads)


def test_random_snapshots_against_a_plain_version(spark, tmp_path):
    draw = random.Random(8)
    for n in range(1):
        loads = [(day, {k: draw.choice([1, 2]) for k in range(12) if draw.random() < 0.8}) for day in DAYS]
        arrival = draw.sample(loads, len(loads))
        kept = history(spark, tmp_path / str(n), arrival)
        assert periods(kept.read()) == plain_history(loads)
        # A corrected snapshot replaces that of its day.
        day, states = draw.choice(loads)
        corrected = {**states, 0: 9, 99: 3}
        kept.load(snapshot(spark, corrected), day)
        assert periods(kept.read()) == plain_history([x for x in loads if x[0] != day] + [(day, corrected)])


def test_missing_rows_may_stay(spark, tmp_path):
    loads = [(DAYS[0], {1: 5, 2: 7}), (DAYS[1], {1: 6})]
    kept = history(spark, tmp_path, loads, closes_missing=False)
    assert periods(kept.read())[-1] == (2, 7, DAYS[0], None, True)


def test_odd_snapshots(spark, tmp_path):
    kept = HistoryTable(spark, str(tmp_path), "id", ["price"])
    assert kept.read() is None and kept.current() is None and kept.days() == []
    kept.load(snapshot(spark, {}).where("false"), DAYS[0])
    rows = spark.createDataFrame([(1, 5, "a"), (1, 5, "a"), (None, 3, "x"), (2, None, None)], "id int, price int, name string")
    kept.load(rows, DAYS[1])
    assert periods(kept.read()) == [(1, 5, DAYS[1], None, True), (2, None, DAYS[1], None, True)]
    kept.load(snapshot(spark, {}).where("false"), DAYS[2])
    assert periods(kept.read()) == [(1, 5, DAYS[1], DAYS[2], False), (2, None, DAYS[1], DAYS[2], False)]
    with pytest.raises(ValueError):
        kept.load(rows.withColumn("state", F.lit(1)), DAYS[3])


def test_untracked_columns_open_no_version(spark, tmp_path):
    kept = history(spark, tmp_path, [(DAYS[0], {1: 5})])
    kept.load(snapshot(spark, {1: 5}).withColumn("name", F.lit("other")), DAYS[1])
    [row] = kept.read().collect()
    assert (row["name"], row["effective_date"]) == ("n1", DAYS[0])


def test_a_load_of_today_opens_no_closed_part(spark, tmp_path):
    kept = history(spark, tmp_path, [(DAYS[0], {1: 5, 2: 1}), (DAYS[1], {1: 6, 2: 1}), (DAYS[3], {1: 7, 2: 1})])
    closed = {p: p.stat().st_mtime_ns for p in Path(tmp_path).rglob("period=20*/*.parquet")}
    kept.load(snapshot(spark, {1: 8, 2: 1}), date(2024, 5, 1))
    assert closed.items() <= {p: p.stat().st_mtime_ns for p in Path(tmp_path).rglob("period=20*/*.parquet")}.items()
    assert len(closed) == 2 and all("period=0" in f for f in kept.current().inputFiles())


# ---- as of ----------------------------------------------------------------------------------------------------------


def asked(spark, rows):
    return spark.createDataFrame([(k, d, n) for n, (k, d) in enumerate(rows)], "k int, day date, n int")


def known(spark, rows):
    return spark.createDataFrame(rows, "k int, since date, value string")


def plain_as_of(times, versions) -> list:
    found = []
    for n, (k, day) in enumerate(times):
        valid = [(since, v) for key, since, v in versions if key == k and since is not None and day is not None and since <= day]
        if k is not None and valid:
            found.append((n, k, day, max(valid)[1]))
    return found


def test_as_of_against_a_plain_version(spark):
    draw = random.Random(4)
    start = date(2023, 12, 20)

    def day():
        return start + timedelta(days=draw.randrange(100))

    for _ in range(4):
        versions = {(draw.randrange(4), day()): f"v{n}" for n in range(25)}
        versions = [(k, d, None if n % 7 == 0 else v) for n, ((k, d), v) in enumerate(versions.items())]
        times = [(draw.randrange(5), day()) for _ in range(150)] + [(None, start), (1, None)]
        got = with_version(asked(spark, times), known(spark, [*versions, (None, start, "x"), (2, None, "y")]), "k", "day", "since", ["value"])
        assert sorted(tuple(r) for r in got.select("n", "k", "day", "value").collect()) == sorted(plain_as_of(times, versions), key=lambda r: r[0])


def test_as_of_at_the_edges_of_months(spark):
    versions = [(1, date(2024, 1, 31), "a"), (1, date(2024, 2, 1), "b"), (1, date(2024, 5, 31), "c")]
    times = [(1, date(2024, m, d)) for m, d in ((1, 30), (1, 31), (2, 1), (2, 29), (3, 1), (5, 30), (5, 31), (6, 1))]
    got = with_version(asked(spark, times), known(spark, versions), "k", "day", "since", ["value"]).orderBy("n").collect()
    assert [(r["n"], r["value"]) for r in got] == list(zip(range(1, 8), "abbbbcc", strict=False))[:5] + [(6, "c"), (7, "c")]
    empty = known(spark, versions).where("false")
    assert as_of(asked(spark, times), empty, "k", "day", "since", ["value"]).collect() == []
    assert as_of(asked(spark, times).where("false"), known(spark, versions), "k", "day", "since", ["value"]).collect() == []


def sold(spark):
    orders = [order(n, day=str(date(2024, 1, 1) + timedelta(days=7 * n))) for n in range(30)]
    # A third of all lines are of one product.
    lines = [line(n, n % 30, product_id=1 if n % 3 == 0 else 2 + n % 8, quantity=2, total=50) for n in range(240)]
    history = [
        (p, f"{p}-{d}", money(10 * p + d), money(p), date(2024, d, 15), None, d == 5) for p in range(1, 8) for d in (2, 3, 5)
    ]
    schema = "product_id bigint, version_key string, price decimal(18,2), cost decimal(18,2), effective_date date, expiration_date date, is_current boolean"
    return table(spark, "Orders", *orders), table(spark, "Order_Items", *lines), spark.createDataFrame(history, schema), orders, lines


def test_sales_find_the_version_of_their_day(spark):
    orders, lines, history, order_rows, line_rows = sold(spark)
    df = facts.fact_sales_as_of(lines, orders, history)
    days = {o["order_id"]: o["order_date"].date() for o in order_rows}
    got = {r["order_item_id"]: r for r in df.collect()}
    assert set(got) == {str(r["order_item_id"]) if isinstance(next(iter(got)), str) else r["order_item_id"] for r in line_rows if r["product_id"] < 8}
    for r in line_rows:
        if r["product_id"] >= 8:
            continue
        day, found = days[r["order_id"]], got[r["order_item_id"]]
        month = max([m for m in (2, 3, 5) if date(2024, m, 15) <= day], default=2)
        assert (found["order_day"], found["list_price"], found["version_since"]) == (
            day, money(10 * r["product_id"] + month), date(2024, month, 15)
        )
        assert found["line_profit"] == money(50 - 2 * r["product_id"])
    text = plan(df)
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_sorted_sequences_hold_distinct_days_only(spark):
    """What one task sorts of a hot product does not grow with its lines."""
    orders, lines, history, _, _ = sold(spark)
    many = lines.crossJoin(spark.range(50)).drop("id")
    times = many.join(orders.select("order_id", F.to_date("order_date").alias("day")), "order_id")
    found = as_of(times, history.withColumnRenamed("effective_date", "since"), "product_id", "day", "since", ["price"])
    assert found.count() == found.select("product_id", "day").distinct().count() <= 8 * 30


def test_a_version_is_shuffled_once_however_many_days_are_asked_for(spark):
    """Versions of many years, found by year and then by day; nothing is made for the months that facts lie in."""
    start = date(2001, 1, 1)
    versions = [(1, start + timedelta(days=n), f"v{n}") for n in range(0, 4000, 37)] + [(2, start + timedelta(days=400), "w")]
    times = [(1 + n % 2, start + timedelta(days=n * 11 - 20)) for n in range(400)] + [(3, start), (None, start), (1, None)]
    got = with_version(asked(spark, times), known(spark, versions), "k", "day", "since", ["value"])
    assert sorted(tuple(r) for r in got.select("n", "k", "day", "value").collect()) == sorted(plain_as_of(times, versions), key=lambda r: r[0])
    assert plan(got).count("Exchange hashpartitioning") == 2 and "Window" not in plan(got)
