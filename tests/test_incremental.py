from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martloom.operators import facts
from martloom.operators.incremental import FactTable, latest_per_key, month_of_key
from tests.samples import at, bag, insight, line, media, order, plan, shop, spent

SCHEMA = "id string, day date, date_key int, value int"


def rows(spark, *values):
    data = [(i, date.fromisoformat(d), int(d.replace("-", "")), v) for i, d, v in values]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def stored(spark, tmp_path):
    return FactTable(spark, str(tmp_path / "fact"), "id", "day", month_of_key("date_key"))


def contents(table) -> dict:
    found = [(r["id"], (str(r["day"]), r["value"])) for r in table.read().collect()]
    assert len(dict(found)) == len(found)
    return dict(found)


def files(folder) -> set:
    return {str(p) for p in Path(folder).rglob("*.parquet")}


def test_empty_table(spark, stored):
    assert stored.read() is None and stored.high_water() is None
    stored.upsert(rows(spark, ("a", "2024-01-01", 1)).where("false"))
    assert stored.read() is None and stored.high_water() is None
    seen = []
    stored.load(lambda mark: seen.append(mark) or rows(spark, ("a", "2024-01-01", 1)))
    assert seen == [None] and contents(stored) == {"a": ("2024-01-01", 1)}


def test_upsert_replaces_by_key(spark, stored):
    stored.upsert(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 1), ("c", "2024-02-01", 1)))
    stored.upsert(rows(spark, ("b", "2024-03-01", 2), ("d", "2024-02-05", 2)))
    assert contents(stored) == {
        "a": ("2024-01-01", 1), "b": ("2024-03-01", 2), "c": ("2024-02-01", 1), "d": ("2024-02-05", 2)
    }
    assert stored.high_water() == date(2024, 3, 1)
    assert {r["id"] for r in stored.read(first_period=202402).collect()} == {"b", "c", "d"}
    assert stored.read().dtypes == rows(spark, ("a", "2024-01-01", 1)).dtypes


def test_same_rows_again_change_nothing(spark, stored):
    batch = rows(spark, ("a", "2024-01-01", 1), ("b", "2024-02-02", 1))
    stored.upsert(batch)
    once = contents(stored)
    stored.upsert(batch)
    assert contents(stored) == once


def test_new_rows_rewrite_no_old_files(spark, stored):
    stored.upsert(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-02-02", 1)))
    before = {p: Path(p).stat().st_mtime_ns for p in files(f"{stored.folder}/data")}
    stored.upsert(rows(spark, ("c", "2024-02-03", 1)))
    assert before.items() <= {p: Path(p).stat().st_mtime_ns for p in files(f"{stored.folder}/data")}.items()
    assert not any("kind=kept" in p for p in files(f"{stored.folder}/data"))
    assert len(contents(stored)) == 3


def test_only_touched_months_are_rewritten(spark, stored):
    stored.upsert(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 1), ("c", "2024-02-02", 1)))
    stored.upsert(rows(spark, ("b", "2024-03-02", 2)))
    kept = {p.split("period=")[1][:6] for p in files(f"{stored.folder}/data") if "kind=kept" in p}
    assert kept == {"202401"}


def test_unfinished_load_is_invisible(spark, stored):
    stored.upsert(rows(spark, ("a", "2024-01-01", 1)))
    # What a load leaves that dies before its log entry: data without a version.
    rows(spark, ("z", "2024-05-01", 9)).selectExpr("*", "202405 AS period").write.partitionBy("period").parquet(
        f"{stored.folder}/data/version=2/kind=new"
    )
    assert contents(stored) == {"a": ("2024-01-01", 1)}
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        stored.upsert(rows(spark, ("b", "2024-01-05", 2)))
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert contents(stored) == {"a": ("2024-01-01", 1), "b": ("2024-01-05", 2)}


def test_late_rows_need_a_look_back(spark, stored):
    source = rows(spark, ("a", "2024-01-10", 1), ("late", "2024-01-05", 1), ("same", "2024-01-10", 1),
                  ("new", "2024-01-11", 1))

    def build(known):
        return lambda mark: facts.newer(known, "day", mark)

    stored.load(build(source.where("id = 'a'")))
    stored.load(build(source))
    assert set(contents(stored)) == {"a", "new"}
    stored.load(build(source), look_back_days=10)
    assert set(contents(stored)) == {"a", "new", "late", "same"}


def test_latest_per_key(spark):
    batch = rows(spark, ("a", "2024-01-01", 5), ("a", "2024-01-03", 1), ("a", "2024-01-03", 2), ("b", "2024-01-01", 1))
    got = {r["id"]: (str(r["day"]), r["value"]) for r in latest_per_key(batch, "id", "day").collect()}
    assert got == {"a": ("2024-01-03", 2), "b": ("2024-01-01", 1)}


def test_fact_in_two_loads_is_the_fact_in_one(spark, tmp_path):
    orders = [order(i, day=f"2024-0{m}-1{i % 3}T0{i % 9}:00:00") for i, m in enumerate((1, 1, 2, 3, 3, 4), 1)]
    lines = [line(i, 1 + i % 6) for i in range(1, 14)]
    w = shop(spark, orders, lines)
    key, time_column, date_key = facts.LOADS["fact_sales"]
    table = FactTable(spark, str(tmp_path / "sales"), key, time_column, month_of_key(date_key))
    early = shop(spark, [o for o in orders if o["order_date"] < at("2024-03-01")], lines)
    table.load(lambda mark: early.fact("fact_sales", mark))
    assert 0 < table.read().count() < 13
    table.load(lambda mark: w.fact("fact_sales", mark))
    assert bag(table.read().select(w["fact_sales"].columns)) == bag(w["fact_sales"])
    # A row that moved above the mark replaces its old state; a change of a row below it does not arrive.
    changed = [{**o, "order_date": at("2024-06-01")} if o["order_id"] == 1 else {**o, "status": "Gone"} for o in orders]
    table.load(lambda mark: shop(spark, changed, lines).fact("fact_sales", mark))
    dates = {r["order_id"]: r["order_date_key"] for r in table.read().collect()}
    assert dates[1] == 20240601 and table.read().count() == 13
    assert table.read().select("status_key").distinct().count() == 1


def test_lines_of_new_orders(spark):
    """Lines thinned out by order id: the same rows, and nothing runs while the query is set up."""
    orders = [order(i, day=f"2024-01-0{i}") for i in range(1, 6)]
    w = shop(spark, orders, [line(i, 1 + i % 5) for i in range(1, 12)])
    after = at("2024-01-02")
    assert bag(w.fact("fact_sales", after)) == bag(w["fact_sales"].where("order_date > '2024-01-02'"))
    assert bag(w.fact("fact_order_summary", after)) == bag(
        w["fact_order_summary"].where("order_date > '2024-01-02'")
    )
    assert "LeftSemi" in plan(w.fact("fact_sales", after))


def test_key_that_comes_twice_in_a_batch(spark, stored):
    """The latest row of a key stays, in the first load and in a later one."""
    stored.upsert(rows(spark, ("a", "2024-01-01", 1), ("a", "2024-01-03", 2), ("b", "2024-01-02", 3)))
    stored.upsert(rows(spark, ("b", "2024-02-02", 4), ("b", "2024-02-01", 5)))
    assert contents(stored) == {"a": ("2024-01-03", 2), "b": ("2024-02-02", 4)}


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
def test_mark_does_not_depend_on_the_zone(spark, tmp_path, zone):
    orders = [order(1, day="2024-01-02T12:00:00"), order(2, day="2024-01-02T13:00:00")]
    w = shop(spark, orders, [line(1, 1), line(2, 2)])
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        table = FactTable(spark, str(tmp_path / "f"), "sales_key", "order_date", month_of_key("order_date_key"))
        table.upsert(w["fact_sales"].where("order_id = 1"))
        assert [r["order_id"] for r in w.fact("fact_sales", table.high_water()).collect()] == [2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_two_runs(spark, tmp_path):
    """A second run adds what is new and leaves the rest; its marts are those of the models."""
    orders = [order(i, day=f"2024-0{i}-01") for i in range(1, 5)]
    lines = [line(i, 1 + i % 4) for i in range(1, 9)]
    stock = [{"inventory_id": 1, "product_id": 1, "warehouse_location": "W", "quantity_available": 5}]
    ads = media(spark, [insight(1, spend=3), insight(2, day="2024-02-03", clicks=1)], [spent(1), spent(2, budget=0)])

    def warehouse(orders):
        return shop(spark, orders, lines, inventory=stock, **ads.inputs)

    first = warehouse(orders[:2]).run(str(tmp_path))
    assert first["fact_order_summary"].count() == 2
    second = warehouse(orders).run(str(tmp_path))
    whole = warehouse(orders)
    for name in (*facts.LOADS, "product_performance", "inventory_analysis", "budget_utilization"):
        assert bag(second[name].select(whole[name].columns)) == bag(whole[name]), name
    assert second.run(str(tmp_path))["fact_sales"].count() == 8
    at_noon = at("2024-07-01T12:00:00")
    third = warehouse(orders).run(str(tmp_path / "stamped"), run_ts=at_noon)
    for name, column in (("dim_ad", "dw_insert_date"), ("fact_sales", "dw_update_date"), ("budget_utilization", "analysis_date")):
        assert {r[column] for r in third[name].select(column).collect()} == {at_noon}, name


def test_run_without_rows(spark, tmp_path):
    ads = media(spark)
    kept = shop(spark, [], [], **ads.inputs).run(str(tmp_path))
    assert kept["fact_sales"].count() == 0 and kept["product_performance"].count() == 0


# ---- the key index --------------------------------------------------------------------------------------------------


def many_rows(spark, first: int, last: int, day: str = "2024-01-01", value: int = 1):
    ids = spark.range(first, last).selectExpr("concat('k', id) AS id", f"DATE '{day}' AS day")
    return ids.selectExpr("*", "year(day) * 10000 + month(day) * 100 + day(day) AS date_key", f"{value} AS value")


def test_index_knows_the_period_of_every_key(spark, tmp_path):
    table = FactTable(spark, str(tmp_path), "id", "day", month_of_key("date_key"), bucket_keys=40)
    table.upsert(many_rows(spark, 0, 300))
    table.upsert(many_rows(spark, 250, 400, "2024-03-05", 2))
    live = table.live()
    assert live.bits >= 3 and sum(n for _, n in live.index.values()) == 400
    known = {(r["id"], r["period"]) for r in table.known_keys(live, set(live.index)).collect()}
    assert known == {(f"k{k}", 202403 if k >= 250 else 202401) for k in range(400)}
    stored = {(r["id"], r["value"]) for r in table.read().collect()}
    assert stored == {(f"k{k}", 2 if k >= 250 else 1) for k in range(400)} and table.read().count() == 400


@pytest.mark.parametrize("size", [400, 6400])
def test_a_load_reads_the_buckets_of_its_keys_only(spark, tmp_path, size):
    """Keys and bytes of the index that a small load reads do not grow with the stored table."""
    table = FactTable(spark, str(tmp_path), "id", "day", month_of_key("date_key"), bucket_keys=50)
    table.upsert(many_rows(spark, 0, size))
    live = table.live()
    load = many_rows(spark, 7, 9, "2024-05-05")
    buckets = table._buckets_of(load.select("id"), live.bits)
    opened = table.known_keys(live, buckets)
    assert len(buckets) <= 2 and opened.count() <= 2 * 4 * 50
    read = sum(Path(f.removeprefix("file://")).stat().st_size for f in opened.inputFiles())
    assert 0 < read < 12_000
    before = files(f"{tmp_path}/keys")
    table.upsert(load)
    written = {p.split("bucket=")[1].split("/")[0] for p in files(f"{tmp_path}/keys") - before}
    assert {int(b) for b in written} <= buckets


def test_rows_may_be_removed_by_key(spark, stored):
    stored.upsert(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 1), ("c", "2024-02-01", 1)))
    gone = spark.createDataFrame([("a",), ("c",), ("zz",)], "id string")
    stored.upsert(rows(spark, ("c", "2024-02-01", 5)), gone=gone)
    assert contents(stored) == {"b": ("2024-01-02", 1), "c": ("2024-02-01", 5)}
    stored.upsert(rows(spark, ("x", "2024-01-01", 1)).where("false"), gone=spark.createDataFrame([("b",)], "id string"))
    assert contents(stored) == {"c": ("2024-02-01", 5)}


def test_a_table_from_before_the_index_gets_one(spark, stored):
    stored.upsert(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-02-02", 1)))
    live = stored.live()
    entries = [(live.version, period, path) for period, path in live.data]
    old = spark.createDataFrame(entries, "version int, period int, path string").drop("version").coalesce(1)
    old.write.mode("overwrite").parquet(f"{stored.folder}/log/version={live.version}")
    assert stored.live().index == {} and set(contents(stored)) == {"a", "b"}
    stored.upsert(rows(spark, ("a", "2024-03-01", 2)))
    assert contents(stored) == {"a": ("2024-03-01", 2), "b": ("2024-02-02", 1)}
    assert sum(n for _, n in stored.live().index.values()) == 2


def test_a_dead_load_leaves_the_index_as_it_was(spark, stored):
    stored.upsert(rows(spark, ("a", "2024-01-01", 1)))
    spark.createDataFrame([("a", 202405)], "id string, period int").write.parquet(f"{stored.folder}/keys/version=2/bucket=0")
    stored.upsert(rows(spark, ("a", "2024-02-01", 2)))
    assert contents(stored) == {"a": ("2024-02-01", 2)}


def test_a_load_shuffles_its_rows_once(spark, tmp_path, monkeypatch):
    """Nothing sorts the rows of a load by key, and an index that is written anew is written once."""
    from martloom.operators import incremental

    monkeypatch.setattr(incremental, "latest_per_key", None)
    table = FactTable(spark, str(tmp_path), "id", "day", month_of_key("date_key"), bucket_keys=40)
    table.upsert(many_rows(spark, 0, 300))
    table.upsert(many_rows(spark, 300, 400, "2024-03-05", 2))
    assert table.read().count() == 400
    indexes = {p.name for p in Path(tmp_path, "keys").iterdir()}
    assert indexes == {"version=1-packed", "version=2-packed"}


def test_periods_may_be_replaced_whole(spark, stored, monkeypatch):
    stored.upsert(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 1), ("c", "2024-02-01", 1), ("d", "2024-03-01", 1)))
    with_rows = stored._store
    kept = []
    monkeypatch.setattr(stored, "_store", lambda df, path: kept.append(path.split("kind=")[1]) or with_rows(df, path))
    # January is built again, without b, and c has moved into it.
    stored.upsert(rows(spark, ("a", "2024-01-01", 2), ("c", "2024-01-09", 2)), replaced=[202401])
    assert contents(stored) == {"a": ("2024-01-01", 2), "c": ("2024-01-09", 2), "d": ("2024-03-01", 1)}
    assert kept == ["new", "kept"] and sum(n for _, n in stored.live().index.values()) == 3
    stored.upsert(rows(spark, ("x", "2024-01-01", 1)).where("false"), replaced=[202401, 202403])
    assert stored.read() is None
    stored.upsert(rows(spark, ("b", "2024-04-01", 3)))
    assert contents(stored) == {"b": ("2024-04-01", 3)}


def test_states_of_a_key_in_several_periods(spark, stored):
    stored.upsert(rows(spark, ("a", "2024-01-01", 1), ("a", "2024-02-03", 2), ("b", "2024-01-02", 3), ("c", "2024-03-01", 4)))
    assert contents(stored) == {"a": ("2024-02-03", 2), "b": ("2024-01-02", 3), "c": ("2024-03-01", 4)}
    assert {r["period"] for r in stored.known_keys(stored.live(), {0}).where("id = 'a'").collect()} == {202402}


def test_keys_are_packed_one_to_one(spark):
    from martloom.functions.keys import packed, unpacked

    hashed = "00ff" * 8
    texts = [None, "", "a", hashed, hashed.upper(), hashed[:-1], hashed + "0", "z" * 32, "0123456789abcdef", "=" * 17, "é-1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed(F.col("t")).alias("p"))
    got = df.select("t", "p", unpacked("p").alias("back")).collect()
    assert [r["back"] for r in got] == [r["t"] for r in got]
    assert len({bytes(r["p"]) for r in got if r["t"] is not None}) == len(texts) - 1
    assert [len(r["p"]) for r in got if r["t"] == hashed] == [16]


def shuffle_files(spark) -> set:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p for f in folders for p in Path(f.getPath()).rglob("shuffle_*.data")}


def test_a_load_leaves_no_shuffle_files(spark, stored):
    """Rows dealt by month and keys dealt by bucket are gone when the load is done, also of a load that replaces rows."""
    before = shuffle_files(spark)
    stored.upsert(many_rows(spark, 0, 5000))
    stored.upsert(many_rows(spark, 4000, 6000, "2024-03-05", 2))
    assert stored.read().count() == 6000
    left = {p for p in shuffle_files(spark) - before if p.stat().st_size > 2000}
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_rows_may_come_in_parts(spark, stored):
    """Parts become visible together; a key that two parts have stays once, and an empty part is no harm."""
    nothing = many_rows(spark, 0, 1).where("false")
    stored.upsert([many_rows(spark, 0, 30), nothing, many_rows(spark, 20, 50, "2024-02-01", 2)])
    assert stored.live().version == 1
    assert {(r["id"], r["value"]) for r in stored.read().collect()} == {(f"k{k}", 2 if k >= 20 else 1) for k in range(50)}
    assert stored.read().count() == 50 and sum(n for _, n in stored.live().index.values()) == 50
    stored.upsert([nothing, nothing])
    assert stored.live().version == 1


def test_a_fact_in_parts_is_the_fact(spark, tmp_path):
    """Orders and lines of large files are built part by part: together all rows, each once, none in two parts."""
    from martloom.plans.warehouse import MOST_PARTS

    orders = [order(i, day=f"2024-0{1 + i % 4}-11") for i in range(1, 60)]
    w = shop(spark, orders, [line(i, 1 + i % 70) for i in range(1, 200)])
    for name in ("Orders", "Order_Items"):
        w.inputs[name].write.parquet(f"{tmp_path}/{name}")
        w.inputs[name] = spark.read.parquet(f"{tmp_path}/{name}")
    for name, after in (("fact_sales", at("2024-02-20")), ("fact_order_summary", None)):
        parts = w.fact_in_parts(name, after, part_bytes=1)
        assert len(parts) == MOST_PARTS and len(w.fact_in_parts(name, after)) == 1
        rows = [bag(part) for part in parts]
        assert sorted(r for part in rows for r in part) == bag(w.fact(name, after)) and sum(map(bool, rows)) > 2
    key, time_column, date_key = facts.LOADS["fact_sales"]
    table = FactTable(spark, str(tmp_path / "sales"), key, time_column, month_of_key(date_key))
    table.load(lambda mark: w.fact_in_parts("fact_sales", mark, part_bytes=1))
    assert bag(table.read().select(w["fact_sales"].columns)) == bag(w["fact_sales"])
