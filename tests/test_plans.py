"""What the plans look like, and that a hot key is split."""

from __future__ import annotations

import os
from contextlib import contextmanager
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from martloom.operators.incremental import FactTable
from martloom.operators.report_order import in_report_order
from martloom.session import INITIAL_PARTITIONS, size_shuffles, stored_bytes, tune, work_folder
from martloom.sources.schemas import TABLES, ddl
from tests.samples import DATES, bag, plan, shop

FOLDER = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_scans_are_pruned(spark):
    text = plan(queries()["product_preferences"](spark, FOLDER))
    assert "FileScan parquet [l_orderkey#" in text and "l_extendedprice" not in text and "l_shipdate" not in text
    text = plan(queries()["customer_metrics"](spark, FOLDER))
    assert "FileScan parquet [l_orderkey#" in text and "l_partkey" not in text


def test_filters_reach_the_scan(spark, tmp_path):
    w = shop(spark, [], [])
    sales = spark.createDataFrame([], w["fact_sales"].schema)
    sales.write.parquet(str(tmp_path / "sales"))
    from martloom.operators.sales_marts import sales_velocity

    text = plan(sales_velocity(spark.read.parquet(str(tmp_path / "sales")), w["dim_product"], w["dim_date"],
                               DATES.as_of))
    assert "GreaterThanOrEqual(order_date_key,20240402)" in text


def test_top_category_is_picked_before_the_shuffle(spark):
    text = plan(queries()["customer_segmentation"](spark, FOLDER))
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


def test_order_joins_share_one_partitioning(spark):
    """Lines of a full build are shuffled by order once, for both facts and for the regional sums."""
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(queries()["product_preferences"](spark, FOLDER))
        # Lines, their headers, the summaries' headers, and the line counts.
        assert text.count("Exchange hashpartitioning(order_id") == 4
        text = plan(queries()["regional_sales"](spark, FOLDER))
        assert text.count("Exchange hashpartitioning(order_id") == 2


@pytest.fixture(scope="module")
def hot(spark):
    """A shop where one order, one product and one customer hold a third of everything."""
    spread = spark.range(0, 60000, 1, 8)
    columns = {
        "Order_Items": {
            "order_item_id": "id", "order_id": "CASE WHEN id % 3 = 0 THEN 0 ELSE id DIV 4 END",
            "product_id": "CASE WHEN id % 3 = 1 THEN 0 ELSE id % 500 END", "quantity": "1",
            "unit_price": "5", "line_item_total": "id % 100",
        },
        "Orders": {
            "order_id": "id", "customer_id": "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 800 END",
            "order_date": "DATE '2024-01-01' + CAST(id % 300 AS INT)", "grand_total": "id % 50",
            "status": "'Delivered'", "payment_method": "'Card'", "shipping_address": "sha2(CAST(id AS STRING), 512)",
        },
        "Products": {"product_id": "id", "price": "3", "cost": "1", "category": "CAST(id % 7 AS STRING)"},
        "Customers": {"customer_id": "id", "city": "'C'", "state": "'S'", "country": "'L'"},
    }
    sizes = {"Order_Items": 60000, "Orders": 15000, "Products": 500, "Customers": 800}

    def made(name):
        exprs = [f"CAST({columns[name].get(c, 'NULL')} AS {kind}) AS {c}" for c, kind in TABLES[name].items()]
        return spark.createDataFrame(spread.where(f"id < {sizes[name]}").selectExpr(*exprs).collect(), ddl(name))

    inputs = {name: made(name).repartition(8) for name in columns}
    w = shop(spark, [], [])
    w.inputs.update(inputs)
    return w


SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
}


@pytest.mark.parametrize("name", ["fact_sales", "fact_order_summary", "customer_segmentation", "sales_by_region"])
def test_hot_keys_are_split(spark, hot, name):
    """With thresholds as small as the data, the hot keys are split, and the result is the same."""
    tune(spark)
    expected = bag(hot[name])
    with settings(spark, **SPLIT):
        df = hot.fact(name) if name.startswith("fact") else hot.mart(name)
        assert bag(df) == expected
        df.collect()
        assert "skew=true" in plan(df)


def test_ties_do_not_make_one_range(spark):
    """Two thirds of the rows share one value of the leading sort column."""
    rows = spark.range(30000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 0.0 ELSE id END AS roas", "sha(CAST(id AS STRING)) AS ad_key"
    )
    with settings(spark, **{"spark.sql.adaptive.enabled": "false"}):
        sizes = in_report_order("ad_effectiveness", rows).rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
    assert max(sizes) < 10000


def test_given_orders_filter_before_the_lines(spark):
    """An incremental load joins the new orders below the product lookup, a full build above it."""
    w = shop(spark, [], [])
    text = plan(w.fact("fact_sales", after=DATES.as_of))
    assert text.index("Join [product_id") < text.index("Join [order_id")
    text = plan(w.fact("fact_sales"))
    assert text.index("Join [order_id") < text.index("Join [product_id")


def test_work_folder_is_the_shared_one():
    def session(shared, checkpoints, master):
        context = SimpleNamespace(getCheckpointDir=lambda: checkpoints, master=master)
        return SimpleNamespace(conf={"spark.checkpoint.dir": shared}, sparkContext=context)

    one, two = (work_folder(session("s3://shared/", None, "yarn"), "x") for _ in range(2))
    assert one.startswith("s3://shared/x-") and one != two
    assert work_folder(session(None, "hdfs://c", "yarn"), "x").startswith("hdfs://c/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_folder(session(None, None, "yarn"), "x")
    assert "martloom-" in work_folder(session(None, None, "local[2]"), "x")


def test_writes_are_rebalanced(spark, tmp_path):
    table = FactTable(spark, str(tmp_path), "id", "day", F.lit(202401))
    rows = spark.range(8).select(F.col("id").cast("string").alias("id"), F.current_date().alias("day"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(table.balanced(rows.withColumn("period", table.period)))


def test_shuffles_grow_with_the_input(spark):
    with settings(spark, **{"spark.sql.shuffle.partitions": "8", INITIAL_PARTITIONS: "8"}):
        assert size_shuffles(spark, 5 << 20) == 8
        assert size_shuffles(spark, 3 << 40) == 3 << 10
        assert spark.conf.get(INITIAL_PARTITIONS) == str(3 << 10)
        assert size_shuffles(spark, 1 << 50) == 1 << 20
        assert size_shuffles(spark, 0) == 8
    path = f"{FOLDER}/orders.parquet"
    assert stored_bytes(spark.read.parquet(path)) == os.path.getsize(path)


def test_own_settings_are_kept(spark):
    fresh = spark.newSession()
    fresh.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    tune(fresh)
    assert fresh.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
    assert fresh.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def test_shuffles_grow_with_small_inputs_too(spark):
    """A task sorts no more of 6 GB than of 1 GB."""
    with settings(spark, **{"spark.sql.shuffle.partitions": "8", INITIAL_PARTITIONS: "8"}):
        assert size_shuffles(spark, 1 << 30) == 64 and size_shuffles(spark, 6 << 30) == 384


def test_broadcasts_are_bounded_by_rows_in_memory(spark, tmp_path):
    """Half a million rows whose files are small are not sent through the driver."""
    fresh = tune(spark.newSession())
    keys = fresh.range(500_000).selectExpr("id AS k", "md5(CAST(id % 10 AS STRING)) AS v")
    keys.write.parquet(str(tmp_path / "keys"))
    stored = fresh.read.parquet(str(tmp_path / "keys"))
    assert (10 << 20) / 8 < stored_bytes(stored) < 10 << 20
    text = plan(fresh.range(1 << 24).selectExpr("id % 7 AS k").join(stored, "k"))
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
