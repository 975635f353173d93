from __future__ import annotations

import os
from datetime import date, datetime
from decimal import Decimal

import pytest

from martloom.operators.staging import stage
from martloom.plans.warehouse import DIMENSIONS, FACTS, MARTS, Warehouse
from martloom.sources.files import read_csv_table, read_parquet_table, read_tables, save_table, save_view
from martloom.sources.schemas import TABLES
from martloom.sources.star import RunDates

ADSETS = '''ad_set_id,campaign_id,ad_set_name,targeting_age_min,targeting_age_max,targeting_gender,\
targeting_locations,targeting_interests,bid_strategy,bid_amount,daily_budget,start_date,end_date,status
7,3,"Say ""hi""",31,47,"ALL","Oslo,Bergen","Art,Food","COST_CAP",12.34,,2022-05-06,2022-07-08,"ACTIVE"
'''
CUSTOMERS = '''customer_id,first_name,last_name,email,phone,created_at,updated_at,address,city,state,zip_code,country
1,"A","B","a@b.c","555","2022-03-04 08:05:06","2022-11-12 13:14:15","1 Way, Town","Boston","MA","02101","USA"
2,C,D,,,2022-03-04 08:05:06,2022-11-12 13:14:15,,Newark,NJ,07102,
'''


def test_csv(spark, tmp_path):
    (tmp_path / "AdSets.csv").write_text(ADSETS)
    (tmp_path / "Customers.csv").write_text(CUSTOMERS)
    row = read_csv_table(spark, str(tmp_path), "AdSets").first()
    assert row["ad_set_name"] == 'Say "hi"' and row["targeting_locations"] == "Oslo,Bergen"
    assert row["bid_amount"] == Decimal("12.34") and row["daily_budget"] is None
    assert row["end_date"] == date(2022, 7, 8)
    first, second = read_csv_table(spark, str(tmp_path), "Customers").orderBy("customer_id").collect()
    assert (first["zip_code"], second["zip_code"]) == ("02101", "07102")
    assert first["created_at"] == datetime(2022, 3, 4, 8, 5, 6) and first["address"] == "1 Way, Town"
    assert second["email"] is None and second["country"] is None


def test_bad_csv_fails(spark, tmp_path):
    (tmp_path / "AdSets.csv").write_text(ADSETS.replace("7,3,", "seven,3,"))
    with pytest.raises(Exception, match="(?i)malformed|parse|cast"):
        read_csv_table(spark, str(tmp_path), "AdSets").collect()
    (tmp_path / "Customers.csv").write_text(CUSTOMERS.replace("first_name,last_name", "last_name,first_name"))
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_table(spark, str(tmp_path), "Customers").collect()


def test_staging_ignores_new_columns(spark, tmp_path):
    (tmp_path / "Customers.csv").write_text(CUSTOMERS)
    wider = read_csv_table(spark, str(tmp_path), "Customers").selectExpr("1 AS extra", "*")
    staged = stage("stg_customers", wider)
    assert staged.columns == list(TABLES["Customers"])
    saved = save_table(staged, str(tmp_path / "Customers.parquet"))
    assert saved.dtypes == staged.dtypes and saved.count() == 2
    assert read_parquet_table(spark, str(tmp_path), "Customers").count() == 2
    save_table(staged.limit(1), str(tmp_path / "Customers.parquet"))
    assert spark.read.parquet(str(tmp_path / "Customers.parquet")).count() == 1
    save_view(staged, "staged_customers")
    assert spark.sql("SELECT count(*) FROM staged_customers").first()[0] == 2


# Rows per model on the ten sample files, for whoever has them: set SAMPLE_CSV_DIR to their folder.
SAMPLE_ROWS = {
    "dim_customer": 100, "dim_product": 100, "dim_campaign": 50, "dim_adset": 50, "dim_ad": 50, "dim_date": 4017,
    "dim_order_status": 3, "dim_payment_method": 3, "dim_warehouse": 100, "dim_status": 2, "fact_sales": 100,
    "fact_order_summary": 99, "fact_inventory": 100, "fact_ad_performance": 50, "fact_adset_performance": 46,
    "fact_campaign_spend": 50, "product_performance": 42, "customer_segmentation": 61, "sales_by_region": 99,
    "inventory_analysis": 100, "ad_effectiveness": 27, "targeting_analysis": 25, "campaign_performance": 21,
    "budget_utilization": 42,
}


@pytest.mark.skipif("SAMPLE_CSV_DIR" not in os.environ, reason="SAMPLE_CSV_DIR is not set")
def test_sample_rows(spark):
    from martloom.operators.dimensions import CALENDAR_END, CALENDAR_START

    dates = RunDates(CALENDAR_START, CALENDAR_END, date(2024, 11, 10))
    warehouse = Warehouse(spark, read_tables(spark, os.environ["SAMPLE_CSV_DIR"]), dates)
    assert {n: warehouse[n].count() for n in (*DIMENSIONS, *FACTS, *MARTS)} == SAMPLE_ROWS
