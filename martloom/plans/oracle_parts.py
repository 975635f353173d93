"""The models as SQL for a second engine, used only to check results.

Each part is one SELECT over input tables and other parts. They say in plain joins and groupings what a model means;
the DataFrame code is free to do it in another way. Ratios are doubles, money is DECIMAL, as in the DataFrame code.
"""

from __future__ import annotations

import re

from martloom.functions import rules
from martloom.functions.keys import NULL_PART, SEPARATOR
from martloom.operators import quality
from martloom.sources import star


def key(*columns: str) -> str:
    parts = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '{NULL_PART}')" for c in columns)
    return f"md5(concat_ws('{SEPARATOR}', {parts}))"


def dbl(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def over(top: str, bottom: str, scale: int | None = None) -> str:
    """Ratio, 0 without a positive denominator."""
    times = f" * {dbl(str(scale))}" if scale else ""
    return f"CASE WHEN {bottom} > 0 THEN {dbl(top)} / {dbl(bottom)}{times} ELSE {dbl('0')} END"


def per(top: str, bottom: str) -> str:
    """Ratio, NULL for a denominator of 0."""
    return f"({dbl(top)} / NULLIF({dbl(bottom)}, 0))"


def total(value: str, kind: str = "BIGINT") -> str:
    return f"CAST(SUM({value}) AS {kind})"


def money(value: str) -> str:
    return total(value, "DECIMAL(28,2)")


def avg(value: str) -> str:
    return f"(CAST(SUM({value}) AS DOUBLE) / CAST(COUNT({value}) AS DOUBLE))"


def avg_ratio(value: str) -> str:
    units = f"CAST({value} * 1e12 AS DECIMAL(38,0))"
    return f"(CAST(SUM({units}) AS DOUBLE) / (CAST(COUNT({value}) AS DOUBLE) * 1e12))"


def cents(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


def basis(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(9,4))"


def dec(value: str) -> str:
    return f"CAST({value} AS DECIMAL(18,2))"


def steps(value: str, comparison: str, limits, otherwise: str) -> str:
    cases = " ".join(f"WHEN {value} {comparison} {limit} THEN '{label}'" for limit, label in limits)
    return f"CASE {cases} ELSE '{otherwise}' END"


def stamp(text: str) -> str:
    return f"CAST('{text}' AS TIMESTAMP)"


AS_OF = "(SELECT CAST(MAX(o_orderdate) AS DATE) + 1 FROM orders)"
VALID = "CAST(NULL AS TIMESTAMP) AS expiration_date, TRUE AS is_current"
SOURCE = f"'{rules.SOURCE_SYSTEM}' AS source_system"
PRICE = dec("l_extendedprice")
OFF, TAX = "CAST(l_discount AS DECIMAL(4,2))", "CAST(l_tax AS DECIMAL(4,2))"
SPEND = f"CASE WHEN event_type IN ('click', 'view') THEN {dec('value')} END"
AGE = (
    "CASE "
    + " ".join(
        f"WHEN targeting_age_min < {low} AND targeting_age_max < {high} THEN '{label}'"
        for low, high, label in rules.AGE_RANGES
    )
    + f" WHEN targeting_age_min >= {rules.AGE_OLDEST[0]} THEN '{rules.AGE_OLDEST[1]}' ELSE '{rules.AGE_ELSE}' END"
)
AD_SUMS = ", ".join(
    f"{money(c) if c in ('spend', 'conversion_value') else total(c)} AS {c}"
    for c in ("impressions", "clicks", "spend", "conversions", "conversion_value", "reach")
)
AD_RATES = ", ".join(
    f"{sql} AS {name}"
    for name, sql in {
        "ctr": over("clicks", "impressions", 100),
        "cpc": over("spend", "clicks"),
        "cpm": over("spend", "impressions", 1000),
        "cost_per_conversion": over("spend", "conversions"),
        "roas": over("conversion_value", "spend"),
    }.items()
)
CVR = f"{over('conversions', 'clicks', 100)} AS conversion_rate"


def score(weights) -> str:
    click, conversion, value = weights
    return (
        f"(({over('clicks', 'impressions')}) * {dbl(str(click))} + ({over('conversions', 'clicks')})"
        f" * {dbl(str(conversion))} + ({over('conversion_value', 'spend')}) * {dbl(str(value))})"
    )


def roas_index(present: str, group: str) -> str:
    return (
        f"CASE WHEN {present} IS NOT NULL AND {group}.spend > 0 AND m.spend > 0"
        f" THEN {per('m.conversion_value', 'm.spend')}"
        f" / NULLIF({per(f'{group}.conversion_value', f'{group}.spend')}, 0) * {dbl('100')} ELSE {dbl('100')} END"
    )


PARTS: dict[str, str] = {}

# ---- inputs ----------------------------------------------------------------------------------------------------

PARTS["stg_customers"] = f"""
SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
       'c' || c_custkey || '@example.com' AS email, '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
       {stamp('1994-01-01 00:00:00')} AS created_at, {stamp('1994-06-01 00:00:00')} AS updated_at,
       c_custkey || ' Main St' AS address, c_mktsegment AS city, n_name AS state,
       lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code, r_name AS country
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"""

PARTS["stg_products"] = f"""
SELECT p_partkey AS product_id, p_name AS product_name, p_name || ' ' || p_type AS description, p_type AS category,
       {dec('p_retailprice')} AS price, {dec(dec('p_retailprice') + ' * CAST(1.60 AS DECIMAL(3,2))')} AS cost,
       'SKU-' || p_size || '-' || p_partkey AS sku, {stamp('1994-01-01 00:00:00')} AS created_at,
       {stamp('1994-06-01 00:00:00')} AS updated_at, p_size > 2 AS is_active, p_brand AS vendor
FROM part"""

PARTS["stg_orders"] = f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
       {dec('grand_total - tax_amount - shipping_amount + discount_amount')} AS total_amount, o_orderstatus AS status,
       o_orderkey || ' ' || n_name AS shipping_address, n_name || '-' || (o_orderkey % 4) AS shipping_city,
       n_name AS shipping_state,
       CASE WHEN n_name IS NOT NULL THEN lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') END AS shipping_zip,
       r_name AS shipping_country, o_orderpriority AS payment_method, tax_amount, shipping_amount, discount_amount,
       grand_total
FROM (SELECT *, {dec('o_totalprice')} AS grand_total,
             {dec(dec('o_totalprice') + ' * CAST(0.08 AS DECIMAL(3,2))')} AS tax_amount,
             {dec(dec('o_totalprice') + ' * CAST(0.05 AS DECIMAL(3,2))')} AS discount_amount,
             {dec('CASE WHEN o_orderkey % 3 = 0 THEN 10 ELSE 0 END')} AS shipping_amount FROM orders) o
LEFT JOIN nation ON o_orderkey % 7 <> 0 AND n_nationkey = o_orderkey % 25
LEFT JOIN region ON r_regionkey = n_regionkey"""

PARTS["stg_order_items"] = f"""
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_shipdate AS DATE)
           AS order_item_id,
       l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
       {cents(f'CAST({PRICE} * 100 AS BIGINT) // CAST(l_quantity AS BIGINT)')} AS unit_price,
       {dec(f'{PRICE} * (1 - {OFF}) * {TAX}')} AS line_item_tax, {dec('0')} AS line_item_shipping,
       {dec(f'{PRICE} * {OFF}')} AS line_item_discount, {dec(f'{PRICE} * (1 - {OFF}) * (1 + {TAX})')} AS line_item_total
FROM lineitem"""

PARTS["stg_inventory"] = """
SELECT l_partkey || '-' || l_suppkey AS inventory_id, l_partkey AS product_id,
       CAST(SUM(CAST(l_quantity AS BIGINT)) % 200 AS INTEGER) AS quantity_available, p_size AS reorder_level,
       MAX(l_shipdate) AS last_restocked, s_name AS warehouse_location
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
GROUP BY l_partkey, l_suppkey, p_size, s_name"""

PARTS["stg_campaigns"] = f"""
SELECT campaign_id, 'Campaign ' || campaign_id AS campaign_name,
       CASE campaign_id % 3 WHEN 0 THEN 'CONVERSIONS' WHEN 1 THEN 'REACH' ELSE 'TRAFFIC' END AS objective,
       ['ACTIVE', 'PAUSED', 'COMPLETED', 'ARCHIVED'][campaign_id % 4 + 1] AS status,
       CASE WHEN campaign_id % 2 = 0 THEN 'DAILY' ELSE 'LIFETIME' END AS budget_type,
       CASE WHEN campaign_id % 2 = 0 THEN {dec('100 + 10 * campaign_id')} END AS daily_budget,
       CASE WHEN campaign_id % 2 = 1 THEN {dec('5000 + 100 * campaign_id')} END AS lifetime_budget,
       DATE '2024-01-01' AS start_date, DATE '2024-03-31' AS end_date,
       {stamp('2023-12-15 09:00:00')} AS created_at, {stamp('2023-12-20 09:00:00')} AS updated_at
FROM (SELECT DISTINCT user_id % 50 % 10 AS campaign_id FROM events)"""

PARTS["stg_adsets"] = f"""
SELECT ad_set_id, ad_set_id % 10 AS campaign_id, 'Ad set ' || ad_set_id AS ad_set_name,
       CAST(16 + ad_set_id * 7 % 45 AS INTEGER) AS targeting_age_min,
       CAST(21 + ad_set_id * 7 % 45 + ad_set_id % 20 AS INTEGER) AS targeting_age_max,
       ['ALL', 'FEMALE', 'MALE', NULL][ad_set_id % 4 + 1] AS targeting_gender,
       CASE WHEN ad_set_id % 2 = 0 THEN 'New York,Boston' ELSE 'Austin,Denver' END AS targeting_locations,
       CASE WHEN ad_set_id % 6 <> 5 THEN 'Interest ' || (ad_set_id % 6) || ',Shopping' END AS targeting_interests,
       CASE WHEN ad_set_id % 2 = 0 THEN 'LOWEST_COST' ELSE 'COST_CAP' END AS bid_strategy,
       {dec('5 + ad_set_id')} AS bid_amount, {dec('20 + 10 * (ad_set_id % 20)')} AS daily_budget,
       DATE '2024-01-01' AS start_date, DATE '2024-03-31' AS end_date,
       ['ACTIVE', 'PAUSED', 'DELETED'][ad_set_id % 3 + 1] AS status
FROM (SELECT DISTINCT user_id % 50 AS ad_set_id FROM events)"""

PARTS["stg_ads"] = f"""
SELECT ad_id, ad_id % 50 AS ad_set_id, 'Ad ' || ad_id AS ad_name,
       ['IMAGE', 'VIDEO', 'CAROUSEL'][ad_id % 3 + 1] AS ad_type, 'Text ' || ad_id AS creative_primary_text,
       'Headline ' || ad_id AS creative_headline, 'Description ' || ad_id AS creative_description,
       'example.com/' || ad_id AS display_url, 'https://www.example.com/' || ad_id AS destination_url,
       ['ACTIVE', 'PAUSED', 'IN_REVIEW', 'ARCHIVED'][ad_id % 4 + 1] AS status,
       {stamp('2023-12-16 10:00:00')} AS created_at, {stamp('2023-12-21 10:00:00')} AS updated_at
FROM (SELECT DISTINCT user_id AS ad_id FROM events)"""

PARTS["ad_days"] = f"""
SELECT user_id AS ad_id, CAST(ts AS DATE) AS date, COUNT(*) FILTER (event_type = 'view') AS views,
       COUNT(*) FILTER (event_type = 'click') AS clicks, COUNT(*) FILTER (event_type = 'purchase') AS conversions,
       COALESCE({total(SPEND, 'DECIMAL(18,2)')}, 0) AS spend,
       COALESCE(CAST(SUM({dec('value')}) FILTER (event_type = 'purchase') AS DECIMAL(18,2)), 0) AS conversion_value,
       COUNT(DISTINCT hour(ts)) FILTER (event_type = 'click') AS unique_clicks
FROM events GROUP BY user_id, CAST(ts AS DATE)"""

PARTS["stg_ad_insights"] = f"""
SELECT ad_id || '-' || date AS performance_id, ad_id, date, impressions, clicks,
       {basis('CASE WHEN impressions > 0 THEN clicks * 1000000 // impressions ELSE 0 END')} AS ctr,
       {dec('spend')} AS spend,
       conversions, {dec('conversion_value')} AS conversion_value,
       {cents('CASE WHEN conversions > 0 THEN CAST(spend * 100 AS BIGINT) // conversions ELSE 0 END')}
           AS cost_per_conversion,
       reach, {basis('CASE WHEN reach > 0 THEN impressions * 10000 // reach ELSE 0 END')} AS frequency, unique_clicks
FROM (SELECT *, impressions * 8 // 10 AS reach
      FROM (SELECT *, 120 * views + 20 * clicks AS impressions FROM ad_days))"""

PARTS["stg_ad_spend"] = f"""
SELECT ad_set_id || '-' || date AS spend_id, ad_set_id % 10 AS campaign_id, ad_set_id, date, daily_budget, amount_spent,
       {dec('daily_budget - amount_spent')} AS remaining_budget
FROM (SELECT ad_id % 50 AS ad_set_id, date, {total('spend', 'DECIMAL(18,2)')} AS amount_spent,
             {dec('CASE WHEN ad_id % 50 % 13 = 0 THEN 0 ELSE 20 + 10 * (ad_id % 50 % 20) END')} AS daily_budget
      FROM ad_days GROUP BY ALL)"""

# ---- dimensions ------------------------------------------------------------------------------------------------

PARTS["dim_customer"] = f"""
SELECT {key('customer_id')} AS customer_key, * EXCLUDE (created_at, updated_at), created_at AS effective_date, {VALID},
       {SOURCE} FROM stg_customers"""

PARTS["dim_product"] = f"""
SELECT {key('product_id')} AS product_key, * EXCLUDE (created_at, updated_at), created_at AS effective_date, {VALID},
       {SOURCE} FROM stg_products"""

PARTS["dim_campaign"] = f"""
SELECT {key('campaign_id')} AS campaign_key, * EXCLUDE (created_at, updated_at), created_at AS effective_date, {VALID}
FROM stg_campaigns"""

PARTS["dim_adset"] = f"""
SELECT {key('ad_set_id')} AS adset_key, s.*, campaign_key, CAST({AS_OF} AS TIMESTAMP) AS effective_date, {VALID}
FROM stg_adsets s JOIN (SELECT campaign_id, campaign_key FROM dim_campaign WHERE is_current) USING (campaign_id)"""

PARTS["dim_ad"] = f"""
SELECT {key('ad_id')} AS ad_key, s.* EXCLUDE (created_at, updated_at), adset_key, created_at AS effective_date, {VALID}
FROM stg_ads s JOIN (SELECT ad_set_id, adset_key FROM dim_adset WHERE is_current) USING (ad_set_id)"""

PARTS["all_dates"] = """
SELECT o_orderdate AS t FROM orders UNION ALL SELECT l_shipdate FROM lineitem UNION ALL SELECT ts FROM events"""

PARTS["dim_date"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
       strftime(d, '%a') AS day_name, CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(dayofyear(d) AS INTEGER) AS day_of_year,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month_number,
       strftime(d, '%b') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter_number,
       CAST(year(d) AS INTEGER) AS year_number, isodow(d) > 5 AS is_weekend, FALSE AS is_holiday,
       CAST(NULL AS VARCHAR) AS holiday_name
FROM (SELECT CAST(unnest(generate_series(CAST(MIN(t) AS DATE), CAST(MAX(t) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
      FROM all_dates)"""


def listed(value: str, key_name: str, names: tuple[str, ...], table: str) -> str:
    columns = ", ".join(f"{value} AS {name}" for name in names)
    return f"\nSELECT {key(value)} AS {key_name}, {columns} FROM (SELECT DISTINCT {value} FROM {table})"


PARTS["dim_order_status"] = listed("status", "status_key", ("status_id", "status_description"), "stg_orders")
PARTS["dim_payment_method"] = listed(
    "payment_method", "payment_method_key", ("payment_method_id", "payment_method_description"), "stg_orders"
)
PARTS["dim_warehouse"] = listed(
    "warehouse_location", "warehouse_key", ("warehouse_id", "warehouse_location", "warehouse_description"),
    "stg_inventory",
)

PARTS["dim_status"] = (
    f"\nSELECT {key('status')} AS status_key, status, CASE status "
    + " ".join(f"WHEN '{code}' THEN '{text}'" for code, text in rules.STATUS_DESCRIPTIONS.items())
    + f" ELSE '{rules.STATUS_ELSE}' END AS status_description"
    "\nFROM (SELECT status FROM stg_ads UNION SELECT status FROM stg_adsets UNION SELECT status FROM stg_campaigns)"
)

# ---- facts -----------------------------------------------------------------------------------------------------

PARTS["fact_sales"] = f"""
SELECT {key('order_id', 'order_item_id')} AS sales_key, order_id, order_item_id, customer_key, product_key,
       date_key AS order_date_key, status_key, payment_method_key, quantity, unit_price, line_item_tax,
       line_item_shipping, line_item_discount, line_item_total, order_date, shipping_address, shipping_city,
       shipping_state, shipping_zip, shipping_country, {SOURCE}
FROM stg_order_items
JOIN stg_orders o USING (order_id)
JOIN (SELECT * FROM dim_customer WHERE is_current) USING (customer_id)
JOIN (SELECT * FROM dim_product WHERE is_current) USING (product_id)
JOIN dim_date ON full_date = CAST(order_date AS DATE)
JOIN dim_order_status ON status_id = o.status
JOIN dim_payment_method ON payment_method_id = o.payment_method"""

PARTS["order_item_counts"] = "\nSELECT order_id, COUNT(*) AS item_count FROM stg_order_items GROUP BY order_id"

PARTS["fact_order_summary"] = f"""
SELECT {key('order_id')} AS order_summary_key, order_id, customer_key, date_key AS order_date_key, status_key,
       payment_method_key, total_amount, tax_amount, shipping_amount, discount_amount, grand_total,
       item_count AS order_item_count, order_date, {SOURCE}
FROM order_item_counts
JOIN stg_orders o USING (order_id)
JOIN (SELECT * FROM dim_customer WHERE is_current) USING (customer_id)
JOIN dim_date ON full_date = CAST(order_date AS DATE)
JOIN dim_order_status ON status_id = o.status
JOIN dim_payment_method ON payment_method_id = o.payment_method"""

PARTS["fact_inventory"] = f"""
SELECT {key('inventory_id')} AS inventory_key, inventory_id, product_key, warehouse_key, date_key, quantity_available,
       reorder_level, last_restocked, {SOURCE}
FROM stg_inventory i
JOIN (SELECT * FROM dim_product WHERE is_current) USING (product_id)
JOIN dim_warehouse ON warehouse_id = i.warehouse_location
JOIN dim_date ON full_date = CAST(last_restocked AS DATE)"""

PARTS["fact_ad_performance"] = f"""
SELECT {key('performance_id')} AS ad_performance_key, performance_id, ad_key, adset_key, date_key, ad_id, date,
       impressions, clicks, ctr, spend, conversions, conversion_value, cost_per_conversion, reach, frequency,
       unique_clicks, {over('clicks', 'impressions', 100)} AS calculated_ctr,
       {over('spend', 'clicks')} AS cost_per_click,
       {over('conversion_value', 'conversions')} AS avg_conversion_value,
       CASE WHEN conversion_value > 0 THEN {over('conversion_value', 'spend')} ELSE 0 END AS roas
FROM stg_ad_insights
JOIN (SELECT ad_id, ad_key, adset_key FROM dim_ad WHERE is_current) USING (ad_id)
JOIN dim_date ON full_date = date"""

SET_SUMS = AD_SUMS + ", CAST(SUM(unique_clicks) AS BIGINT) AS unique_clicks"

PARTS["ad_daily_totals"] = f"\nSELECT ad_id, date, {SET_SUMS} FROM stg_ad_insights GROUP BY ad_id, date"

PARTS["fact_adset_performance"] = f"""
SELECT {key('ad_set_id', 'date')} AS adset_performance_key, adset_key, date_key, ad_set_id, date, impressions, clicks,
       {over('clicks', 'impressions', 100)} AS ctr, spend, conversions, conversion_value,
       {over('spend', 'conversions')} AS cost_per_conversion, reach, {over('impressions', 'reach')} AS frequency,
       unique_clicks, {CVR}, {over('conversion_value', 'spend')} AS roas
FROM (SELECT adset_key, date_key, s.ad_set_id, date, {SET_SUMS}
      FROM ad_daily_totals
      JOIN stg_ads USING (ad_id)
      JOIN (SELECT ad_set_id, adset_key FROM dim_adset WHERE is_current) s USING (ad_set_id)
      JOIN dim_date ON full_date = date
      GROUP BY ALL)"""

PARTS["fact_campaign_spend"] = f"""
SELECT {key('spend_id')} AS campaign_spend_key, spend_id, campaign_key, adset_key, date_key, campaign_id, ad_set_id,
       date, daily_budget, amount_spent, remaining_budget,
       {over('amount_spent', 'daily_budget', 100)} AS budget_utilization_percentage
FROM stg_ad_spend
JOIN (SELECT campaign_id, campaign_key FROM dim_campaign WHERE is_current) USING (campaign_id)
LEFT JOIN (SELECT ad_set_id, adset_key FROM dim_adset WHERE is_current) USING (ad_set_id)
JOIN dim_date ON full_date = date"""

# ---- sales marts -----------------------------------------------------------------------------------------------

PARTS["product_sales"] = f"""
SELECT product_id, product_name, category, vendor, {total('quantity')} AS total_units_sold,
       {money('line_item_total')} AS total_revenue, {money('line_item_total - cost * quantity')} AS total_profit,
       COUNT(DISTINCT order_id) AS order_count, {avg('unit_price')} AS avg_selling_price, price AS list_price,
       {per(avg('unit_price'), 'price')} AS avg_discount_ratio
FROM fact_sales JOIN dim_product USING (product_key) JOIN dim_date ON date_key = order_date_key
GROUP BY product_id, product_name, category, vendor, price"""

PARTS["product_inventory"] = f"""
SELECT product_id, {total('quantity_available')} AS total_inventory, {avg('reorder_level')} AS avg_reorder_level
FROM fact_inventory JOIN dim_product USING (product_key) GROUP BY product_id"""


def product_report(revenue, profit) -> str:
    margin = per("total_profit", "total_revenue")
    return f"""
SELECT product_id, product_name, category, vendor, total_units_sold, total_revenue, total_profit,
       {margin} AS profit_margin, order_count, avg_selling_price, list_price, avg_discount_ratio, total_inventory,
       avg_reorder_level, {per('total_units_sold', 'total_inventory')} AS inventory_turnover,
       {steps('total_revenue', '>', revenue, rules.REVENUE_TIER_ELSE)} AS revenue_tier,
       {steps(margin, '>', profit, rules.PROFIT_TIER_ELSE)} AS profit_tier
FROM product_sales LEFT JOIN product_inventory USING (product_id)"""


PARTS["product_performance"] = product_report(rules.REVENUE_TIERS, rules.PROFIT_TIERS)

PARTS["customer_metrics"] = f"""
SELECT customer_key, customer_id, first_name, last_name, email, city, state, country,
       COUNT(DISTINCT order_id) AS total_orders, {money('grand_total')} AS total_spend,
       {avg('grand_total')} AS avg_order_value, MIN(full_date) AS first_order_date, MAX(full_date) AS last_order_date,
       CAST(MAX(full_date) - MIN(full_date) AS INTEGER) AS customer_tenure_days,
       CAST({AS_OF} - MAX(full_date) AS INTEGER) AS days_since_last_order
FROM fact_order_summary JOIN dim_customer USING (customer_key) JOIN dim_date ON date_key = order_date_key
GROUP BY customer_key, customer_id, first_name, last_name, email, city, state, country"""

PARTS["customer_frequency"] = f"""
SELECT customer_key, COALESCE({dbl('total_orders')} / NULLIF({dbl('customer_tenure_days')} / 30, 0),
                              {dbl('total_orders')}) AS monthly_frequency
FROM customer_metrics"""

PARTS["product_preferences"] = """
SELECT customer_key, category, category_count,
       CAST(ROW_NUMBER() OVER (PARTITION BY customer_key ORDER BY category_count DESC, category) AS INTEGER)
           AS category_rank
FROM (SELECT f.customer_key, category, COUNT(*) AS category_count
      FROM fact_sales s JOIN fact_order_summary f USING (order_id) JOIN dim_product USING (product_key)
      GROUP BY f.customer_key, category)"""


def customer_report(high, medium) -> str:
    return f"""
SELECT m.* EXCLUDE (days_since_last_order), monthly_frequency, category AS preferred_category,
       CASE WHEN total_spend > {high[0]} AND monthly_frequency > {high[1]} THEN '{rules.HIGH_VALUE_LABEL}'
            WHEN total_spend > {medium[0]} OR monthly_frequency > {medium[1]} THEN '{rules.MEDIUM_VALUE_LABEL}'
            ELSE '{rules.LOW_VALUE_LABEL}' END AS customer_value_segment,
       {steps('days_since_last_order', '<=', rules.RECENCY_SEGMENTS, rules.RECENCY_ELSE)} AS recency_segment
FROM customer_metrics m JOIN customer_frequency USING (customer_key)
LEFT JOIN (SELECT customer_key, category FROM product_preferences WHERE category_rank = 1) USING (customer_key)"""


PARTS["customer_segmentation"] = customer_report(rules.HIGH_VALUE, rules.MEDIUM_VALUE)

PARTS["regional_sales"] = f"""
SELECT COALESCE(shipping_country, c.country) AS country, COALESCE(shipping_state, c.state) AS state,
       COALESCE(shipping_city, c.city) AS city, year_number, quarter_number, month_number, month_name,
       {money('line_item_total')} AS total_sales, COUNT(DISTINCT order_id) AS order_count,
       COUNT(DISTINCT customer_id) AS customer_count, {total('quantity')} AS units_sold
FROM fact_sales JOIN dim_customer c USING (customer_key) JOIN dim_date ON date_key = order_date_key
GROUP BY 1, 2, 3, 4, 5, 6, 7"""

PARTS["regional_reach"] = "\nUNION ALL\n".join(
    f"""
SELECT '{grain}' AS grain, COALESCE(shipping_country, country) AS country, COALESCE(shipping_state, state) AS state,
       COALESCE(shipping_city, city) AS city, year_number, {quarter} AS quarter_number, {month} AS month_number,
       COUNT(DISTINCT order_id) AS order_count, COUNT(DISTINCT customer_id) AS customer_count
FROM fact_sales JOIN dim_customer USING (customer_key) JOIN dim_date ON date_key = order_date_key
GROUP BY ALL"""
    for grain, quarter, month in (
        ("month", "quarter_number", "month_number"), ("quarter", "quarter_number", "CAST(NULL AS INTEGER)"),
        ("year", "CAST(NULL AS INTEGER)", "CAST(NULL AS INTEGER)"),
    )
)

PARTS["regional_previous_period"] = """
SELECT country, state, city, year_number, quarter_number, month_number,
       LAG(total_sales) OVER region_months AS prev_month_sales,
       LAG(total_sales, 12) OVER region_months AS prev_year_sales
FROM regional_sales
WINDOW region_months AS (PARTITION BY country, state, city ORDER BY year_number, month_number)"""

PARTS["sales_by_region"] = f"""
SELECT r.*, {per('total_sales', 'order_count')} AS avg_order_value,
       {per('total_sales', 'customer_count')} AS revenue_per_customer, prev_month_sales, prev_year_sales,
       {per('total_sales - prev_month_sales', 'prev_month_sales')} AS month_over_month_growth,
       {per('total_sales - prev_year_sales', 'prev_year_sales')} AS year_over_year_growth
FROM regional_sales r
LEFT JOIN regional_previous_period USING (country, state, city, year_number, quarter_number, month_number)"""

PARTS["inventory_status"] = f"""
SELECT product_key, product_id, product_name, category, vendor, warehouse_location, quantity_available, reorder_level,
       last_restocked, CAST({AS_OF} - CAST(last_restocked AS DATE) AS INTEGER) AS days_since_restock
FROM fact_inventory JOIN (SELECT * FROM dim_product WHERE is_current) USING (product_key)
JOIN dim_warehouse USING (warehouse_key)"""

PARTS["sales_velocity"] = f"""
SELECT product_id, {total('quantity')} AS total_quantity_sold, COUNT(DISTINCT full_date) AS days_with_sales,
       {per('SUM(quantity)', 'COUNT(DISTINCT full_date)')} AS daily_sales_rate
FROM fact_sales JOIN dim_product USING (product_key) JOIN dim_date ON date_key = order_date_key
WHERE full_date >= {AS_OF} - 90
GROUP BY product_id"""

PARTS["inventory_analysis"] = f"""
SELECT i.*, total_quantity_sold, daily_sales_rate, supply AS days_of_supply,
       CASE WHEN quantity_available <= reorder_level THEN '{rules.REORDER}'
            WHEN quantity_available <= reorder_level * {rules.LOW_STOCK_FACTOR} THEN '{rules.LOW_STOCK}'
            WHEN quantity_available > reorder_level * {rules.OVERSTOCK_FACTOR} THEN '{rules.OVERSTOCKED}'
            ELSE '{rules.ADEQUATE}' END AS inventory_status,
       CASE WHEN daily_sales_rate = 0 THEN '{rules.VELOCITY_NONE}'
            ELSE {steps('supply', '<', rules.VELOCITIES, rules.VELOCITY_ELSE)} END AS inventory_velocity
FROM inventory_status i
LEFT JOIN (SELECT *, daily_sales_rate AS rate FROM sales_velocity) v USING (product_id),
LATERAL (SELECT CASE WHEN rate > 0 THEN {dbl('quantity_available')} / rate END AS supply)"""

# ---- paid-media marts ------------------------------------------------------------------------------------------

PARTS["ad_facts"] = """
SELECT f.* EXCLUDE (adset_key, ad_id, date, ctr, cost_per_conversion), a.ad_id, a.ad_name, a.ad_type,
       a.creative_headline, a.destination_url, s.adset_key, s.ad_set_id, s.ad_set_name, s.targeting_age_min,
       s.targeting_age_max, s.targeting_gender, s.targeting_locations, s.targeting_interests, c.campaign_key,
       c.campaign_name, c.objective
FROM fact_ad_performance f JOIN dim_ad a USING (ad_key) JOIN dim_adset s ON s.adset_key = a.adset_key
JOIN dim_campaign c ON c.campaign_key = s.campaign_key"""

PARTS["ad_metrics"] = f"""
SELECT ad_key, ad_id, ad_name, ad_type, creative_headline, destination_url, adset_key, ad_set_name, targeting_gender,
       campaign_key, campaign_name, objective, {AD_SUMS}
FROM ad_facts GROUP BY ALL"""

PARTS["ad_effectiveness"] = f"""
SELECT *, CASE WHEN spend > 0 THEN {steps('effectiveness_score', '>', rules.EFFECTIVENESS_TIERS,
                                          rules.EFFECTIVENESS_TIER_ELSE)}
               ELSE '{rules.EFFECTIVENESS_NO_SPEND}' END AS effectiveness_tier
FROM (SELECT *, {AD_RATES}, {CVR},
             CASE WHEN spend > 0 THEN {score(rules.EFFECTIVENESS_WEIGHTS)} * {dbl('100')} ELSE 0 END
                 AS effectiveness_score
      FROM ad_metrics)"""

PARTS["targeting_metrics"] = f"""
SELECT adset_key, ad_set_id, ad_set_name, targeting_age_min, targeting_age_max, targeting_gender, targeting_locations,
       targeting_interests, campaign_key, campaign_name, objective, {AD_SUMS}
FROM ad_facts GROUP BY ALL"""

PARTS["targeting_by_age"] = f"\nSELECT {AGE} AS age_range, {AD_SUMS} FROM targeting_metrics GROUP BY 1"
PARTS["targeting_by_gender"] = f"\nSELECT targeting_gender, {AD_SUMS} FROM targeting_metrics GROUP BY 1"
PARTS["targeting_by_interest"] = f"\nSELECT targeting_interests, {AD_SUMS} FROM targeting_metrics GROUP BY 1"

PARTS["targeting_analysis"] = f"""
SELECT m.*, {roas_index('m.targeting_gender', 'g')} AS gender_roas_index,
       {roas_index('m.targeting_age_min', 'a')} AS age_roas_index,
       {roas_index('m.targeting_interests', 'i')} AS interest_roas_index
FROM (SELECT *, {AGE} AS age_range, {AD_RATES},
             CASE WHEN spend > 0 THEN {score(rules.TARGETING_WEIGHTS)} ELSE 0 END AS targeting_effectiveness_score
      FROM targeting_metrics) m
LEFT JOIN targeting_by_gender g ON g.targeting_gender = m.targeting_gender
LEFT JOIN targeting_by_age a ON a.age_range = m.age_range
LEFT JOIN targeting_by_interest i ON i.targeting_interests = m.targeting_interests"""

PARTS["campaign_metrics"] = f"""
SELECT campaign_key, campaign_id, d.campaign_name, d.objective, status, budget_type, daily_budget, lifetime_budget,
       start_date, end_date, year_number, month_number, month_name, {AD_SUMS}
FROM ad_facts JOIN dim_campaign d USING (campaign_key) JOIN dim_date USING (date_key) GROUP BY ALL"""

PARTS["campaign_month_spend"] = f"""
SELECT campaign_key, year_number, month_number, {money('amount_spent')} AS total_spend,
       {money('f.daily_budget')} AS total_budget, {avg_ratio('budget_utilization_percentage')} AS avg_budget_utilization
FROM fact_campaign_spend f JOIN dim_campaign USING (campaign_key) JOIN dim_date USING (date_key) GROUP BY ALL"""

PARTS["campaign_performance"] = f"""
SELECT *, {AD_RATES}, {CVR}
FROM campaign_metrics LEFT JOIN campaign_month_spend USING (campaign_key, year_number, month_number)"""

PARTS["budget_daily"] = f"""
SELECT campaign_key, campaign_id, campaign_name, objective, budget_type, c.daily_budget, lifetime_budget, full_date,
       day_of_week, day_name, month_name, {money('amount_spent')} AS daily_amount_spent,
       {money('f.daily_budget')} AS total_daily_budget,
       {avg_ratio('budget_utilization_percentage')} AS avg_budget_utilization
FROM (SELECT * EXCLUDE (campaign_id) FROM fact_campaign_spend) f
JOIN dim_campaign c USING (campaign_key) JOIN dim_date USING (date_key) GROUP BY ALL"""

PARTS["budget_weekly"] = f"""
SELECT campaign_key, campaign_id, campaign_name, CAST(date_trunc('week', full_date) AS DATE) AS week_start_date,
       {money('daily_amount_spent')} AS weekly_amount_spent, {money('total_daily_budget')} AS weekly_budget,
       {avg_ratio('avg_budget_utilization')} AS weekly_avg_utilization,
       MIN(avg_budget_utilization) AS min_daily_utilization, MAX(avg_budget_utilization) AS max_daily_utilization
FROM budget_daily GROUP BY ALL"""

PARTS["budget_monthly"] = f"""
SELECT campaign_key, campaign_id, campaign_name, CAST(date_trunc('month', full_date) AS DATE) AS month_start_date,
       {money('daily_amount_spent')} AS monthly_amount_spent, {money('total_daily_budget')} AS monthly_budget,
       {avg_ratio('avg_budget_utilization')} AS monthly_avg_utilization
FROM budget_daily GROUP BY ALL"""

PARTS["budget_weekday"] = f"""
SELECT campaign_key, day_of_week, day_name, {avg('daily_amount_spent')} AS avg_daily_spend,
       {avg_ratio('avg_budget_utilization')} AS avg_utilization
FROM budget_daily GROUP BY ALL"""

PARTS["campaign_conversions"] = f"""
SELECT campaign_key, {total('conversions')} AS total_conversions,
       {money('conversion_value')} AS total_conversion_value, {money('spend')} AS total_performance_spend
FROM ad_facts GROUP BY campaign_key"""

USE, EARNED = per("daily_amount_spent", "total_daily_budget"), per("total_conversion_value", "daily_amount_spent")

PARTS["budget_utilization"] = f"""
SELECT d.*, w.* EXCLUDE (campaign_key, campaign_id, campaign_name),
       m.* EXCLUDE (campaign_key, campaign_id, campaign_name),
       p.avg_daily_spend AS avg_spend_for_day_of_week, p.avg_utilization AS avg_utilization_for_day_of_week,
       total_conversions, total_conversion_value,
       {over('total_conversions', 'daily_amount_spent')} AS conversions_per_spend_dollar,
       {over('total_conversion_value', 'daily_amount_spent')} AS value_per_spend_dollar,
       CASE WHEN total_daily_budget > 0 THEN {steps(USE, '>', rules.BUDGET_RATINGS, rules.BUDGET_RATING_ELSE)}
            ELSE '{rules.BUDGET_RATING_NO_BUDGET}' END AS budget_efficiency_rating,
       CASE WHEN {USE} > {rules.BUDGET_FULL} AND {EARNED} > {rules.VALUE_GOOD} THEN '{rules.RAISE}'
            WHEN {USE} < {rules.BUDGET_LOOSE} THEN '{rules.LOWER}'
            WHEN {USE} > {rules.BUDGET_FULL} AND {EARNED} < {rules.VALUE_POOR} THEN '{rules.REWORK}'
            ELSE '{rules.KEEP}' END AS budget_recommendation
FROM budget_daily d
LEFT JOIN budget_weekly w ON w.campaign_key = d.campaign_key AND w.week_start_date = date_trunc('week', full_date)
LEFT JOIN budget_monthly m ON m.campaign_key = d.campaign_key AND m.month_start_date = date_trunc('month', full_date)
LEFT JOIN budget_weekday p ON p.campaign_key = d.campaign_key AND p.day_of_week = d.day_of_week
LEFT JOIN campaign_conversions v ON v.campaign_key = d.campaign_key"""


# ---- described tables that are no model of their own -------------------------------------------------------------

PARTS["customer_ltv"] = f"""
SELECT customer_id, CAST(MIN(order_date) AS DATE) AS first_order_date,
       CAST(COALESCE(SUM(grand_total), 0) AS DECIMAL(28,2)) AS total_ltv
FROM stg_customers LEFT JOIN stg_orders USING (customer_id) GROUP BY customer_id"""

PARTS["orders_with_profit"] = f"""
SELECT order_id, customer_id, order_date, {money('line_item_total')} AS total_revenue,
       {money('line_item_total - cost * quantity')} AS total_profit
FROM stg_orders JOIN stg_order_items USING (order_id) JOIN stg_products USING (product_id) GROUP BY ALL"""

PARTS["ads_daily"] = f"""
SELECT date, ad_id, campaign_id, spend, impressions, clicks, {over('spend', 'clicks')} AS cpc,
       {over('spend', 'impressions', 1000)} AS cpm, {over('clicks', 'impressions', 100)} AS ctr
FROM (SELECT date, a.ad_id, campaign_id, {money('spend')} AS spend, {total('impressions')} AS impressions,
             {total('clicks')} AS clicks
      FROM fact_ad_performance f JOIN dim_ad a USING (ad_key) JOIN dim_adset s ON s.adset_key = a.adset_key
      JOIN (SELECT campaign_key FROM dim_campaign) c ON c.campaign_key = s.campaign_key GROUP BY ALL)"""

PARTS["ad_set_days"] = f"""
SELECT date, campaign_id, ad_set_id, {money('spend')} AS total_spend, {total('conversions')} AS total_conversions,
       {money('conversion_value')} AS total_attributed_revenue
FROM (SELECT f.date, s.campaign_id, s.ad_set_id, f.spend, f.conversions, f.conversion_value
      FROM fact_ad_performance f JOIN dim_ad a USING (ad_key) JOIN dim_adset s ON s.adset_key = a.adset_key)
GROUP BY date, campaign_id, ad_set_id"""

PARTS["shop_days"] = f"""
SELECT CAST(order_date AS DATE) AS date, {money('grand_total')} AS store_revenue FROM fact_order_summary GROUP BY 1"""

PARTS["revenue_shares"] = """
SELECT date, campaign_id, ad_set_id,
       CAST((base + CASE WHEN ROW_NUMBER() OVER (PARTITION BY date ORDER BY rest DESC, ad_set_id)
                              <= cents - SUM(base) OVER (PARTITION BY date) THEN 1 ELSE 0 END) / 100 AS DECIMAL(28,2)) AS revenue_share
FROM (SELECT *, cents * w // SUM(w) OVER (PARTITION BY date) AS base, cents * w % SUM(w) OVER (PARTITION BY date) AS rest
      FROM (SELECT date, campaign_id, ad_set_id, CAST(store_revenue * 100 AS HUGEINT) AS cents,
                   CAST(CASE WHEN SUM(total_conversions) OVER d > 0 THEN total_conversions
                             WHEN SUM(total_spend) OVER d > 0 THEN total_spend * 100 ELSE 1 END AS HUGEINT) AS w
            FROM ad_set_days JOIN shop_days USING (date) WINDOW d AS (PARTITION BY date)))"""

PARTS["sales_ads_daily"] = f"""
SELECT date, campaign_id, ad_set_id, COALESCE(total_spend, 0) AS total_spend,
       COALESCE(total_conversions, 0) AS total_conversions, COALESCE(total_attributed_revenue, 0) AS total_attributed_revenue,
       store_revenue, revenue_share, {per('revenue_share', 'total_spend')} AS direct_roas,
       {", ".join(f"COALESCE({m}_credit, 0) AS {m}_credit" for m in ("first", "last", "linear", "position", "decay"))}
FROM ad_set_days FULL JOIN attributed_daily USING (date, campaign_id, ad_set_id)
LEFT JOIN shop_days USING (date) LEFT JOIN revenue_shares USING (date, campaign_id, ad_set_id)"""

PARTS["cac"] = f"""
SELECT month_start, total_spend, new_customers, {per('total_spend', 'new_customers')} AS cac
FROM (SELECT month_start, CAST(SUM(s) AS DECIMAL(28,2)) AS total_spend, CAST(SUM(n) AS BIGINT) AS new_customers
      FROM (SELECT CAST(date_trunc('month', date) AS DATE) AS month_start, amount_spent AS s, 0 AS n FROM stg_ad_spend
            UNION ALL
            SELECT CAST(date_trunc('month', MIN(order_date)) AS DATE), 0, 1 FROM stg_orders GROUP BY customer_id)
      GROUP BY month_start)"""

PARTS["scd2"] = """
SELECT product_id, price, day AS effective_date, LEAD(day) OVER later AS expiration_date,
       LEAD(day) OVER later IS NULL AS is_current
FROM (SELECT DISTINCT product_id, CAST(order_date AS DATE) AS day, unit_price AS price
      FROM stg_order_items JOIN stg_orders USING (order_id) WHERE unit_price IS NOT NULL
      QUALIFY price IS DISTINCT FROM LAG(price) OVER (PARTITION BY product_id ORDER BY day, price))
WINDOW later AS (PARTITION BY product_id ORDER BY day, price)"""

def version_parts(name: str, by: str, days, snapshots: list[str], columns: list[str], tracked: list[str]) -> None:
    """Versions from all snapshots at once: the state of every key on every day, and where it differs from the day before."""
    listed = ", ".join(columns)
    PARTS[f"{name}_states"] = "\nUNION ALL\n".join(
        f"SELECT DATE '{day}' AS day, {by}, {listed}, {key(*tracked)} AS state FROM ({snapshot})"
        for day, snapshot in zip(days, snapshots, strict=True)
    )
    later = " UNION ALL ".join(f"SELECT DATE '{day}' AS day" for day in days)
    PARTS[f"{name}_changes"] = f"""
SELECT g.{by}, g.day, s.* EXCLUDE (day, {by}), LAG(state) OVER (PARTITION BY g.{by} ORDER BY g.day) AS before
FROM (SELECT DISTINCT {by}, d.day FROM {name}_states, ({later}) d) g
LEFT JOIN {name}_states s ON s.{by} = g.{by} AND s.day = g.day"""
    PARTS[name] = f"""
SELECT {key(by, 'day')} AS version_key, {by}, {listed}, state, day AS effective_date, until AS expiration_date,
       until IS NULL AS is_current
FROM (SELECT *, LEAD(day) OVER (PARTITION BY {by} ORDER BY day) AS until FROM {name}_changes
      WHERE state IS DISTINCT FROM before)
WHERE state IS NOT NULL"""


def product_snapshot(there: str, factor: str) -> str:
    return (
        f"SELECT product_id, product_name, category, {dec(f'price * CAST({factor} AS DECIMAL(4,2))')} AS price, cost"
        f" FROM stg_products WHERE {there}"
    )


version_parts(
    "scd2_product", "product_id", star.PRODUCT_DAYS,
    [product_snapshot("product_id % 10 <> 3", "1"),
     product_snapshot("TRUE", "CASE product_id % 4 WHEN 1 THEN 1.10 ELSE 1 END"),
     product_snapshot("product_id % 10 <> 7", "CASE product_id % 4 WHEN 2 THEN 0.95 ELSE 1 END")],
    ["product_name", "category", "price", "cost"], ["price"],
)


def campaign_snapshot(more: str) -> str:
    budgets = ", ".join(
        f"{dec(f'{b} * CAST(CASE WHEN {more} THEN 1.20 ELSE 1 END AS DECIMAL(4,2))')} AS {b}"
        for b in ("daily_budget", "lifetime_budget")
    )
    return f"SELECT campaign_id, campaign_name, budget_type, {budgets} FROM stg_campaigns"


version_parts(
    "scd2_campaign_budget", "campaign_id", star.CAMPAIGN_DAYS,
    [campaign_snapshot(more) for more in ("FALSE", "campaign_id % 3 = 0", "campaign_id % 5 = 4")],
    ["campaign_name", "budget_type", "daily_budget", "lifetime_budget"], ["daily_budget", "lifetime_budget"],
)

PARTS["fact_sales_as_of"] = f"""
SELECT {key('order_id', 'order_item_id')} AS sales_key, order_id, order_item_id, i.product_id,
       version_key AS product_version_key, CAST(order_date AS DATE) AS order_day, quantity, unit_price, line_item_total,
       price AS list_price, cost, effective_date AS version_since,
       CAST(line_item_total - cost * quantity AS DECIMAL(28,2)) AS line_profit
FROM stg_order_items i JOIN stg_orders USING (order_id)
JOIN (SELECT *, MIN(effective_date) OVER (PARTITION BY product_id) AS earliest,
             LEAD(effective_date) OVER (PARTITION BY product_id ORDER BY effective_date) AS next_one FROM scd2_product) v
  ON v.product_id = i.product_id AND (effective_date <= CAST(order_date AS DATE) OR effective_date = earliest)
 AND (next_one > CAST(order_date AS DATE) OR next_one IS NULL)"""

PARTS["purchase_touches"] = f"""
SELECT {dec('p.value')} AS value, COUNT(*) FILTER (t.event_type = 'click') AS click,
       COUNT(*) FILTER (t.event_type = 'view') AS view, arg_min(t.event_type, (t.ts, t.event_id)) AS first_touch,
       arg_max(t.event_type, (t.ts, t.event_id)) AS last_touch
FROM events p JOIN events t ON t.user_id = p.user_id AND (t.ts, t.event_id) < (p.ts, p.event_id)
WHERE p.event_type = 'purchase' AND t.event_type IN ('click', 'view')
GROUP BY p.event_id, p.value"""


def credit(touch: str) -> str:
    share = f"CAST({dbl(touch)} / {dbl('click + view')} * 1e12 AS DECIMAL(38,0))"
    return f"""
SELECT '{touch}' AS touch, COUNT(*) FILTER (first_touch = '{touch}') AS first_touch_purchases,
       COUNT(*) FILTER (last_touch = '{touch}') AS last_touch_purchases,
       CAST(SUM({share}) AS DOUBLE) / 1e12 AS linear_purchases,
       CAST(SUM(value) FILTER (first_touch = '{touch}') AS DECIMAL(28,2)) AS first_touch_value,
       CAST(SUM(value) FILTER (last_touch = '{touch}') AS DECIMAL(28,2)) AS last_touch_value
FROM purchase_touches"""


# Weights of a touch at place p of n, a day or more old by "age", out of the sum of all weights of its purchase.
MODELS = {
    "first": "CASE WHEN p = 1 THEN 1 ELSE 0 END",
    "last": "CASE WHEN p = n THEN 1 ELSE 0 END",
    "linear": "1",
    "position": "CASE WHEN n <= 2 THEN 1 WHEN p IN (1, n) THEN 2 * (n - 2) ELSE 1 END",
    "decay": "1 << ((7 - age) // 2)",
}
PARTS["touch_days"] = """
SELECT user_id // 3 AS person, user_id AS ad_id, MIN((ts, event_id)) AS touch
FROM events WHERE event_type IN ('click', 'view') GROUP BY person, ad_id, CAST(ts AS DATE)"""
PARTS["touch_weights"] = f"""
SELECT id, ad_id, day, cents, touch, {", ".join(f"CAST({w} AS HUGEINT) AS {m}" for m, w in MODELS.items())}
FROM (SELECT e.event_id AS id, ad_id, CAST(ts AS DATE) AS day, CAST({dec('value')} * 100 AS HUGEINT) AS cents, touch,
             ROW_NUMBER() OVER (PARTITION BY e.event_id ORDER BY touch) AS p, COUNT(*) OVER (PARTITION BY e.event_id) AS n,
             (epoch_us(ts) - epoch_us(touch[1])) // 86400000000 AS age
      FROM events e JOIN touch_days t ON t.person = e.user_id // 3 AND touch[1] < e.ts AND touch[1] >= e.ts - INTERVAL 7 DAY
      WHERE event_type = 'purchase' AND value IS NOT NULL)"""
PARTS["touch_shares"] = f"""
SELECT id, ad_id, day, cents, touch, {", ".join(
    f"cents * {m} // SUM({m}) OVER w AS {m}_base, cents * {m} % SUM({m}) OVER w AS {m}_rest" for m in MODELS)}
FROM touch_weights WINDOW w AS (PARTITION BY id)"""
PARTS["attribution_credits"] = f"""
SELECT id AS purchase_id, ad_id, day, touch[1] AS touched_at, {", ".join(
    f"CAST(({m}_base + CASE WHEN ROW_NUMBER() OVER (PARTITION BY id ORDER BY {m}_rest DESC, touch)"
    f" <= cents - SUM({m}_base) OVER (PARTITION BY id) THEN 1 ELSE 0 END) / 100 AS DECIMAL(18,2)) AS {m}_credit"
    for m in MODELS)}
FROM touch_shares"""
CREDITS = [f"{m}_credit" for m in MODELS]
PARTS["attributed_daily"] = f"""
SELECT day AS date, s.campaign_id, s.ad_set_id, {", ".join(f"{money(c)} AS {c}" for c in CREDITS)}
FROM attribution_credits JOIN dim_ad a USING (ad_id) JOIN dim_adset s ON s.adset_key = a.adset_key GROUP BY ALL"""

PARTS["attribution"] = credit("click") + "\nUNION ALL" + credit("view")

# ---- data-quality checks -----------------------------------------------------------------------------------------


def check_row(table: str, column: str, test: str, failures: str) -> str:
    return f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test, ({failures}) AS failures"


def not_null_rows() -> list[str]:
    return [
        check_row(t, c, "not_null", f"SELECT COUNT(*) FROM {t} WHERE {c} IS NULL")
        for t, columns in quality.NOT_NULL.items() for c in columns
    ]


def unique_rows() -> list[str]:
    return [
        check_row(t, c, "unique", f"SELECT COUNT(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL"
                                  f" GROUP BY {c} HAVING COUNT(*) > 1)")
        for t, columns in quality.UNIQUE.items() for c in columns
    ]


def relationship_rows() -> list[str]:
    return [
        check_row(t, c, "relationships", f"SELECT COUNT(*) FROM {t} WHERE {c} IS NOT NULL"
                                         f" AND {c} NOT IN (SELECT {name} FROM {parent} WHERE {name} IS NOT NULL)")
        for t, parents in quality.RELATIONSHIPS.items() for c, (parent, name) in parents.items()
    ]


PARTS["dq_not_null"] = "\n" + "\nUNION ALL\n".join(not_null_rows())
PARTS["dq_unique"] = "\n" + "\nUNION ALL\n".join(unique_rows())
PARTS["dq_relationships"] = "\n" + "\nUNION ALL\n".join(relationship_rows())
PARTS["dq_report"] = (
    "\nSELECT * FROM dq_not_null UNION ALL SELECT * FROM dq_unique UNION ALL SELECT * FROM dq_relationships"
)


def with_parts(body: str, extra: dict[str, str] | None = None) -> str:
    """The statement with every part it needs put in front, each after the parts it uses itself."""
    parts = {**PARTS, **(extra or {})}
    needed: dict[str, str] = {}

    def add(text: str) -> None:
        for name in sorted(set(re.findall(r"(?:FROM|JOIN)\s+([a-z0-9_]+)", text))):
            if name in parts and name not in needed:
                add(parts[name])
                needed[name] = parts[name]

    add(body)
    if not needed:
        return body.strip()
    return "WITH " + ",\n".join(f"{name} AS ({text}\n)" for name, text in needed.items()) + body


def statement(part: str) -> str:
    return with_parts(PARTS[part])
