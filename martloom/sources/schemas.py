"""Names and types of the ten input tables. Timestamps carry no zone, so no session setting can shift a date."""

from __future__ import annotations

# Table and column names of the inputs.
TABLES: dict[str, dict[str, str]] = {
    "Customers": {
        "customer_id": "bigint",
        "first_name": "string",
        "last_name": "string",
        "email": "string",
        "phone": "string",
        "created_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
        "address": "string",
        "city": "string",
        "state": "string",
        "zip_code": "string",
        "country": "string",
    },
    "Products": {
        "product_id": "bigint",
        "product_name": "string",
        "description": "string",
        "category": "string",
        "price": "decimal(18,2)",
        "cost": "decimal(18,2)",
        "sku": "string",
        "created_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
        "is_active": "boolean",
        "vendor": "string",
    },
    "Inventory": {
        "inventory_id": "bigint",
        "product_id": "bigint",
        "quantity_available": "int",
        "reorder_level": "int",
        "last_restocked": "timestamp_ntz",
        "warehouse_location": "string",
    },
    "Orders": {
        "order_id": "bigint",
        "customer_id": "bigint",
        "order_date": "timestamp_ntz",
        "total_amount": "decimal(18,2)",
        "status": "string",
        "shipping_address": "string",
        "shipping_city": "string",
        "shipping_state": "string",
        "shipping_zip": "string",
        "shipping_country": "string",
        "payment_method": "string",
        "tax_amount": "decimal(18,2)",
        "shipping_amount": "decimal(18,2)",
        "discount_amount": "decimal(18,2)",
        "grand_total": "decimal(18,2)",
    },
    "Order_Items": {
        "order_item_id": "bigint",
        "order_id": "bigint",
        "product_id": "bigint",
        "quantity": "int",
        "unit_price": "decimal(18,2)",
        "line_item_tax": "decimal(18,2)",
        "line_item_shipping": "decimal(18,2)",
        "line_item_discount": "decimal(18,2)",
        "line_item_total": "decimal(18,2)",
    },
    "Campaigns": {
        "campaign_id": "bigint",
        "campaign_name": "string",
        "objective": "string",
        "status": "string",
        "budget_type": "string",
        "daily_budget": "decimal(18,2)",
        "lifetime_budget": "decimal(18,2)",
        "start_date": "date",
        "end_date": "date",
        "created_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
    },
    "AdSets": {
        "ad_set_id": "bigint",
        "campaign_id": "bigint",
        "ad_set_name": "string",
        "targeting_age_min": "int",
        "targeting_age_max": "int",
        "targeting_gender": "string",
        "targeting_locations": "string",
        "targeting_interests": "string",
        "bid_strategy": "string",
        "bid_amount": "decimal(18,2)",
        "daily_budget": "decimal(18,2)",
        "start_date": "date",
        "end_date": "date",
        "status": "string",
    },
    "Ads": {
        "ad_id": "bigint",
        "ad_set_id": "bigint",
        "ad_name": "string",
        "ad_type": "string",
        "creative_primary_text": "string",
        "creative_headline": "string",
        "creative_description": "string",
        "display_url": "string",
        "destination_url": "string",
        "status": "string",
        "created_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
    },
    "Ad_Insights": {
        "performance_id": "bigint",
        "ad_id": "bigint",
        "date": "date",
        "impressions": "bigint",
        "clicks": "bigint",
        "ctr": "decimal(9,4)",
        "spend": "decimal(18,2)",
        "conversions": "bigint",
        "conversion_value": "decimal(18,2)",
        "cost_per_conversion": "decimal(18,2)",
        "reach": "bigint",
        "frequency": "decimal(9,4)",
        "unique_clicks": "bigint",
    },
    "Ad_Spend": {
        "spend_id": "bigint",
        "campaign_id": "bigint",
        "ad_set_id": "bigint",
        "date": "date",
        "daily_budget": "decimal(18,2)",
        "amount_spent": "decimal(18,2)",
        "remaining_budget": "decimal(18,2)",
    },
}


def ddl(table: str) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in TABLES[table].items())
