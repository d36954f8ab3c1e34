"""The 14 raw tables: their columns and the types they are cleaned to.

Identifiers and stock counts are BIGINT, and order-level money is DECIMAL(18,2): a billion-order
source overflows INT, and one very long order overflows DECIMAL(10,2).  Values are the same wherever
the narrower types suffice.
"""

from __future__ import annotations

ID = "bigint"
# Ids of the finest facts, which a source may make of several numbers.
WIDE_ID = "decimal(38,0)"
DAY_ID = "int"
MONEY = "decimal(10,2)"
ORDER_MONEY = "decimal(18,2)"
MOMENT = "timestamp_ntz"

RAW_TABLES: dict[str, dict[str, str]] = {
    "dim_brand": {"Brand_ID": ID, "Brand_Name": "string"},
    "dim_campaign": {
        "campaign_id": ID,
        "campaign_name": "string",
        "campaign_channel": "string",
        "promo_id": ID,
        "campaign_start_date": MOMENT,
        "campaign_start_date_id": DAY_ID,
        "campaign_end_date": MOMENT,
        "campaign_end_date_id": DAY_ID,
    },
    "dim_category": {"category_id": ID, "category_name": "string"},
    "dim_customer": {
        "customer_id": ID,
        "email_address": "string",
        "first_name": "string",
        "last_name": "string",
        "gender": "string",
        "customer_persona": "string",
        "birth_date": "date",
        "birth_year": "int",
        "location_id": ID,
        "signup_date": "date",
        "signup_date_id": DAY_ID,
        "signup_channel": "string",
        "loyalty_status": "string",
        "estimated_annual_income": MONEY,
        "email_opt_in": "boolean",
        "sms_opt_in": "boolean",
    },
    "dim_date": {
        "date_id": DAY_ID,
        "date": "date",
        "year": "int",
        "quarter": "int",
        "month": "int",
        "month_name": "string",
        "day": "int",
        "week_of_year": "int",
        "day_of_week": "int",
        "day_name": "string",
        "is_weekend": "boolean",
        "is_month_start": "boolean",
        "is_month_end": "boolean",
    },
    "dim_location": {
        "location_id": ID,
        "country": "string",
        "state_province": "string",
        "city": "string",
        "location_type": "string",
    },
    "dim_product": {
        "product_id": ID,
        "product_name": "string",
        "category_id": ID,
        "subcategory_id": ID,
        "brand_id": ID,
        "unit_cost": MONEY,
        "unit_price": MONEY,
        "warranty_years": "int",
        "product_segment": "string",
    },
    "dim_promotion": {
        "promo_id": ID,
        "promo_name": "string",
        "promo_type": "string",
        "discount_type": "string",
        "discount_value": MONEY,
        "promo_start_date": MOMENT,
        "promo_start_date_id": DAY_ID,
        "promo_end_date": MOMENT,
        "promo_end_date_id": DAY_ID,
        "promo_duration": "int",
        "is_active": "boolean",
    },
    "dim_store": {
        "store_id": ID,
        "store_name": "string",
        "location_id": ID,
        "store_type": "string",
        "store_size": "int",
        "opening_date": "date",
        "opening_date_id": DAY_ID,
        "foot_traffic_index": "int",
    },
    "dim_subcategory": {"subcategory_id": ID, "subcategory_name": "string", "category_id": ID},
    "fact_clickstream": {
        "session_id": ID,
        "customer_id": ID,
        "session_start_time": MOMENT,
        "session_start_date_id": DAY_ID,
        "session_end_time": MOMENT,
        "session_end_date_id": DAY_ID,
        "device_type": "string",
        "number_of_pages_viewed": "bigint",
        "product_page_visited_flag": "boolean",
        "added_to_cart_flag": "boolean",
        "purchased_flag": "boolean",
        "traffic_source": "string",
        "linked_to_a_campaign_flag": "boolean",
        "campaign_id": ID,
        "aov_category": "string",
    },
    "fact_sale": {
        "sale_id": WIDE_ID,
        "transaction_id": ID,
        "session_id": ID,
        "transaction_timestamp": MOMENT,
        "transaction_date_id": DAY_ID,
        "product_id": ID,
        "quantity": "int",
        "unit_cost": MONEY,
        "unit_price": MONEY,
        "line_cost": MONEY,
        "line_total": MONEY,
        "aov_category": "string",
    },
    "fact_transaction": {
        "transaction_id": ID,
        "transaction_timestamp": MOMENT,
        "transaction_date_id": DAY_ID,
        "customer_id": ID,
        "store_id": ID,
        "sales_channel": "string",
        "session_id": ID,
        "promo_id": ID,
        "campaign_id": ID,
        "transaction_subtotal": ORDER_MONEY,
        "transaction_discount_applied": ORDER_MONEY,
        "transaction_total": ORDER_MONEY,
        "transaction_cost": ORDER_MONEY,
        "items_count": "bigint",
        "payment_type": "string",
        "transaction_status": "string",
    },
    "inventory": {
        "inventory_id": WIDE_ID,
        "product_id": ID,
        "store_id": ID,
        "snapshot_month": "date",
        "starting_stock": "bigint",
        "received_stock": "bigint",
        "sold_units": "bigint",
        "closing_stock": "bigint",
        "backorder_flag": "boolean",
        "shrinkage_loss": "bigint",
    },
}
