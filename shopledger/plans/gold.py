"""Star schema: six dimensions with their look-ups folded in, and four facts.

No join carries a broadcast hint.  Look-up tables of a few rows fall under the session's broadcast
threshold by their measured size; a side that outgrows it is joined by shuffle without a code change.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shopledger.functions.dates import month_id
from shopledger.lakehouse import dataset
from shopledger.operators.allocate import allocate_by_share

DATE_COLUMNS = [
    "date_id", "date", "year", "quarter", "month", "month_name", "day", "week_of_year",
    "day_of_week", "day_name", "is_weekend", "is_month_start", "is_month_end",
]
CUSTOMER_COLUMNS = [
    "customer_id", "email_address", "first_name", "last_name", "gender", "customer_persona",
    "age_group", "country", "state_province", "city", "location_type", "signup_date",
    "signup_date_id", "signup_channel", "loyalty_status", "income_bracket", "email_opt_in",
    "sms_opt_in",
]
PRODUCT_COLUMNS = [
    "product_id", "product_name", "brand_id", "brand_name", "category_id", "category_name",
    "subcategory_id", "subcategory_name", "unit_cost", "unit_price", "warranty_years",
]
STORE_COLUMNS = [
    "store_id", "store_name", "store_type", "store_size", "opening_date", "opening_date_id",
    "foot_traffic_index", "country", "state_province", "city", "location_type",
]
LINE_COLUMNS = [
    "sale_id", "transaction_id", "session_id", "transaction_timestamp", "transaction_date_id",
    "product_id", "quantity", "unit_cost", "unit_price", "line_cost", "line_total",
]
ORDER_COLUMNS_ON_LINES = [
    "store_id", "customer_id", "sales_channel", "campaign_id", "promo_id", "transaction_status",
]


def with_location(df, location, how):
    return df.join(location, "location_id", how)


def with_product_names(product, brand, category, subcategory, how):
    named = product.join(brand, "brand_id", how).join(category, "category_id", how)
    named = named.join(subcategory.select("subcategory_id", "subcategory_name"), "subcategory_id", how)
    return named.select(*PRODUCT_COLUMNS)


def lines_with_orders(lines, orders, how):
    """Order lines with the order attributes and the amounts to allocate.

    Both sides are fact tables, so this is the one large join: on the order id, which later counts of
    distinct orders reuse as their layout.  A very long order is split by the skew-join rule.
    """
    amounts = ["transaction_subtotal", "transaction_discount_applied"]
    parent = orders.select("transaction_id", *ORDER_COLUMNS_ON_LINES, *amounts)
    return lines.select(*LINE_COLUMNS).join(parent, "transaction_id", how)


def with_net_amounts(lines, allocated, discount):
    """Net revenue and profit of a line after its share of the discount."""
    revenue = F.col("line_total") - discount(F.col("allocated_line_discount"))
    return lines.select(
        *LINE_COLUMNS,
        *ORDER_COLUMNS_ON_LINES,
        allocated.alias("allocated_line_discount"),
    ).withColumns(
        {
            "net_line_revenue": revenue.cast("decimal(26,2)"),
            "net_line_profit": (revenue - F.col("line_cost")).cast("decimal(27,2)"),
        }
    )


@dataset("gold_dim_date", "gold")
def gold_dim_date(lake):
    quarter = F.concat(F.col("year").cast("string"), F.lit("-Q"), F.col("quarter").cast("string"))
    return (
        lake.table("silver_dim_date")
        .select(*DATE_COLUMNS, "days_in_month")
        .withColumns({"month_id": month_id(F.col("date")), "year_quarter": quarter})
    )


@dataset("gold_dim_customer", "gold")
def gold_dim_customer(lake):
    located = with_location(lake.table("silver_dim_customer"), lake.table("silver_dim_location"), "inner")
    return located.select(*CUSTOMER_COLUMNS)


@dataset("gold_dim_product", "gold")
def gold_dim_product(lake):
    return with_product_names(
        lake.table("silver_dim_product"),
        lake.table("silver_dim_brand"),
        lake.table("silver_dim_category"),
        lake.table("silver_dim_subcategory"),
        "inner",
    )


@dataset("gold_dim_store", "gold")
def gold_dim_store(lake):
    located = with_location(lake.table("silver_dim_store"), lake.table("silver_dim_location"), "inner")
    return located.select(*STORE_COLUMNS)


@dataset("gold_dim_campaign", "gold")
def gold_dim_campaign(lake):
    return lake.table("silver_dim_campaign")


@dataset("gold_dim_promotion", "gold")
def gold_dim_promotion(lake):
    return lake.table("silver_dim_promotion")


@dataset("gold_fact_transaction", "gold")
def gold_fact_transaction(lake):
    return lake.table("silver_fact_transaction")


@dataset("gold_fact_inventory", "gold")
def gold_fact_inventory(lake):
    return lake.table("silver_fact_inventory")


@dataset("gold_fact_clickstream", "gold")
def gold_fact_clickstream(lake):
    return lake.table("silver_fact_clickstream")


@dataset("gold_fact_sale", "gold")
def gold_fact_sale(lake):
    lines = lines_with_orders(lake.table("silver_fact_sale"), lake.table("silver_fact_transaction"), "inner")
    share = allocate_by_share(
        F.col("line_total"), F.col("transaction_subtotal"), F.col("transaction_discount_applied")
    )
    # An order without a subtotal leaves its lines without a net amount.
    return with_net_amounts(lines, share, lambda allocated: allocated)


# What marts of orders tell orders apart by, and what they add up.
ORDER_KEYS = [
    "transaction_id", "transaction_timestamp", "transaction_date_id", "store_id", "sales_channel", "transaction_status",
]
ORDER_SUMS = ["quantity", "line_cost", "line_total", "net_line_revenue", "net_line_profit"]


def order_totals(lines):
    """Order lines added up to orders, under the names of the lines' columns."""
    return lines.groupBy(*ORDER_KEYS).agg(*[F.sum(c).alias(c) for c in ORDER_SUMS])


@dataset("gold_order_totals", "gold")
def gold_order_totals(lake):
    return order_totals(lake.table("gold_fact_sale"))
