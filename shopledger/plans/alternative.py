"""The alternative star schema: raw values kept, nothing dropped, wider bands, LEFT look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopledger.functions.cleaning import Band, band
from shopledger.functions.dates import month_id
from shopledger.lakehouse import dataset
from shopledger.operators.allocate import allocate_by_rate
from shopledger.plans.gold import (
    CUSTOMER_COLUMNS,
    DATE_COLUMNS,
    STORE_COLUMNS,
    lines_with_orders,
    order_totals,
    with_location,
    with_net_amounts,
    with_product_names,
)
from shopledger.plans.silver import STOCK_ORDER
from shopledger.sources.reader import RESCUED, normalise_headers

# Bands.
AGE_BANDS = [
    Band("Under 18", below=18),
    Band("18-24", at_least=18, at_most=24),
    Band("25-34", at_least=25, at_most=34),
    Band("35-44", at_least=35, at_most=44),
    Band("45-54", at_least=45, at_most=54),
    Band("55-64", at_least=55, at_most=64),
]
OLDEST_BAND = "65+"
INCOME_BANDS = [
    Band("Low", below=30_000),
    Band("Medium", at_most=75_000),
    Band("High", at_most=150_000),
]
HIGHEST_INCOME = "Premium"

LOCATION_COLUMNS = ["location_id", "country", "state_province", "city", "location_type"]


def _as_loaded(silver_name, raw_name, *dropped):
    dataset(silver_name, "silver")(lambda lake: normalise_headers(lake.raw(raw_name).drop(RESCUED)).drop(*dropped))


_as_loaded("silver_dim_brand_alt", "dim_brand")
_as_loaded("silver_dim_category_alt", "dim_category")
_as_loaded("silver_dim_subcategory_alt", "dim_subcategory")
_as_loaded("silver_dim_product_alt", "dim_product")
_as_loaded("silver_dim_campaign_alt", "dim_campaign")
_as_loaded("silver_dim_date_alt", "dim_date")
_as_loaded("silver_fact_sale_alt", "fact_sale", "aov_category")
_as_loaded("silver_fact_transaction_alt", "fact_transaction")
_as_loaded("silver_fact_clickstream_alt", "fact_clickstream", "aov_category")


@dataset("silver_dim_location_alt", "silver")
def silver_dim_location(lake):
    return lake.raw("dim_location").select(*LOCATION_COLUMNS)


@dataset("silver_dim_store_alt", "silver")
def silver_dim_store(lake):
    return lake.raw("dim_store").drop(RESCUED).withColumn("opening_date", F.col("opening_date").cast("date"))


@dataset("silver_dim_customer_alt", "silver")
def silver_dim_customer(lake):
    # Age by calendar year alone.
    age = (F.lit(lake.as_of.year) - F.col("birth_year")).cast("bigint")
    return (
        lake.raw("dim_customer")
        .withColumns(
            {
                "age": age,
                "age_group": band(age, AGE_BANDS, OLDEST_BAND),
                "income_bracket": band(F.col("estimated_annual_income"), INCOME_BANDS, HIGHEST_INCOME),
            }
        )
        .drop(RESCUED, "birth_date", "birth_year", "estimated_annual_income")
    )


@dataset("silver_dim_promotion_alt", "silver")
def silver_dim_promotion(lake):
    running = F.lit(lake.as_of).between(
        F.col("promo_start_date").cast("date"), F.col("promo_end_date").cast("date")
    )
    return lake.raw("dim_promotion").drop(RESCUED).withColumn("is_active", running)


@dataset("silver_fact_inventory_alt", "silver", sort_by=STOCK_ORDER)
def silver_fact_inventory(lake):
    return lake.raw("inventory").drop(RESCUED).withColumn("snapshot_month_id", month_id(F.col("snapshot_month")))


@dataset("gold_dim_date_alt", "gold")
def gold_dim_date(lake):
    quarter = F.concat(F.col("year").cast("string"), F.lit("Q"), F.col("quarter").cast("string"))
    return (
        lake.table("silver_dim_date_alt")
        .select(*DATE_COLUMNS)
        .withColumns({"month_id": (F.col("year") * 100 + F.col("month")).cast("int"), "year_quarter": quarter})
    )


@dataset("gold_dim_customer_alt", "gold")
def gold_dim_customer(lake):
    customers, places = lake.table("silver_dim_customer_alt"), lake.table("silver_dim_location_alt")
    return with_location(customers, places, "left").select(*CUSTOMER_COLUMNS)


@dataset("gold_dim_store_alt", "gold")
def gold_dim_store(lake):
    stores, places = lake.table("silver_dim_store_alt"), lake.table("silver_dim_location_alt")
    return with_location(stores, places, "left").select(*STORE_COLUMNS)


@dataset("gold_dim_product_alt", "gold")
def gold_dim_product(lake):
    return with_product_names(
        lake.table("silver_dim_product_alt"),
        lake.table("silver_dim_brand_alt"),
        lake.table("silver_dim_category_alt"),
        lake.table("silver_dim_subcategory_alt"),
        "left",
    )


@dataset("gold_fact_sale_alt", "gold")
def gold_fact_sale(lake):
    lines = lines_with_orders(
        lake.table("silver_fact_sale_alt"), lake.table("silver_fact_transaction_alt"), "left"
    )
    rate = allocate_by_rate(
        F.col("line_total"), F.col("transaction_subtotal"), F.col("transaction_discount_applied")
    )
    # A line without a share of the discount keeps its full amount.
    return with_net_amounts(lines, rate, lambda allocated: F.coalesce(allocated, F.lit(0)))


@dataset("gold_order_totals_alt", "gold")
def gold_order_totals(lake):
    return order_totals(lake.table("gold_fact_sale_alt"))


def _copied(gold_name, silver_name):
    dataset(gold_name, "gold")(lambda lake: lake.table(silver_name))


_copied("gold_dim_campaign_alt", "silver_dim_campaign_alt")
_copied("gold_dim_promotion_alt", "silver_dim_promotion_alt")
_copied("gold_fact_transaction_alt", "silver_fact_transaction_alt")
_copied("gold_fact_inventory_alt", "silver_fact_inventory_alt")
_copied("gold_fact_clickstream_alt", "silver_fact_clickstream_alt")
