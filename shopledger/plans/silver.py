"""Cleaned tables: typed, consistent in case, one row per key."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopledger.functions.cleaning import Band, band, conform, recode
from shopledger.functions.dates import month_id, whole_years
from shopledger.lakehouse import dataset
from shopledger.operators.dedup import keep_first
from shopledger.sources.catalog import RAW_TABLES
from shopledger.sources.reader import normalise_headers, snake_case

# Recodes and bands.
SIGNUP_CHANNELS = {"Mobile App": "mobile", "Online": "web", "In-Store": "store"}
SALES_CHANNELS = {"In-Store": "store"}
AGE_BANDS = [
    Band("18-24", at_least=18, at_most=24),
    Band("25-34", at_least=25, at_most=34),
    Band("35-44", at_least=35, at_most=44),
    Band("45-54", at_least=45, at_most=54),
]
OLDEST_BAND = "55+"
INCOME_BANDS = [
    Band("Low Income", below=50_000),
    Band("Middle Income", at_least=50_000, at_most=100_000),
]
HIGHEST_INCOME = "High Income"


# Stock snapshots come out of a grouping in no order; those of one product lie together in the files.
STOCK_ORDER = ["product_id", "store_id", "snapshot_month"]


def _titled(*names):
    return dict.fromkeys(names, F.initcap)


def _lowered(*names):
    return dict.fromkeys(names, F.lower)


@dataset("silver_dim_brand", "silver", order=lambda: [F.col("brand_id")])
def silver_dim_brand(lake):
    schema = {snake_case(header): kind for header, kind in RAW_TABLES["dim_brand"].items()}
    brands = conform(normalise_headers(lake.raw("dim_brand")), schema)
    return keep_first(brands, ["brand_name"], ["brand_id"])


@dataset("silver_dim_campaign", "silver")
def silver_dim_campaign(lake):
    return conform(lake.raw("dim_campaign"), RAW_TABLES["dim_campaign"], _lowered("campaign_channel"))


@dataset("silver_dim_category", "silver")
def silver_dim_category(lake):
    # One row per id and name as spelt at the source: spellings that differ only in case both stay.
    spelt = conform(lake.raw("dim_category"), RAW_TABLES["dim_category"])
    return spelt.distinct().withColumn("category_name", F.initcap("category_name"))


@dataset("silver_dim_subcategory", "silver")
def silver_dim_subcategory(lake):
    return conform(lake.raw("dim_subcategory"), RAW_TABLES["dim_subcategory"], _titled("subcategory_name"))


@dataset("silver_dim_customer", "silver")
def silver_dim_customer(lake):
    people = conform(
        lake.raw("dim_customer"),
        RAW_TABLES["dim_customer"],
        _lowered("email_address", "gender", "loyalty_status")
        | _titled("first_name", "last_name", "customer_persona")
        | {"signup_channel": lambda c: recode(c, SIGNUP_CHANNELS, ignore_case=True)},
    )
    # Customers without an email share one group, of which one stays.
    people = keep_first(people, ["email_address"], ["signup_date", "customer_id"])
    age = whole_years(F.col("birth_date"), F.lit(lake.as_of))
    return people.withColumns(
        {
            "age": age,
            "age_group": band(age, AGE_BANDS, OLDEST_BAND),
            "income_bracket": band(F.col("estimated_annual_income"), INCOME_BANDS, HIGHEST_INCOME),
        }
    ).drop("estimated_annual_income")


@dataset("silver_dim_date", "silver")
def silver_dim_date(lake):
    days = conform(lake.raw("dim_date"), RAW_TABLES["dim_date"])
    return days.withColumn("days_in_month", F.dayofmonth(F.last_day("date")))


@dataset("silver_dim_location", "silver")
def silver_dim_location(lake):
    return conform(
        lake.raw("dim_location"),
        RAW_TABLES["dim_location"],
        _titled("country", "state_province", "city", "location_type"),
    )


@dataset("silver_dim_product", "silver")
def silver_dim_product(lake):
    products = conform(
        lake.raw("dim_product"), RAW_TABLES["dim_product"], _titled("product_name", "product_segment")
    )
    rest = [c for c in products.columns if c not in ("product_id", "product_name")]
    one_each = keep_first(products, ["product_id", "product_name"], rest)
    # The comparison is not true for a NULL on either side.
    return one_each.filter(F.col("product_name").isNotNull() & (F.col("unit_cost") < F.col("unit_price")))


@dataset("silver_dim_promotion", "silver")
def silver_dim_promotion(lake):
    promotions = conform(
        lake.raw("dim_promotion"),
        RAW_TABLES["dim_promotion"],
        _titled("promo_name", "promo_type", "discount_type"),
        drop=["promo_duration"],
    )
    dates = ["promo_start_date", "promo_end_date"]
    rest = [c for c in promotions.columns if c not in ("promo_id", *dates)]
    first = keep_first(promotions, ["promo_id"], [*dates, *rest])
    return first.filter(F.col("promo_start_date").isNotNull())


@dataset("silver_dim_store", "silver")
def silver_dim_store(lake):
    return conform(lake.raw("dim_store"), RAW_TABLES["dim_store"], _titled("store_name", "store_type"))


@dataset("silver_fact_clickstream", "silver")
def silver_fact_clickstream(lake):
    return conform(
        lake.raw("fact_clickstream"),
        RAW_TABLES["fact_clickstream"],
        {"device_type": F.trim},
        drop=["aov_category"],
    )


@dataset("silver_fact_inventory", "silver", sort_by=STOCK_ORDER)
def silver_fact_inventory(lake):
    snapshots = conform(lake.raw("inventory"), RAW_TABLES["inventory"])
    return snapshots.withColumn("snapshot_month_id", month_id(F.col("snapshot_month")))


@dataset("silver_fact_sale", "silver")
def silver_fact_sale(lake):
    return conform(lake.raw("fact_sale"), RAW_TABLES["fact_sale"], drop=["aov_category"])


@dataset("silver_fact_transaction", "silver")
def silver_fact_transaction(lake):
    return conform(
        lake.raw("fact_transaction"),
        RAW_TABLES["fact_transaction"],
        {"sales_channel": lambda c: recode(c, SALES_CHANNELS)},
    )
