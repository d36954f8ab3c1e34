import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopledger.functions.dates import days_between, month_id, month_start, whole_years
from shopledger.operators.dedup import keep_first

AS_OF = dt.date(2002, 1, 1)


def born(age, shift=0):
    return dt.date(2002 - age, 1, 1) + dt.timedelta(days=shift)


def customers(*rows):
    return [dict(customer_id=i, email_address=f"u{i}@x.y", **row) for i, row in enumerate(rows)]


AGES = [
    (17, "55+", "Under 18"),
    (18, "18-24", "18-24"),
    (24, "18-24", "18-24"),
    (25, "25-34", "25-34"),
    (34, "25-34", "25-34"),
    (35, "35-44", "35-44"),
    (44, "35-44", "35-44"),
    (45, "45-54", "45-54"),
    (54, "45-54", "45-54"),
    (55, "55+", "55-64"),
    (64, "55+", "55-64"),
    (65, "55+", "65+"),
    (None, "55+", "65+"),
]
INCOMES = [
    ("29999.99", "Low Income", "Low"),
    ("30000", "Low Income", "Medium"),
    ("49999.99", "Low Income", "Medium"),
    ("50000", "Middle Income", "Medium"),
    ("75000", "Middle Income", "Medium"),
    ("75000.01", "Middle Income", "High"),
    ("100000", "Middle Income", "High"),
    ("100000.01", "High Income", "High"),
    ("150000", "High Income", "High"),
    ("150000.01", "High Income", "Premium"),
    (None, "High Income", "Premium"),
]


def labels(lake, column):
    return [
        [r[column] for r in lake.table(table).orderBy("customer_id").collect()]
        for table in ("silver_dim_customer", "silver_dim_customer_alt")
    ]


def test_age_bands(tiny):
    births = [None if age is None else born(age) for age, _, _ in AGES]
    lake = tiny(dim_customer=customers(*[{"birth_date": b, "birth_year": b and b.year} for b in births]))
    assert labels(lake, "age_group") == [[a[1] for a in AGES], [a[2] for a in AGES]]


def test_income_brackets(tiny):
    lake = tiny(dim_customer=customers(*[{"estimated_annual_income": i and Decimal(i)} for i, _, _ in INCOMES]))
    assert labels(lake, "income_bracket") == [[i[1] for i in INCOMES], [i[2] for i in INCOMES]]


def test_age_goes_up_on_the_birthday(tiny):
    lake = tiny(dim_customer=customers({"birth_date": born(18)}, {"birth_date": born(18, shift=1)}))
    ages = {r["customer_id"]: r["age"] for r in lake.table("silver_dim_customer").collect()}
    assert ages == {0: 18, 1: 17}


def test_customers_are_unique_by_lower_case_email_and_missing_emails_count_as_one(tiny):
    lake = tiny(
        dim_customer=[
            {"customer_id": 1, "email_address": "A@x.y", "signup_date": dt.date(2000, 5, 1)},
            {"customer_id": 2, "email_address": "a@x.y", "signup_date": dt.date(2000, 4, 1)},
            {"customer_id": 3, "email_address": "a@X.y", "signup_date": dt.date(2000, 4, 1)},
            {"customer_id": 4, "email_address": None, "signup_date": dt.date(2001, 1, 1)},
            {"customer_id": 5, "email_address": None, "signup_date": None},
        ]
    )
    assert sorted(r["customer_id"] for r in lake.table("silver_dim_customer").collect()) == [2, 5]


def test_channel_recodes(tiny):
    raw = ["Mobile App", "mobile app", "ONLINE", "in-store", "Partner", None]
    lake = tiny(
        dim_customer=customers(*[{"signup_channel": c} for c in raw]),
        fact_transaction=[
            {"transaction_id": i, "sales_channel": c} for i, c in enumerate(["In-Store", "IN-STORE", "Web", None])
        ],
    )
    signup = lake.table("silver_dim_customer").orderBy("customer_id").collect()
    assert [r["signup_channel"] for r in signup] == ["mobile", "mobile", "web", "store", "partner", None]
    # Orders recode only the exact spelling.
    sales = lake.table("silver_fact_transaction").orderBy("transaction_id").collect()
    assert [r["sales_channel"] for r in sales] == ["store", "in-store", "web", None]


def test_brand_names_are_unique_and_the_lowest_id_stays(tiny):
    lake = tiny(
        dim_brand=[
            {"Brand_ID": 9, "Brand_Name": "Acme"},
            {"Brand_ID": 2, "Brand_Name": "Acme"},
            {"Brand_ID": 3, "Brand_Name": "acme"},
        ]
    )
    assert [tuple(r) for r in lake.report("silver_dim_brand").collect()] == [(2, "Acme"), (3, "acme")]


def test_category_spellings_that_differ_in_case_both_stay(tiny):
    lake = tiny(
        dim_category=[
            {"category_id": 1, "category_name": "home audio"},
            {"category_id": 1, "category_name": "home audio"},
            {"category_id": 1, "category_name": "HOME AUDIO"},
        ]
    )
    assert [tuple(r) for r in lake.table("silver_dim_category").collect()] == [(1, "Home Audio")] * 2


def test_products_need_a_price_above_cost_and_one_row_per_id_and_name(tiny):
    def product(i, name="x", cost="1", price="2"):
        return {
            "product_id": i,
            "product_name": name,
            "unit_cost": cost and Decimal(cost),
            "unit_price": price and Decimal(price),
        }

    lake = tiny(
        dim_product=[
            product(1, "small bolt"),
            product(1, "SMALL BOLT"),
            product(2, cost="2"),
            product(3, cost=None),
            product(4, price=None),
            product(5, name=None),
            product(6, cost="1.99"),
        ]
    )
    rows = lake.table("silver_dim_product").orderBy("product_id").collect()
    assert [(r["product_id"], r["product_name"]) for r in rows] == [(1, "Small Bolt"), (6, "X")]


def test_promotion_keeps_the_earliest_start_and_drops_undated(tiny):
    day = dt.datetime(2000, 1, 1)
    lake = tiny(
        dim_promotion=[
            {"promo_id": 1, "promo_name": "late", "promo_start_date": day + dt.timedelta(days=3)},
            {"promo_id": 1, "promo_name": "early", "promo_start_date": day},
            {"promo_id": 2, "promo_start_date": None},
            {"promo_id": 3, "promo_start_date": day},
            {"promo_id": 3, "promo_start_date": None},
        ]
    )
    rows = lake.table("silver_dim_promotion").collect()
    assert [(r["promo_id"], r["promo_name"]) for r in rows] == [(1, "Early")]
    assert "promo_duration" not in rows[0].asDict()


@pytest.mark.parametrize(
    "start, end, active",
    [("2002-01-01", "2002-01-01", True), ("2002-01-02", "2002-02-01", False), ("2001-01-01", "2001-12-31", False)],
)
def test_alternative_promotion_is_active_on_the_day(tiny, start, end, active):
    lake = tiny(
        dim_promotion=[
            {
                "promo_id": 1,
                "promo_start_date": dt.datetime.fromisoformat(start),
                "promo_end_date": dt.datetime.fromisoformat(end),
                "is_active": not active,
            }
        ]
    )
    assert lake.table("silver_dim_promotion_alt").first()["is_active"] is active


def test_device_type_loses_spaces_only(tiny):
    lake = tiny(fact_clickstream=[{"session_id": 1, "device_type": "  mobile\t "}])
    assert lake.table("silver_fact_clickstream").first()["device_type"] == "mobile\t"


def test_keep_first_can_keep_rows_without_a_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, v int")
    one = keep_first(df, ["k"], ["v"]).collect()
    assert sorted((r["k"] or "", r["v"]) for r in one) == [("", 3), ("a", 1)]
    every = keep_first(df, ["k"], ["v"], keep_null_keys=True).collect()
    assert sorted((r["k"] or "", r["v"]) for r in every) == [("", 3), ("", 4), ("a", 1)]


def test_keep_first_puts_a_missing_order_value_first(spark):
    df = spark.createDataFrame([("a", 1, 7), ("a", None, 8)], "k string, o int, v int")
    assert keep_first(df, ["k"], ["o", "v"]).first()["v"] == 8


def test_date_helpers(spark):
    df = spark.sql(
        """SELECT TIMESTAMP_NTZ'2024-02-29 23:59:59.999999' AS last, TIMESTAMP_NTZ'2024-03-01 00:00:00' AS first,
                  DATE'2000-02-29' AS leap, DATE'2001-02-28' AS before, DATE'2001-03-01' AS after"""
    )
    row = df.select(
        month_start(F.col("last")).alias("a"),
        month_start(F.col("first")).alias("b"),
        month_id(F.col("leap")).alias("c"),
        whole_years(F.col("leap"), F.col("before")).alias("d"),
        whole_years(F.col("leap"), F.col("after")).alias("e"),
        days_between(F.col("last"), F.col("first")).alias("f"),
    ).first()
    assert tuple(row) == (dt.date(2024, 2, 1), dt.date(2024, 3, 1), 200002, 0, 1, 1)


def test_date_dimension(tiny):
    day = dt.date(2024, 2, 10)
    lake = tiny(dim_date=[{"date_id": 20240210, "date": day, "year": 2024, "quarter": 1, "month": 2}])
    row = lake.table("gold_dim_date").first()
    assert (row["days_in_month"], row["month_id"], row["year_quarter"]) == (29, 202402, "2024-Q1")
    other = lake.table("gold_dim_date_alt").first()
    assert (other["month_id"], other["year_quarter"]) == (202402, "2024Q1")
