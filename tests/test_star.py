import datetime as dt
from decimal import Decimal

import pytest


def d(text):
    return None if text is None else Decimal(text)


def order(subtotal, discount, key=1, **more):
    return {
        "transaction_id": key,
        "transaction_subtotal": d(subtotal),
        "transaction_discount_applied": d(discount),
        "transaction_status": "Completed",
    } | more


def line(total="10", cost="4", key=1, sale=1, **more):
    return {"sale_id": sale, "transaction_id": key, "line_total": d(total), "line_cost": d(cost), "quantity": 1} | more


AMOUNTS = ["allocated_line_discount", "net_line_revenue", "net_line_profit"]


@pytest.mark.parametrize(
    "subtotal, discount, standard, alternative",
    [
        ("30", "1", ("0.33", "9.67", "5.67"), ("0.33", "9.67", "5.67")),
        ("0", "1", (None, None, None), (None, "10.00", "6.00")),
        (None, "1", (None, None, None), (None, "10.00", "6.00")),
        ("30", None, ("0.00", "10.00", "6.00"), (None, "10.00", "6.00")),
    ],
)
def test_allocation(tiny, subtotal, discount, standard, alternative):
    lake = tiny(fact_sale=[line()], fact_transaction=[order(subtotal, discount)])
    for table, expected in (("gold_fact_sale", standard), ("gold_fact_sale_alt", alternative)):
        row = lake.table(table).select(*AMOUNTS).first()
        assert tuple(row) == tuple(d(v) for v in expected), table


def test_line_without_an_order(tiny):
    lake = tiny(fact_sale=[line()])
    assert lake.table("gold_fact_sale").count() == 0
    row = lake.table("gold_fact_sale_alt").first()
    assert row["net_line_revenue"] == 10 and row["transaction_status"] is None


def test_amount_types(tiny):
    fields = {f.name: f.dataType.simpleString() for f in tiny().table("gold_fact_sale").schema.fields}
    assert [fields[a] for a in AMOUNTS] == ["decimal(24,2)", "decimal(26,2)", "decimal(27,2)"]


def test_allocated_cents_round_half_up(tiny):
    # 1 / 8 * 0.20 = 0.025
    lake = tiny(fact_sale=[line("1", "0")], fact_transaction=[order("8", "0.20")])
    assert lake.table("gold_fact_sale").first()["allocated_line_discount"] == Decimal("0.03")


def test_an_order_beyond_ten_digits_still_allocates(tiny):
    lake = tiny(fact_sale=[line("99999999.99")], fact_transaction=[order("9999999999.00", "500000000.00")])
    assert lake.table("gold_fact_sale").first()["allocated_line_discount"] == Decimal("5000000.00")


def test_look_ups_drop_or_keep_unmatched(tiny):
    lake = tiny(
        dim_customer=[
            {"customer_id": 1, "email_address": "a", "location_id": 7},
            {"customer_id": 2, "email_address": "b", "location_id": 99},
        ],
        dim_location=[{"location_id": 7, "city": "old town"}],
        dim_store=[{"store_id": 1, "location_id": 99}],
    )
    assert [r["city"] for r in lake.table("gold_dim_customer").collect()] == ["Old Town"]
    assert lake.table("gold_dim_customer_alt").count() == 2
    assert lake.table("gold_dim_store").count() == 0
    assert lake.table("gold_dim_store_alt").count() == 1


def test_a_dropped_brand_id_takes_its_products_along(tiny):
    def product(i, brand):
        price = {"unit_cost": Decimal(1), "unit_price": Decimal(2)}
        return {"product_id": i, "product_name": f"p{i}", "brand_id": brand, "category_id": 1, "subcategory_id": 1} | price

    lake = tiny(
        dim_brand=[{"Brand_ID": 1, "Brand_Name": "A"}, {"Brand_ID": 5, "Brand_Name": "A"}],
        dim_category=[{"category_id": 1, "category_name": "c d"}, {"category_id": 1, "category_name": "C D"}],
        dim_subcategory=[{"subcategory_id": 1, "subcategory_name": "s", "category_id": 1}],
        dim_product=[product(1, 1), product(2, 5)],
    )
    # Product 2 goes with brand id 5; product 1 doubles with the doubled category.
    assert [r["product_id"] for r in lake.table("gold_dim_product").collect()] == [1, 1]
    assert sorted(r["product_id"] for r in lake.table("gold_dim_product_alt").collect()) == [1, 1, 2, 2]


def test_facts_are_their_cleaned_tables(tiny):
    stamp = dt.datetime(2000, 1, 1)
    lake = tiny(fact_transaction=[order("1", "0", transaction_timestamp=stamp, sales_channel="In-Store")])
    assert lake.table("gold_fact_transaction").first()["sales_channel"] == "store"
    assert lake.table("gold_fact_transaction_alt").first()["sales_channel"] == "In-Store"


def test_allocation_does_not_depend_on_the_width_of_the_amounts(spark):
    from pyspark.sql import functions as F

    from shopledger.operators.allocate import allocate_by_rate, allocate_by_share

    amounts = spark.range(200_000).select(
        ((F.xxhash64("id", F.lit(1)) % 4_000_000 + 5_000_000) * Decimal("0.01")).cast("decimal(10,2)").alias("weight"),
        ((F.xxhash64("id", F.lit(2)) % 9_000_000 + 40_000_000) * Decimal("0.01")).cast("decimal(10,2)").alias("total"),
        ((F.xxhash64("id", F.lit(3)) % 900_000 + 2_000_000) * Decimal("0.01")).cast("decimal(10,2)").alias("amount"),
    )
    for allocate in (allocate_by_share, allocate_by_rate):
        narrow = allocate(F.col("weight"), F.col("total"), F.col("amount"))
        wide = allocate(F.col("weight"), F.col("total").cast("decimal(28,2)"), F.col("amount").cast("decimal(30,2)"))
        assert amounts.filter(~narrow.eqNullSafe(wide)).count() == 0


def test_allocation_keeps_thirteen_digits_of_the_quotient(spark):
    from pyspark.sql import functions as F

    from shopledger.operators.allocate import allocate_by_share

    # 0.3333333333333 * 15,000,000,000,000.00
    row = spark.sql("SELECT 1.00BD AS w, 3.00BD AS t, 15000000000000.00BD AS a").select(
        allocate_by_share(F.col("w"), F.col("t"), F.col("a")).alias("x")
    )
    assert row.first()["x"] == Decimal("4999999999999.50")
