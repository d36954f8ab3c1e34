import datetime as dt
import re
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spec
from conftest import SMALL
from shopledger import Lakehouse
from shopledger.operators.report import date_range, top_n
from shopledger.sources.sample import SampleRetail
from test_star import line, order

JAN, FEB = dt.datetime(2000, 1, 5), dt.datetime(2000, 2, 5)


def rows(lake, name):
    return [r.asDict() for r in lake.report(name).collect()]


def person(i, **more):
    return {"customer_id": i, "email_address": f"{i}@x", "location_id": 1, "loyalty_status": "Gold"} | more


PLACE = [{"location_id": 1, "city": "x", "country": "y", "state_province": "z", "location_type": "t"}]


def test_the_discount_of_an_order_counts_once(tiny):
    lake = tiny(
        dim_promotion=[{"promo_id": 1, "promo_name": "p", "promo_start_date": JAN}],
        fact_transaction=[order("30", "9", promo_id=1, transaction_total=Decimal(21))],
        fact_sale=[line(sale=i) for i in range(3)],
    )
    for name in ("bi_promotion_performance", "bi_promotion_performance_alt"):
        (row,) = rows(lake, name)
        assert (row["promo_orders"], row["discount_given"], row["promo_revenue"]) == (1, 9, 21), name


def test_profit_of_the_summary_counts_the_cost_of_lines_without_revenue(tiny):
    lake = tiny(
        fact_transaction=[order("10", "0", key=1, transaction_timestamp=JAN), order(None, "0", key=2)],
        fact_sale=[line(key=1, transaction_timestamp=JAN), line(key=2, sale=2, transaction_timestamp=JAN)],
    )
    assert rows(lake, "bi_kpi_summary")[0]["gross_profit"] == 2
    assert rows(lake, "bi_revenue_by_month")[0]["gross_profit"] == 6


def test_an_empty_source_gives_one_empty_summary_and_no_groups(tiny):
    lake = tiny()
    (row,) = rows(lake, "bi_kpi_summary")
    assert row["net_revenue"] is None and row["total_orders"] == 0 and row["aov"] is None
    assert rows(lake, "bi_revenue_by_month") == []
    assert [r["sessions"] for r in rows(lake, "bi_funnel_overall")] == [0, 0, 0, 0]
    assert [r["pct_of_sessions"] for r in rows(lake, "bi_funnel_overall")] == [100, None, None, None]
    assert [r["pct_of_sessions"] for r in rows(lake, "bi_funnel_overall_alt")] == [0, 0, 0, 0]


def test_a_group_of_returns_only_is_null_or_zero(tiny):
    lake = tiny(
        fact_transaction=[order("10", "0", sales_channel="Web", transaction_status="Returned")], fact_sale=[line()]
    )
    (standard,), (other,) = rows(lake, "bi_sales_by_channel"), rows(lake, "bi_sales_by_channel_alt")
    assert (standard["net_revenue"], standard["orders"], standard["aov"]) == (None, 0, None)
    assert (other["net_revenue"], other["orders"], other["aov"]) == (0, 0, 0)


def session(i, view=True, cart=False, bought=False, pages=3, **more):
    return {
        "session_id": i,
        "session_start_time": JAN,
        "product_page_visited_flag": view,
        "added_to_cart_flag": cart,
        "purchased_flag": bought,
        "number_of_pages_viewed": pages,
    } | more


def test_sessions_count_once_and_missing_ids_not_at_all(tiny):
    lake = tiny(
        fact_clickstream=[
            session(1, view=False, pages=1),
            session(1, cart=True),
            session(2, view=None, cart=None, bought=None),
            session(3, cart=True, bought=True),
            session(None, cart=True, bought=True, pages=1),
        ]
    )
    (row,) = rows(lake, "bi_clickstream_funnel_by_month")
    counts = [row[c] for c in ("sessions", "product_view_sessions", "add_to_cart_sessions", "purchase_sessions")]
    assert counts == [3, 2, 2, 1]
    assert row["bounce_rate_pct"] == Decimal("33.33")
    assert row["add_to_cart_rate_pct"] == 100
    (other,) = rows(lake, "bi_clickstream_funnel_by_month_alt")
    assert round(other["add_to_cart_rate_pct"], 2) == Decimal("66.67")
    assert round(other["bounce_rate_pct"], 2) == Decimal("33.33")


def test_month_edges(tiny):
    last = dt.datetime(2024, 2, 29, 23, 59, 59, 999999)
    lake = tiny(
        fact_clickstream=[
            session(1, session_start_time=last),
            session(2, session_start_time=dt.datetime(2024, 3, 1)),
        ]
    )
    months = [r["month_start"] for r in rows(lake, "bi_clickstream_funnel_by_month")]
    assert months == [dt.date(2024, 2, 1), dt.date(2024, 3, 1)]


def buy(key, customer, when, total="10", status="Completed"):
    return order("10", "0", key=key) | {
        "customer_id": customer,
        "transaction_timestamp": when,
        "transaction_total": Decimal(total),
        "transaction_status": status,
    }


def test_new_and_returning_customers(tiny):
    lake = tiny(
        fact_transaction=[
            buy(1, 1, JAN, status="Returned"),
            buy(2, 1, FEB, "5"),
            buy(3, 2, JAN, "7"),
            buy(4, 2, JAN, "8"),
            buy(5, 2, FEB, "9"),
            buy(6, None, FEB, "100"),
        ]
    )
    jan, feb = rows(lake, "bi_customer_new_vs_returning_by_month")
    # The second order in the first month still counts as new; customer 1 starts with the completed order.
    assert (jan["new_customers"], jan["new_customer_revenue"], jan["returning_customer_revenue"]) == (1, 15, None)
    assert (feb["new_customers"], feb["returning_customers"]) == (1, 1)
    assert (feb["new_customer_revenue"], feb["returning_customer_revenue"]) == (5, 9)
    jan, feb = rows(lake, "bi_customer_new_vs_returning_by_month_alt")
    assert (jan["new_customers"], feb["new_customers"], feb["returning_customers"]) == (2, 0, 2)


def test_customer_summary_and_loyalty(tiny):
    lake = tiny(
        dim_customer=[person(1), person(2), person(3)],
        dim_location=PLACE,
        fact_transaction=[
            buy(1, 1, JAN, "10.50"),
            buy(2, 1, FEB, "20"),
            buy(3, 2, FEB, "1"),
            buy(4, 3, FEB, "1", status="Returned"),
        ],
    )
    found = {r["customer_id"]: r for r in rows(lake, "bi_customer_summary")}
    assert set(found) == {1, 2}
    one = found[1]
    assert (one["orders"], one["lifetime_revenue"], one["is_repeat_customer"]) == (2, Decimal("30.50"), True)
    assert (one["first_order_ts"], one["last_order_ts"]) == (JAN, FEB)
    assert one["days_since_last_order"] == (dt.date(2002, 1, 1) - FEB.date()).days
    assert found[2]["is_repeat_customer"] is False
    (mix,) = rows(lake, "bi_customer_loyalty_mix")
    assert (mix["active_customers"], mix["repeat_customers"], mix["repeat_rate_pct"]) == (2, 1, 50)
    assert (mix["avg_revenue_per_customer"], mix["avg_orders_per_customer"]) == (Decimal("15.75"), 1.5)
    assert {r["customer_id"] for r in rows(lake, "bi_customer_summary_alt")} == {1, 2, 3}


def test_a_campaign_without_activity(tiny):
    lake = tiny(
        dim_campaign=[{"campaign_id": 1, "campaign_name": "quiet"}, {"campaign_id": 2, "campaign_name": "busy"}],
        fact_clickstream=[session(1, campaign_id=2), session(2, bought=True, campaign_id=2)],
        fact_transaction=[buy(1, 1, JAN, "4") | {"campaign_id": 2}, buy(2, 1, JAN, "5", "Returned") | {"campaign_id": 2}],
    )
    busy, quiet = rows(lake, "bi_campaign_performance")
    # Orders of any status, revenue of completed ones.
    assert (busy["sessions"], busy["attributed_orders"], busy["attributed_revenue"]) == (2, 2, 4)
    assert busy["conversion_rate_pct"] == 50
    assert (quiet["sessions"], quiet["attributed_orders"], quiet["attributed_revenue"]) == (0, 0, 0)
    assert quiet["conversion_rate_pct"] is None
    assert {r["campaign_name"]: r["conversion_rate_pct"] for r in rows(lake, "bi_campaign_performance_alt")}["quiet"] == 0


def test_stock_turnover_uses_the_mean_of_known_levels(tiny):
    month = dt.date(2000, 1, 1)

    def snapshot(i, start, close, sold, late):
        return {
            "inventory_id": i,
            "snapshot_month": month,
            "starting_stock": start,
            "closing_stock": close,
            "sold_units": sold,
            "backorder_flag": late,
        }

    lake = tiny(inventory=[snapshot(1, 10, 20, 30, True), snapshot(2, None, 7, 3, None), snapshot(3, 0, 5, 1, False)])
    (row,) = rows(lake, "bi_inventory_by_month")
    # Levels 15 and 2.5 have the mean 8.75; 34 / 8.75.
    assert (row["inventory_turnover"], row["backorder_rate_pct"]) == (Decimal("3.89"), Decimal("33.33"))
    (other,) = rows(lake, "bi_inventory_by_month_alt")
    assert other["inventory_turnover"] == pytest.approx(34 / (32 / 3))


def test_turnover_of_a_mean_level_of_a_third(tiny):
    """Three snapshots with the mean level 1/3, and 3,000,000 sold: 3,000,000 / 0.3333333333."""
    month = dt.date(2000, 1, 1)
    price = {"unit_cost": Decimal(1), "unit_price": Decimal(2), "brand_id": 1, "category_id": 1, "subcategory_id": 1}
    place = {"location_id": 1, "country": "x", "state_province": "y", "city": "z", "location_type": "urban"}
    stock = [
        {"inventory_id": i, "product_id": 1, "store_id": 1, "snapshot_month": month, "starting_stock": level,
         "closing_stock": level, "sold_units": 1_000_000, "backorder_flag": False}
        for i, level in enumerate((0, 0, 1))
    ]
    lake = tiny(
        dim_brand=[{"Brand_ID": 1, "Brand_Name": "b"}],
        dim_category=[{"category_id": 1, "category_name": "c"}],
        dim_subcategory=[{"subcategory_id": 1, "subcategory_name": "s", "category_id": 1}],
        dim_product=[{"product_id": 1, "product_name": "p"} | price],
        dim_location=[place],
        dim_store=[{"store_id": 1, "store_name": "s", "location_id": 1}],
        inventory=stock,
    )
    for mart in ("bi_inventory_by_category", "bi_inventory_by_store", "bi_inventory_by_month"):
        assert [r["inventory_turnover"] for r in rows(lake, mart)] == [Decimal("9000000.00")]


def test_turnover_does_not_depend_on_size(spark):
    """The same snapshots 400 times over, against the formula in exact fractions."""
    sample = SampleRetail(spark, SMALL)

    def raw(name):
        df = sample(name)
        return df.crossJoin(spark.range(400)).drop("id") if name == "inventory" else df

    lake = Lakehouse(spark, raw, spec.AS_OF)
    totals = {}
    joined = lake.table("gold_fact_inventory").join(lake.table("gold_dim_product"), "product_id")
    for key, starting, closing, sold in joined.select("category_name", "starting_stock", "closing_stock", "sold_units").collect():
        halves, n, all_sold = totals.get(key, (0, 0, 0))
        totals[key] = halves + starting + closing, n + 1, all_sold + sold
    for row in lake.table("bi_inventory_by_category").collect():
        halves, n, sold = totals[row["category_name"]]
        level = (Decimal(halves) / Decimal(2 * n)).quantize(Decimal("1e-10"), ROUND_HALF_UP)
        assert row["inventory_turnover"] == (Decimal(sold) / level).quantize(Decimal("1e-8"), ROUND_HALF_UP).quantize(
            Decimal("0.01"), ROUND_HALF_UP
        )


def test_quotients_have_the_digits_they_claim(tiny):
    lake = tiny()
    kinds = {m: dict(lake.table(m).dtypes) for m in lake.names("mart")}
    two_digits = {
        "bi_kpi_summary": ["gross_margin_pct", "aov", "return_rate_pct"],
        "bi_revenue_by_month": ["gross_margin_pct"],
        "bi_daily_sales": ["aov"],
        "bi_inventory_by_category": ["inventory_turnover", "backorder_rate_pct"],
        "bi_inventory_by_store": ["inventory_turnover"],
        "bi_inventory_by_month": ["inventory_turnover"],
        "bi_funnel_overall": [],
        "bi_campaign_performance": ["conversion_rate_pct"],
    }
    for mart, columns in two_digits.items():
        for column in columns:
            assert re.fullmatch(r"decimal\(\d+,2\)", kinds[mart][column]), (mart, column, kinds[mart][column])
    level = F.round(F.lit(1).cast("decimal(19,0)") / F.lit(3).cast("decimal(20,0)"), 10)
    frame = lake.spark.range(1).select(level.alias("level"))
    assert frame.dtypes[0][1].endswith(",10)") and frame.first().level == Decimal("0.3333333333")


def test_customers_given_twice_count_once_but_their_revenue_twice(tiny):
    person = {"customer_id": 1, "loyalty_status": "gold", "email_address": "a", "estimated_annual_income": Decimal(1)}
    given = dict(
        dim_customer=[person, person, person | {"signup_channel": "Online"}],
        fact_transaction=[buy(1, 1, JAN, "4"), buy(2, 1, JAN, "5")],
        fact_sale=[
            {"sale_id": i, "transaction_id": i, "line_total": Decimal(i), "line_cost": Decimal(0), "quantity": 1}
            for i in (1, 2)
        ],
    )
    lake = tiny(**given)
    found = sorted((r["orders"], r["lifetime_revenue"], r["is_repeat_customer"]) for r in rows(lake, "bi_customer_summary_alt"))
    assert found == [(2, 3, True), (2, 6, True)]
    (mix,) = rows(lake, "bi_customer_loyalty_mix_alt")
    assert (mix["active_customers"], mix["repeat_customers"], mix["net_revenue"]) == (1, 1, 9)
    assert mix["avg_orders_per_customer"] == 2


def test_a_backorder_share_is_cut_to_five_digits_first(tiny):
    month = dt.date(2000, 1, 1)
    flags = [True] * 2 + [False] * 160  # 0.0123456... -> 0.01235 -> 1.24
    lake = tiny(
        inventory=[{"inventory_id": i, "snapshot_month": month, "backorder_flag": f} for i, f in enumerate(flags)]
    )
    assert rows(lake, "bi_inventory_by_month")[0]["backorder_rate_pct"] == Decimal("1.24")


def test_products_of_one_name_are_one_row(tiny):
    price = {"unit_cost": Decimal(1), "unit_price": Decimal(2), "brand_id": 1, "category_id": 1, "subcategory_id": 1}
    lake = tiny(
        dim_brand=[{"Brand_ID": 1, "Brand_Name": "b"}],
        dim_category=[{"category_id": 1, "category_name": "c"}],
        dim_subcategory=[{"subcategory_id": 1, "subcategory_name": "s", "category_id": 1}],
        dim_product=[{"product_id": i, "product_name": "same"} | price for i in (1, 2)],
        fact_transaction=[order("20", "0")],
        fact_sale=[line(sale=i, product_id=i) for i in (1, 2, 3)],
    )
    (row,) = rows(lake, "bi_top_products")
    assert (row["product_name"], row["net_revenue"], row["units_sold"]) == ("Same", 20, 2)
    # The unknown product 3 is dropped, or kept without a name.
    assert [r["product_name"] for r in rows(lake, "bi_top_products_alt")] == ["same", None]


def test_top_n_and_date_range(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", None), ("d", 9)], "name string, v int")
    assert [r["name"] for r in top_n(df, "v", 3, ["name"]).collect()] == ["d", "a", "b"]
    days = spark.createDataFrame([(dt.date(2000, 1, i),) for i in range(1, 6)], "day date")
    kept = date_range(days, "day", dt.date(2000, 1, 2), dt.date(2000, 1, 4))
    assert kept.count() == 3


@pytest.fixture(scope="module")
def clean(spark):
    lake = Lakehouse(spark, SampleRetail(spark, SMALL, dirt=False), spec.AS_OF)
    return lake.store(["gold_fact_sale", "gold_fact_transaction", "gold_dim_product"])


def total(lake, mart, column):
    return sum(r[column] or 0 for r in lake.table(mart).collect())


def test_totals_agree_across_cuts(clean):
    summary = clean.table("bi_kpi_summary").first()
    for mart in (
        "bi_revenue_by_month",
        "bi_daily_sales",
        "bi_sales_by_category",
        "bi_sales_by_brand",
        "bi_sales_by_subcategory",
        "bi_sales_by_channel",
        "bi_sales_by_store",
        "bi_sales_by_region",
        "bi_sales_by_weekday",
        "bi_top_products",
    ):
        assert total(clean, mart, "net_revenue") == summary["net_revenue"], mart
    for mart in ("bi_revenue_by_month", "bi_daily_sales", "bi_sales_by_channel", "bi_sales_by_weekday"):
        assert total(clean, mart, "orders") == summary["total_transactions"], mart
    assert total(clean, "bi_returns_by_category", "returned_revenue") == summary["gross_revenue"] - summary["net_revenue"]


def test_allocated_discount_stays_within_half_a_cent_per_line(clean):
    from pyspark.sql import functions as F

    per_order = clean.table("gold_fact_sale").groupBy("transaction_id").agg(
        F.sum("allocated_line_discount").alias("spread"), F.count("*").alias("n")
    )
    off = per_order.join(clean.table("gold_fact_transaction"), "transaction_id").filter(
        F.abs(F.col("spread") - F.col("transaction_discount_applied")) > F.col("n") * Decimal("0.005")
    )
    assert off.count() == 0


def test_new_and_returning_add_up_to_the_active_customers(clean):
    from pyspark.sql import functions as F

    from shopledger.functions.dates import month_start

    active = {
        r["m"]: r["n"]
        for r in clean.table("gold_fact_transaction")
        .filter("transaction_status = 'Completed' AND customer_id IS NOT NULL")
        .groupBy(month_start(F.col("transaction_timestamp")).alias("m"))
        .agg(F.count_distinct("customer_id").alias("n"))
        .collect()
    }
    split = {
        r["month_start"]: r["new_customers"] + r["returning_customers"]
        for r in clean.table("bi_customer_new_vs_returning_by_month").collect()
    }
    assert split == active
