"""The plans keep what makes them hold at scale."""

import re

import pytest

import __spark_entry__ as spec
from conftest import SMALL

QUERIES = spec.library_queries()
MARTS = [name for name in QUERIES if name.startswith("bi_")]


@pytest.fixture(scope="module")
def shuffled(spark):
    """Joins as they are when no side is small."""
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_and_no_cartesian_work(shuffled, name):
    df = QUERIES[name](shuffled, SMALL)
    plan = physical(df)
    assert not re.search(r"Python|InPandas|InArrow", plan)
    # The one cross join puts two single-row totals side by side.
    assert len(re.findall(r"CartesianProduct|NestedLoopJoin", plan)) == (name == "bi_kpi_summary_alt")
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("name", MARTS)
def test_distinct_counts_do_not_multiply_rows(shuffled, name):
    assert "Expand" not in physical(QUERIES[name](shuffled, SMALL))


@pytest.mark.parametrize("name", ["bi_revenue_by_month", "bi_daily_sales", "bi_sales_by_channel", "bi_kpi_summary"])
def test_counting_orders_reuses_the_layout_of_the_order_join(shuffled, name):
    plan = physical(spec.lakehouse(shuffled, SMALL).table(name))
    above_the_join = plan.split("SortMergeJoin")[0]
    assert above_the_join.count("Exchange") == 1  # the small final grouping


def test_dedup_sends_one_row_per_key_and_task(shuffled):
    plan = physical(spec.lakehouse(shuffled, SMALL).table("silver_dim_customer"))
    below_the_shuffle = plan.split("Exchange")[1]
    assert re.search(r"WindowGroupLimit.*row_number\(\), 1, Partial", below_the_shuffle)


def test_only_needed_columns_are_read(spark):
    plan = physical(spec.lakehouse(spark, SMALL).table("bi_sales_by_payment_type"))
    orders = next(re.findall(r"FileScan parquet \[([^\]]*)\]", line) for line in plan.split("\n") if "o_orderkey" in line and "FileScan" in line)
    assert "o_totalprice" not in orders[0]


def test_filters_reach_the_stored_table(spark, tmp_path):
    lake = spec.lakehouse(spark, SMALL).store(["gold_fact_transaction"])
    plan = physical(lake.table("bi_customer_summary"))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(transaction_status,Completed\)", plan)
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(customer_id\)", plan)


def test_per_id_sums_shrink_the_facts_before_the_look_up(shuffled):
    plan = physical(spec.lakehouse(shuffled, SMALL).table("bi_inventory_by_category"))
    lookup = plan.split("SortMergeJoin")[1]
    assert "HashAggregate(keys=[product_id" in lookup


@pytest.mark.parametrize("suffix", ["", "_alt"])
@pytest.mark.parametrize(
    "mart", ["kpi_summary", "revenue_by_month", "daily_sales", "sales_by_channel", "sales_by_store", "sales_by_region", "sales_by_weekday"]
)
def test_marts_of_orders_read_the_stored_orders(shuffled, mart, suffix):
    lake = spec.lakehouse(shuffled, SMALL).store([f"gold_fact_sale{suffix}", f"gold_order_totals{suffix}"])
    files = "\n".join(lake.table(f"bi_{mart}{suffix}").inputFiles())
    assert "/gold/gold_order_totals" in files and "/gold/gold_fact_sale" not in files


@pytest.mark.parametrize("suffix", ["", "_alt"])
@pytest.mark.parametrize("mart, link", [("sales_by_store", "store_id"), ("sales_by_region", "store_id"), ("returns_by_category", "product_id")])
def test_lines_are_reduced_before_a_look_up(shuffled, mart, link, suffix):
    lake = spec.lakehouse(shuffled, SMALL).store([f"gold_fact_sale{suffix}", f"gold_order_totals{suffix}"])
    plan = physical(lake.table(f"bi_{mart}{suffix}"))
    # of the two aggregates over (link, order), the partial one stands below every exchange
    join = re.split(r"(?:SortMerge|ShuffledHash)Join", plan)[1]
    assert re.search(rf"HashAggregate\(keys=\[{link}#\d+L, transaction_id#\d+L\], functions=\[partial", join)
    facts = join.split("FileScan")[0]
    assert facts.rfind("HashAggregate") > facts.rfind("Exchange")


@pytest.mark.parametrize("suffix", ["", "_alt"])
def test_lines_are_stored_as_the_order_join_lays_them_out(shuffled, suffix):
    """An order's lines share a file, without an exchange beyond those of the join."""
    written = []
    lake = spec.lakehouse(shuffled, SMALL).store([f"silver_fact_sale{suffix}", f"silver_fact_transaction{suffix}"])
    lake.store([f"gold_fact_sale{suffix}"], prepare=lambda name, df: written.append(df) or df)
    assert physical(written[0]).count("Exchange hashpartitioning(transaction_id") == 2
    assert "REBALANCE" not in physical(written[0])
    stored = lake.table(f"gold_fact_sale{suffix}").selectExpr("transaction_id", "input_file_name() AS file").distinct()
    assert stored.count() == stored.select("transaction_id").distinct().count()
