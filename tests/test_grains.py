"""Several grains in one pass."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as spec
from shopledger.operators.rollup import Grain, rollup_distinct, rollup_grains
from shopledger.plans.marts import SALES_GRAINS, sales_grains


def _measures():
    return {"total": F.col("v")}, {"entities": F.lit(True), "large": F.col("v") > 10}


def _grains():
    return [Grain("a", ("a",)), Grain("ab", ("a", "b")), Grain("none", ()), Grain("some_b", ("b",), F.col("v") > 3)]


def _rows(spark, rows):
    return spark.createDataFrame(rows, "e long, a string, b int, v long")


def _expected(df):
    out = set()
    for grain in _grains():
        rows = df if grain.rows is None else df.filter(grain.rows)
        for r in rollup_distinct(rows, list(grain.keys), "e", *_measures()).collect():
            # without any rows a total of everything has one row, a grain has none
            if grain.keys or rows.count():
                out.add((grain.name, *(r[k] if k in grain.keys else None for k in ("a", "b")), r.total, r.entities, r.large))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_grains_equal_separate_rollups(spark, seed):
    import random

    rnd = random.Random(seed)
    rows = [
        (rnd.choice([None, None, *range(30)]), rnd.choice("xyz") if rnd.random() < 0.9 else None, rnd.choice([1, 2, None]), rnd.randrange(20))
        for _ in range(400)
    ]
    df = _rows(spark, rows)
    found = [tuple(r) for r in rollup_grains(df, _grains(), "e", *_measures()).collect()]
    assert len(found) == len(set(found))
    assert set(found) == _expected(df)


def test_no_rows(spark):
    assert rollup_grains(_rows(spark, []), _grains(), "e", *_measures()).collect() == []


@pytest.mark.parametrize(
    "grain, mart, figures",
    [("month", "bi_revenue_by_month", ["net_revenue", "gross_profit", "orders", "units_sold"]),
     ("day", "bi_daily_sales", ["net_revenue", "gross_profit", "orders", "units_sold"]), ("channel", "bi_sales_by_channel", ["net_revenue", "orders"]),
     ("store", "bi_sales_by_store", ["net_revenue", "gross_profit", "orders"]), ("region", "bi_sales_by_region", ["net_revenue", "orders"]),
     ("weekday", "bi_sales_by_weekday", ["net_revenue", "orders"])],
)
def test_a_grain_equals_its_mart(spark, grain, mart, figures):
    lake = spec.lakehouse(spark, SMALL)
    columns = [*SALES_GRAINS[grain], *figures]
    found = sales_grains(lake).filter(F.col("grain") == grain).select(*columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, lake.table(mart).select(*columns).collect()))


def test_orders_are_read_once_and_shuffled_once(spark, tmp_path):
    lake = spec.lakehouse(spark, SMALL)
    lake._root = str(tmp_path)
    lake.store(["gold_order_totals", "gold_dim_store", "gold_dim_date"])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    df = sales_grains(lake)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet \[[^\]]*transaction_id", plan)) == 1
    # stores and days are sent out by their size; the orders go through one exchange, the groups through another
    assert plan.count("Exchange hashpartitioning") == 2, threshold
    below = plan.split("Exchange hashpartitioning(__spread")[0]
    assert "HashAggregate(keys=[grain" in below and "__entity" in below


def test_the_copies_of_a_small_shuffle_stay_in_many_tasks(spark):
    """Each task holds a few entities' copies, however small the rows are before they are copied."""
    df = _rows(spark, [(e, "x", e % 7, e) for e in range(2000)])
    totals = rollup_grains(df, _grains(), "e", *_measures())
    totals.collect()
    plan = totals._jdf.queryExecution().executedPlan().toString()
    above = plan.split("Generate explode")[1].split("Exchange hashpartitioning(__spread")[0]
    assert "coalesced" not in above
    assert re.search(r"Exchange hashpartitioning\(__spread#\d+L, 16\), REPARTITION_BY_NUM", plan)
