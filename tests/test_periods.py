"""Reports over a stretch of time, and what they read."""

import datetime as dt
import re

import pytest
from conftest import AS_OF, SMALL

from shopledger import Lakehouse
from shopledger.operators.periods import MONTH, days_where, months_between, series_between, store_by_month
from shopledger.operators.report import date_range
from shopledger.sources.sample import SampleRetail


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    lake = Lakehouse(spark, SampleRetail(spark, SMALL), AS_OF, str(tmp_path_factory.mktemp("lake")))
    return store_by_month(lake, ["gold_order_totals", "gold_fact_clickstream"])


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _rows_scanned(df):
    """(rows, folders) of each scan of a table by month, most rows first."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, left = [], [plan]
    while left:
        node = left.pop()
        name = node.nodeName()
        if name.startswith("Scan parquet") and node.metrics().contains("numPartitions"):
            found.append((node.metrics().apply("numOutputRows").value(), node.metrics().apply("numPartitions").value()))
        if name.startswith("AdaptiveSparkPlan"):
            left.append(node.executedPlan())
        if "QueryStage" in name:
            left.append(node.plan())
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return sorted(found, reverse=True)


@pytest.mark.parametrize(
    "mart, column",
    [("bi_daily_sales", "sale_date"), ("bi_revenue_by_month", "month_start"), ("bi_clickstream_funnel_by_month", "month_start")],
)
@pytest.mark.parametrize(
    "start, end",
    [(dt.date(1996, 3, 10), dt.date(1996, 5, 9)), (dt.date(1995, 12, 31), dt.date(1996, 1, 1)), (dt.date(2050, 1, 1), dt.date(2050, 2, 1)),
     (dt.date(1996, 5, 1), dt.date(1996, 3, 1))],
)
def test_a_stretch_equals_the_whole_mart_cut(stored, mart, column, start, end):
    cut = series_between(stored, mart, column, start, end).collect()
    whole = date_range(stored.table(mart), column, start, end).collect()
    assert sorted(map(str, cut)) == sorted(map(str, whole))


def test_only_the_months_asked_for_are_read(stored):
    start, end = dt.date(1996, 3, 1), dt.date(1996, 5, 31)
    cut = series_between(stored, "bi_daily_sales", "sale_date", start, end)
    assert re.search(rf"PartitionFilters: \[[^\]]*{MONTH}#\d+ >= 199603\)[^\]]*{MONTH}#\d+ <= 199605\)", _plan(cut))
    (rows, partitions), *_ = _rows_scanned(cut)
    of_months = stored.table("gold_order_totals").filter(f"{MONTH} BETWEEN 199603 AND 199605").count()
    assert (rows, partitions) == (of_months, 3)


def test_days_of_the_calendar_prune_while_the_query_runs(stored):
    where = "year = 1996 AND month IN (2, 3) AND day <= 20"
    lake = days_where(stored, where)
    cut = lake.table("bi_daily_sales")
    assert "dynamicpruning" in _plan(cut)
    of_months = stored.table("gold_order_totals").filter(f"{MONTH} IN (199602, 199603)").count()
    assert _rows_scanned(cut) == [(of_months, 2)]
    days = {r.date for r in stored.table("gold_dim_date").filter(where).collect()}
    whole = [r for r in stored.table("bi_daily_sales").collect() if r.sale_date in days]
    assert sorted(map(str, lake.table("bi_daily_sales").collect())) == sorted(map(str, whole))


def test_rows_without_a_moment_and_facts_not_stored_by_month(tiny):
    orders = [{"transaction_id": 1, "transaction_timestamp": dt.datetime(2000, 1, 31, 23, 59)}, {"transaction_id": 2}]
    lines = [{"sale_id": i, "transaction_id": i} for i in (1, 2)]
    lake = tiny(fact_sale=lines, fact_transaction=orders)
    january = (dt.date(2000, 1, 1), dt.date(2000, 1, 31))
    plain = months_between(lake, *january).table("gold_order_totals").count()
    store_by_month(lake, ["gold_order_totals"])
    assert plain == lake.table("gold_order_totals").count() == 2
    assert months_between(lake, *january).table("gold_order_totals").count() == 1
    assert [str(r.sale_date) for r in series_between(lake, "bi_daily_sales", "sale_date", *january).collect()] == ["2000-01-31"]
    empty = store_by_month(tiny(), ["gold_order_totals"])
    assert series_between(empty, "bi_daily_sales", "sale_date", *january).collect() == []
