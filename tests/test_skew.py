"""One key owning a third of the rows changes no result, and its join partition is split."""

import shutil

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from compare import connect, difference, duck_rows, spark_rows
from conftest import AS_OF, SMALL

import __spark_entry__ as spec
from shopledger import Lakehouse
from shopledger.sources.catalog import RAW_TABLES
from shopledger.sources.reader import rescue

QUERIES = spec.queries()
ORACLE = spec.oracle_sql()
# table -> column -> the value a third of the rows get
HOT = {
    "lineitem": {"l_orderkey": 9, "l_partkey": 7, "l_suppkey": 3},
    "orders": {"o_custkey": 12},
    "events": {"user_id": 5},
    "customer": {"c_nationkey": 4},
    "part": {"p_brand": "Brand#2", "p_type": "SMALL"},
}
TRIED = [
    "gold_fact_sale",
    "gold_fact_sale_alt",
    "silver_customer",
    "silver_inventory",
    "silver_clickstream",
    "dq_report",
    "dq_failing_rows",
    "bi_kpi_summary",
    "bi_sales_by_store",
    "bi_sales_by_brand",
    "bi_returns_by_category",
    "bi_returns_by_category_alt",
    "bi_customer_loyalty_mix",
    "bi_customer_summary_alt",
    "bi_customer_new_vs_returning_by_month",
    "bi_customer_new_vs_returning_by_month_alt",
    "bi_clickstream_funnel_by_month",
    "bi_campaign_performance",
    "bi_promotion_performance_alt",
    "bi_inventory_by_category",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        source = f"{SMALL}/{name}.parquet"
        if name not in HOT:
            shutil.copy(source, folder / f"{name}.parquet")
            continue
        table = pq.read_table(source)
        hot_row = pc.equal(pc.bit_wise_and(pa.array(range(len(table))), 3), 0)  # a quarter ...
        more = pc.equal(pc.bit_wise_and(pa.array(range(len(table))), 15), 1)  # ... and a sixteenth
        hot = pc.or_(hot_row, more)
        for column, value in HOT[name].items():
            i = table.schema.get_field_index(column)
            kind = table.schema.field(i).type
            table = table.set_column(i, table.schema.field(i), pc.if_else(hot, pa.scalar(value, kind), table[column]))
        pq.write_table(table, folder / f"{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def duck(skewed):
    return connect(skewed)


@pytest.fixture(scope="module")
def shuffled(spark):
    before = {}
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.files.maxPartitionBytes": "16k",
        "spark.sql.files.openCostInBytes": "0",
    }
    for key, value in settings.items():
        before[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.mark.parametrize("name", TRIED)
def test_same_result(shuffled, skewed, duck, name):
    assert difference(spark_rows(QUERIES[name](shuffled, skewed)), duck_rows(duck, ORACLE[name])) is None


def test_a_long_order_is_split_in_the_order_join(shuffled):
    lines = shuffled.range(0, 60_000, 1, 6).selectExpr(
        "id AS sale_id",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS transaction_id",
        "id % 17 + 1.25 AS line_total",
        "id % 7 + 1.0 AS line_cost",
        "id % 5 + 1 AS quantity",
    )
    orders = shuffled.range(60_000).selectExpr(
        "id AS transaction_id",
        "id % 3 + 10.0 AS transaction_subtotal",
        "id % 2 + 1.0 AS transaction_discount_applied",
        "CASE WHEN id % 3 = 1 THEN 'Completed' ELSE 'Returned' END AS transaction_status",
        "CASE WHEN id % 2 = 0 THEN 'Web' ELSE 'In-Store' END AS sales_channel",
    )
    source = {"fact_sale": lines, "fact_transaction": orders}
    lake = Lakehouse(shuffled, lambda name: rescue(source[name], RAW_TABLES[name]), AS_OF)
    for name in ("gold_fact_sale", "bi_sales_by_channel"):
        df = lake.table(name)
        df.collect()
        assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString(), name
