"""Catalogue views over one snapshot."""

import re

import pytest
from conftest import SMALL

import __spark_entry__ as spec
from shopledger import incremental, views
from shopledger.lakehouse import DATASETS
from shopledger.sources.snapshots import SnapshotStore

DB = views.Databases.prefixed("views_test_")


@pytest.fixture
def store(spark, tmp_path):
    yield SnapshotStore(spark, str(tmp_path / "tables"))
    views.drop_views(spark, DB)


def test_views_of_marts_have_their_rows_in_order(spark, store):
    lake = spec.lakehouse(spark, SMALL)
    marts = ["bi_sales_by_brand", "bi_sales_by_weekday", "bi_customer_loyalty_mix", "bi_returns_by_category_alt"]
    snapshot, _ = incremental.refresh(lake, store, ["gold_order_totals", "gold_fact_sale", *marts])
    made = views.create_views(spark, snapshot, DB)
    assert f"{DB.gold}.gold_fact_sale" in made
    for mart in marts:
        assert spark.sql(f"SELECT * FROM {DB.mart}.{mart}").collect() == lake.report(mart).collect()
    # another session sees them, which has no temporary view of this one
    other = spark.newSession()
    spark.range(1).createOrReplaceTempView("passing_view")
    assert other.sql(f"SELECT count(*) FROM {DB.mart}.bi_sales_by_weekday").first()[0] == 7
    assert not other.catalog.tableExists("passing_view")
    spark.catalog.dropTempView("passing_view")


def test_every_order_can_be_said_in_sql(spark):
    for name, found in DATASETS.items():
        if found.order:
            for part in views.order_sql(found.order()).split(", "):
                assert re.fullmatch(r"\w+( (ASC|DESC)( NULLS (FIRST|LAST))?)?", part), (name, part)


def test_copies_are_views_of_the_rows_stored_once(spark, tiny, store):
    lake = tiny(fact_transaction=[{"transaction_id": 1}, {"transaction_id": 2}])
    snapshot, _ = incremental.refresh(lake, store, ["silver_fact_transaction"])
    assert views.create_views(spark, snapshot, DB) == [
        f"{DB.silver}.silver_fact_transaction", f"{DB.gold}.gold_fact_transaction"
    ]
    files = [set(spark.table(f"{db}.{t}").inputFiles()) for db, t in
             ((DB.silver, "silver_fact_transaction"), (DB.gold, "gold_fact_transaction"))]
    assert files[0] == files[1]


def test_the_next_snapshot_replaces_views_and_drops_what_it_lacks(spark, tiny, store):
    old = tiny(dim_brand=[{"Brand_ID": 1, "Brand_Name": "x"}], dim_campaign=[{"campaign_id": 1}])
    new = tiny(dim_brand=[{"Brand_ID": 1, "Brand_Name": "x"}, {"Brand_ID": 2, "Brand_Name": "y"}])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DB.silver}")
    spark.range(5).write.mode("overwrite").saveAsTable(f"{DB.silver}.silver_dim_brand")  # of a release without views
    for lake, names, n in ((old, ["silver_dim_brand", "silver_dim_campaign"], 1), (new, ["silver_dim_brand"], 2)):
        snapshot, _ = incremental.refresh(lake, store, names)
        for _ in range(2):
            views.create_views(spark, snapshot, DB)
        assert spark.sql(f"SELECT count(*) FROM {DB.silver}.silver_dim_brand").first()[0] == n
    shown = {r.viewName for r in spark.sql(f"SHOW VIEWS IN {DB.silver}").collect()}
    assert shown == {"silver_dim_brand"}
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {DB.rows}").collect()] == ["silver_dim_brand__2"]
    described = spark.sql(f"DESCRIBE EXTENDED {DB.silver}.silver_dim_brand").collect()
    assert {r.data_type for r in described if r.col_name == "Comment"} == {"snapshot 2"}
