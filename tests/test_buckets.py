"""Orders and their lines stored in buckets by order: joins and groupings of them without a shuffle, the same rows."""

import json
import os

import pytest

import __spark_entry__ as spec
from conftest import AS_OF, SMALL
from shopledger import Lakehouse, incremental
from shopledger.sources import writer
from shopledger.sources.sample import SampleRetail
from shopledger.sources.snapshots import SnapshotStore
from shopledger.sources.writer import Buckets

KEY = "transaction_id"
LINES, ORDERS, SALE = "silver_fact_sale", "silver_fact_transaction", "gold_fact_sale"
BY_ORDER = dict.fromkeys([LINES, ORDERS, SALE, "gold_fact_transaction", "gold_order_totals"], Buckets(KEY, 4))
MARTS = ["bi_returns_by_category", "bi_daily_sales", "bi_sales_by_payment_type", "bi_customer_summary"]


@pytest.fixture
def shuffled(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    yield spark
    spark.conf.set(key, before)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.collect()))


def _catalogue(spark):
    return {t.name for t in spark.catalog.listTables()}


def test_the_order_join_of_stored_tables_takes_no_shuffle(shuffled, tmp_path):
    before = _catalogue(shuffled)
    sample = SampleRetail(shuffled, SMALL)
    plain = Lakehouse(shuffled, sample, AS_OF, str(tmp_path / "plain")).store([LINES, ORDERS, SALE])
    lake = Lakehouse(shuffled, sample, AS_OF, str(tmp_path / "lake")).store([LINES, ORDERS], laid_out=BY_ORDER)
    assert "Exchange" in _plan(plain.define(SALE)) and "Exchange" not in _plan(lake.table(SALE))
    lake.store([SALE], laid_out=BY_ORDER)
    assert "Exchange" not in _plan(lake.table("gold_order_totals"))
    for name in (LINES, ORDERS, SALE, "gold_order_totals"):
        assert _rows(lake.table(name)) == _rows(plain.table(name))
    # a task of the join has whole buckets, so each is one file
    assert len(list((tmp_path / "lake/gold" / SALE).rglob("*.parquet"))) <= 4
    assert _catalogue(shuffled) == before


def test_keys_that_are_missing_or_repeated(shuffled, tiny, tmp_path):
    lines = [{"sale_id": i, KEY: k, "quantity": i} for i, k in enumerate([1, 1, 2, None, None, 7])]
    orders = [{KEY: k, "customer_id": i} for i, k in enumerate([1, 1, 2, 3, None])]
    names = [f"{name}{suffix}" for suffix in ("", "_alt") for name in (LINES, ORDERS, SALE)]
    plain = tiny(fact_sale=lines, fact_transaction=orders).store(names)
    lake = tiny(fact_sale=lines, fact_transaction=orders).store(names, laid_out=dict.fromkeys(names, Buckets(KEY, 3)))
    for name in names:
        assert _rows(lake.table(name)) == _rows(plain.table(name))
    assert (lake.table(SALE).count(), lake.table(f"{SALE}_alt").count()) == (5, 8)


def test_a_refresh_keeps_the_buckets_in_its_snapshot(shuffled, tmp_path):
    lake = Lakehouse(shuffled, SampleRetail(shuffled, SMALL), AS_OF)
    store, names = SnapshotStore(shuffled, str(tmp_path / "tables")), [*BY_ORDER, "gold_dim_product", "gold_dim_customer", *MARTS]
    snapshot, _ = incremental.refresh(lake, store, names, laid_out=BY_ORDER)
    assert {n for n, v in snapshot.tables.items() if v.buckets} == set(BY_ORDER)
    again = store.snapshot()
    assert again.tables == snapshot.tables
    assert "Exchange" not in _plan(again.table(SALE).groupBy(KEY).count())
    assert {n: again.tables[n].rows for n in BY_ORDER} == {n: again.table(n).count() for n in BY_ORDER}
    for name in MARTS:
        assert _rows(again.table(name)) == _rows(lake.table(name))
    # the same rows, rebuilt without buckets: the version stays, and what it is
    last, done = incremental.refresh(lake, store, names, again=[ORDERS])
    assert [d.name for d in done if d.rebuilt] == [ORDERS] and last.tables == snapshot.tables
    assert "Exchange" not in _plan(last.table(ORDERS).groupBy(KEY).count())


def test_buckets_in_any_folder(spark, tmp_path):
    rows = spark.range(100).withColumnRenamed("id", KEY)
    for folder in (f"{tmp_path}/it's 50 % done", f"file:{tmp_path}/b", os.path.relpath(tmp_path / "relative")):
        stored = writer.write_table(rows, folder, laid_out=Buckets(KEY, 3))
        assert sorted(r[0] for r in stored.collect()) == list(range(100))
        assert "Exchange" not in _plan(stored.groupBy(KEY).count())
    assert len(list((tmp_path / "relative").rglob("*.parquet"))) > 0


def test_snapshots_from_before_there_were_buckets(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    with store.begin() as build:
        build.write("a", spark.range(3))
    file = next((tmp_path / "_snapshots").glob("*.json"))
    tables = json.loads(file.read_text())
    file.unlink()
    store.log.drop(f".{file.name}.crc")
    old = {name: {k: v for k, v in found.items() if "bucket" not in k} for name, found in tables.items()}
    store.log.publish(file.name, json.dumps(old))
    assert store.snapshot().table("a").count() == 3


def test_buckets_only_for_many_rows_spread_over_keys(spark, monkeypatch):
    many = spark.range(4000)
    assert Buckets.for_keys(KEY, many) is None
    monkeypatch.setattr(writer, "BUCKET_ROWS", 1000)
    monkeypatch.setattr(writer, "BUCKET_MOST", 10_000)
    assert Buckets.for_keys(KEY, many) == Buckets.for_keys(KEY, spark.range(5), many) == Buckets(KEY, 4)
    assert Buckets.for_keys(KEY, spark.range(0), spark.range(3999)) is None
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        wide = spark.range(40_000)
        assert Buckets.for_keys(KEY, wide) == Buckets(KEY, 16)
        assert Buckets.for_keys(KEY, spark.range(170_000)) == Buckets(KEY, 32)
        assert Buckets.for_keys(KEY, wide.selectExpr("if(id < 20000, 1, id) AS id")) is None
        assert Buckets.for_keys(KEY, wide, wide.selectExpr("if(id < 20000, NULL, id) AS id")) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_observed_counts_are_the_same_in_buckets(shuffled, monkeypatch):
    monkeypatch.setattr(writer, "BUCKET_ROWS", 0)
    stored = spec._by_order(SampleRetail(shuffled, SMALL), [LINES, f"{SALE}_alt", "silver_fact_inventory"])
    assert stored == {LINES: Buckets(KEY, 4), f"{SALE}_alt": Buckets(KEY, 4)}
    queries = spec.queries()
    assert _rows(queries["expect_observed"](shuffled, SMALL)) == _rows(queries["expect_warn_report"](shuffled, SMALL))
