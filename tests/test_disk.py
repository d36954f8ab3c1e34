"""What builds leave on disk: shuffles go with the write that made them, files are small."""

import threading
import time

import pyarrow.parquet as pq
import pytest

from conftest import AS_OF
from shopledger import Lakehouse, incremental
from shopledger.session import RELEASE, shuffles_released
from shopledger.sources.snapshots import SnapshotStore
from shopledger.sources.writer import write_table

STOCK = [
    {"inventory_id": p * 1000 + s, "product_id": p, "store_id": s, "starting_stock": 1, "closing_stock": 1}
    for s in (3, 1, 2)
    for p in (5, 4, 9)
]


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}


def _left(spark, before):
    """Shuffle files since `before`; Spark removes them a moment after the query."""
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    rows, before = spark.range(1000).selectExpr("id % 7 AS k", "id"), _shuffle_files(spark)
    write_table(rows.groupBy("k").count(), str(tmp_path / "plain"))
    write_table(rows.groupBy("k").count(), str(tmp_path / "bucketed"), table="released_buckets", bucket_by=["k"], buckets=2)
    with SnapshotStore(spark, str(tmp_path / "store")).begin() as build:
        build.write("t", rows.groupBy("k").count())
    spark.sql("DROP TABLE released_buckets")
    assert _left(spark, before) == set()


def test_a_build_and_a_refresh_leave_no_shuffle_files(tiny, spark, tmp_path):
    lake, before = tiny(inventory=STOCK, dim_brand=[{"Brand_ID": 1, "Brand_Name": "x"}]), _shuffle_files(spark)
    lake.store(["silver_dim_brand", "silver_fact_inventory", "bi_inventory_by_month"])
    names = ["silver_dim_brand", "silver_fact_inventory", "bi_inventory_by_month", "bi_inventory_by_category"]
    incremental.refresh(lake, SnapshotStore(spark, str(tmp_path)), names, raw_version=lambda table: "1")
    assert _left(spark, before) == set()


def test_shuffles_are_kept_again_after_the_last_of_overlapping_blocks(spark):
    def now():
        return spark.conf.get(RELEASE)

    inside, go_on = threading.Event(), threading.Event()

    def other():
        with shuffles_released(spark):
            inside.set()
            go_on.wait(30)

    thread = threading.Thread(target=other)
    before = now()
    with shuffles_released(spark):
        thread.start()
        assert inside.wait(30) and now() == "true"
    assert now() == "true"
    go_on.set()
    thread.join()
    assert now() == before and RELEASE not in spark.conf.getAll
    with pytest.raises(KeyError), shuffles_released(spark):
        raise KeyError
    assert RELEASE not in spark.conf.getAll
    spark.conf.set(RELEASE, "false")
    try:
        with shuffles_released(spark):
            assert now() == "false"
        assert now() == "false"
    finally:
        spark.conf.unset(RELEASE)


def _files(folder):
    return [f for f in folder.rglob("*.parquet") if pq.ParquetFile(f).metadata.num_rows]


def _column(file, name):
    return pq.ParquetFile(file).read([name]).column(0).to_pylist()


def test_stock_lies_together_by_product_and_ids_need_no_dictionary(tiny, spark, tmp_path):
    source = tiny(inventory=STOCK)
    lake = Lakehouse(spark, lambda table: source.raw(table).coalesce(1), AS_OF, str(tmp_path / "lake"))
    lake.store(["silver_fact_inventory", "silver_fact_inventory_alt", "gold_fact_inventory"])
    store = SnapshotStore(spark, str(tmp_path / "store"))
    incremental.refresh(lake, store, ["silver_fact_inventory"], raw_version=lambda table: "1")
    files = _files(tmp_path)
    assert len(files) == 4
    for file in files:
        keys = list(zip(_column(file, "product_id"), _column(file, "store_id"), strict=True))
        assert keys == sorted((r["product_id"], r["store_id"]) for r in STOCK)
        chunks = pq.ParquetFile(file).metadata.row_group(0)
        coded = {chunks.column(i).path_in_schema: "DICTIONARY" in str(chunks.column(i).encodings) for i in range(chunks.num_columns)}
        assert not coded["product_id"] and not coded["store_id"] and coded["starting_stock"]
    lines = [sorted(map(str, lake.table(f"{layer}_fact_inventory").collect())) for layer in ("silver", "gold")]
    assert lines[0] == lines[1] and len(lines[0]) == len(STOCK)
