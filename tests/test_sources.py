import datetime as dt
import json
import re
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import AS_OF
from shopledger import Lakehouse, dataset
from shopledger.quality.expectations import enforce, expectations_on
from shopledger.session import RUNTIME_DEFAULTS, apply_runtime_defaults, shared_dir
from shopledger.sources.catalog import RAW_TABLES
from shopledger.sources.reader import (
    ParquetLanding,
    load_parquet,
    normalise_headers,
    rescue,
    row_counts,
    snake_case,
)
from shopledger.sources.sample import SampleRetail
from shopledger.sources.snapshots import SnapshotStore
from shopledger.sources.writer import read_table, write_table


def test_load_file_folder_and_glob(spark, tmp_path):
    df = spark.range(10)
    df.coalesce(1).write.parquet(str(tmp_path / "a.parquet"))
    df.repartition(3).write.parquet(str(tmp_path / "b.parquet"))
    part = next((tmp_path / "a.parquet").glob("*.parquet"))
    assert load_parquet(spark, str(part)).count() == 10
    assert load_parquet(spark, str(tmp_path / "b.parquet")).count() == 10
    assert load_parquet(spark, str(tmp_path / "*.parquet")).count() == 20


def test_a_landing_folder_feeds_the_lakehouse(spark, tmp_path):
    rows = spark.createDataFrame([(2, "B"), (1, "B")], "Brand_ID int, Brand_Name string")
    rows.write.parquet(str(tmp_path / "dim_brand.parquet"))
    lake = Lakehouse(spark, ParquetLanding(spark, str(tmp_path)), AS_OF)
    assert [tuple(r) for r in lake.table("silver_dim_brand").collect()] == [(1, "B")]


@pytest.mark.parametrize(
    "header, name", [("Brand_ID", "brand_id"), (" Order Date ", "order_date"), ("a", "a"), ("Net-Total%", "net_total")]
)
def test_headers(header, name):
    assert snake_case(header) == name


def test_normalise_headers(spark):
    df = spark.createDataFrame([(1, "x")], "Brand_ID int, Brand_Name string")
    assert normalise_headers(df).columns == ["brand_id", "brand_name"]


def test_rescue(spark):
    df = spark.createDataFrame(
        [("1", "2.50", 'say "hi"'), ("one", None, None), ("3", "much", "x")], "id string, price string, extra string"
    )
    out = rescue(df, {"id": "int", "price": "decimal(10,2)", "missing": "date"}).collect()
    assert out[0].asDict() | {"_rescued_data": None} == {
        "id": 1,
        "price": out[0]["price"],
        "missing": None,
        "_rescued_data": None,
    }
    assert json.loads(out[0]["_rescued_data"]) == {"extra": 'say "hi"'}
    assert (out[1]["id"], json.loads(out[1]["_rescued_data"])) == (None, {"id": "one"})
    assert json.loads(out[2]["_rescued_data"]) == {"price": "much", "extra": "x"}


def test_rescue_leaves_a_fitting_row_alone(spark):
    df = spark.createDataFrame([("1",), (None,)], "id string")
    assert [r["_rescued_data"] for r in rescue(df, {"id": "int"}).collect()] == [None, None]


def test_row_counts(spark):
    sizes = {"a": 3, "b": 0}
    out = row_counts(lambda name: spark.range(sizes[name]), sizes)
    assert {r["table_name"]: r["rows"] for r in out.collect()} == sizes


def test_write_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    assert write_table(spark.range(3), path, cluster_by=["id"]).count() == 3


def test_bucketed_tables_join_and_group_without_a_shuffle(spark, tmp_path):
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = (
            write_table(spark.range(100), str(tmp_path / name), table=name, bucket_by=["id"], buckets=4)
            for name in ("bucketed_left", "bucketed_right")
        )
        plan = left.join(right, "id").groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
        spark.sql("DROP TABLE bucketed_left")
        spark.sql("DROP TABLE bucketed_right")
    with pytest.raises(ValueError, match="table name"):
        write_table(spark.range(1), str(tmp_path / "x"), bucket_by=["id"], buckets=2)


def test_partitioned_write_prunes(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 2 AS part")
    table = write_table(df, str(tmp_path / "p"), partition_by=["part"])
    assert table.filter("part = 1").count() == 5
    assert {p.name for p in (tmp_path / "p").glob("version-*/part=*")} == {"part=0", "part=1"}


def test_a_failed_rebuild_leaves_the_table_as_it_was(spark, tiny, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(10), path)
    broken = spark.range(20).withColumn("id", F.when(F.col("id") < 15, F.col("id")).otherwise(F.raise_error(F.lit("stop"))))
    with pytest.raises(PySparkException, match="stop"):
        write_table(broken, path)
    assert read_table(spark, path).count() == 10
    rows = [{"sale_id": n, "transaction_id": 1} for n in range(10)]
    lake = tiny(fact_sale=rows)
    lake._root = str(tmp_path / "lake")
    lake.store(["silver_fact_sale"])
    rows.append({"sale_id": None})
    worse = tiny(fact_sale=rows)
    worse._root = lake.root
    with pytest.raises(PySparkException, match="valid_sale_id"):
        worse.store(["silver_fact_sale"], lambda name, df: enforce(df, expectations_on(name)))
    assert lake.table("silver_fact_sale").count() == 10
    assert read_table(spark, lake.path("silver_fact_sale")).count() == 10


def test_rebuilds_keep_two_versions_and_may_read_themselves(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_table(spark, path)
    table = write_table(spark.range(3), path)
    for _ in range(3):
        table = write_table(table.selectExpr("id + 1 AS id"), path)
    assert sorted(r.id for r in read_table(spark, path).collect()) == [3, 4, 5]
    assert len(list((tmp_path / "t").glob("version-*"))) == 2


def test_a_bucketed_table_can_be_rebuilt(spark, tmp_path):
    for rows in (10, 20):
        table = write_table(
            spark.range(rows), str(tmp_path / "b"), table="rebuilt_buckets", bucket_by=["id"], buckets=2
        )
        assert table.count() == rows
    spark.sql("DROP TABLE rebuilt_buckets")


def test_part_files_of_unequal_schema_keep_all_columns(spark, tmp_path):
    folder = str(tmp_path / "parts")
    spark.sql("SELECT 1 AS id, 'x' AS a").write.parquet(folder)
    spark.sql("SELECT 2 AS id, 'y' AS a, 'late' AS extra").write.mode("append").parquet(folder)
    loaded = load_parquet(spark, folder)
    assert {(r.id, r.a, r.extra) for r in loaded.collect()} == {(1, "x", None), (2, "y", "late")}
    rescued = rescue(loaded, {"id": "bigint", "a": "string"})
    assert {r.id: r._rescued_data for r in rescued.collect()} == {1: None, 2: '{"extra":"late"}'}


@pytest.mark.parametrize(
    "value, given, kind, fits",
    [
        ("1.7", "double", "bigint", False), ("2.0", "double", "bigint", True), ("1.7", "string", "bigint", False),
        ("12.345", "decimal(10,3)", "decimal(10,2)", False), ("12.340", "decimal(10,3)", "decimal(10,2)", True),
        ("12.345", "string", "decimal(10,2)", False), ("12.340", "string", "decimal(10,2)", True),
        ("007", "string", "int", True), ("x", "string", "int", False), ("1e40", "string", "int", False),
        ("2024-01-31 10:20:30", "timestamp_ntz", "date", False), ("2024-01-31 00:00:00", "timestamp_ntz", "date", True),
        ("2024-01-31 10:20:30", "string", "date", False), ("2024-01-31", "string", "date", True),
        ("300", "int", "tinyint", False), ("0.1", "double", "decimal(10,2)", True), ("7", "int", "string", True),
        ("true", "string", "boolean", True),
    ],
)
def test_rescue_keeps_what_a_cast_would_change(spark, value, given, kind, fits):
    row = rescue(spark.sql(f"SELECT CAST('{value}' AS {given}) AS v"), {"v": kind}).first()
    assert (row._rescued_data is None) == fits
    assert (row.v is not None) == fits


def test_stored_tables_are_entered_in_the_catalogue(spark, tiny):
    for brand in ("x", "y"):
        lake = tiny(dim_brand=[{"Brand_ID": 1, "Brand_Name": brand}])
        lake.create_schemas()
        lake.store_raw(["dim_brand"]).store(["silver_dim_brand"])
        assert lake.enter_tables() == ["bronze.dim_brand", "silver.silver_dim_brand"]
        assert spark.sql("SELECT brand_name FROM silver.silver_dim_brand").first()[0] == brand


def test_wide_names_and_keys_stop_the_load(spark, tmp_path):
    from shopledger.sources.sample import brand_number, key_id, name_id

    ids = spark.sql(f"SELECT p, {name_id('p')} AS i FROM VALUES ('A'), ('Z'), ('AA'), ('STANDARD'), (NULL) t(p)")
    assert {r.p: r.i for r in ids.collect()} == {"A": 1, "Z": 26, "AA": 28, "STANDARD": ids.filter("p = 'STANDARD'").first().i, None: None}
    assert spark.sql(f"SELECT {brand_number('p')} FROM VALUES ('Brand#25') t(p)").first()[0] == 25
    assert str(spark.sql(f"SELECT {key_id(('a', 3), ('b', 2))} FROM VALUES (12, 3) t(a, b)").first()[0]) == "1203"
    for expression in (name_id("p"), brand_number("p"), key_id(("length(p)", 1))):
        with pytest.raises(PySparkException):
            spark.sql(f"SELECT {expression} FROM VALUES ('Standard Anodized') t(p)").collect()


def test_stored_tables_are_read_from_then_on(spark, tiny):
    lake = tiny(dim_brand=[{"Brand_ID": 1, "Brand_Name": "x"}])
    lake.store_raw(["dim_brand"]).store(["silver_dim_brand"])
    assert lake.path("silver_dim_brand").startswith(shared_dir(spark))
    assert len(lake.table("silver_dim_brand").inputFiles()) == 1
    assert lake.table("silver_dim_brand").count() == 1


def test_storing_again_rebuilds_and_reaches_plans_made_before(spark, tiny):
    rows = {"dim_brand": [{"Brand_ID": 1, "Brand_Name": "x"}]}
    lake = tiny(**rows)
    before = lake.table("gold_dim_product")
    for _ in range(2):
        lake.store_raw(["dim_brand"]).store(["silver_dim_brand"])
    assert lake.table("silver_dim_brand").count() == 1
    assert lake.table("gold_dim_product") is not before
    rows["dim_brand"].append({"Brand_ID": 2, "Brand_Name": "y"})
    lake = tiny(**rows)
    lake.store(["silver_dim_brand"]).store(["silver_dim_brand"])
    assert lake.table("silver_dim_brand").count() == 2


def test_full_build_and_views(spark, tiny):
    lake = tiny(fact_sale=[{"sale_id": 1, "transaction_id": 1}], fact_transaction=[{"transaction_id": 1}]).build()
    assert lake.table("gold_fact_sale").count() == 1
    made = lake.create_views(["gold", "mart"])
    assert {"gold_dim_date", "bi_kpi_summary", "bi_kpi_summary_alt"} <= set(made)
    assert spark.sql("SELECT total_orders FROM bi_kpi_summary").first()[0] == 1
    for view in made:
        spark.catalog.dropTempView(view)


def test_schemas(spark, tiny):
    tiny().create_schemas()
    assert {"bronze", "silver", "gold", "_test_failures"} <= {d.name for d in spark.catalog.listDatabases()}


def test_names_are_defined_once(tiny):
    with pytest.raises(ValueError, match="already defined"):
        dataset("gold_dim_date", "gold")(lambda lake: None)
    with pytest.raises(ValueError, match="unknown layer"):
        dataset("new_one", "platinum")(lambda lake: None)
    lake = tiny()
    assert len(RAW_TABLES) == 14
    assert [len(lake.standard(layer)) for layer in ("silver", "gold", "mart")] == [14, 11, 25]
    assert [len(lake.names(layer)) for layer in ("silver", "gold", "mart")] == [28, 22, 50]


def test_settings_of_the_session_win(spark):
    key = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        apply_runtime_defaults(spark)
        assert spark.conf.get(key) == "false"
        spark.conf.unset(key)
        apply_runtime_defaults(spark)
        assert spark.conf.get(key) == RUNTIME_DEFAULTS[key]
    finally:
        spark.conf.set(key, before)


def test_as_of_is_the_only_clock(tiny):
    people = [{"customer_id": 1, "email_address": "a", "birth_date": dt.date(1980, 6, 1)}]
    ages = [
        tiny(as_of=day, dim_customer=people).table("silver_dim_customer").first()["age"]
        for day in (dt.date(2000, 5, 31), dt.date(2000, 6, 1))
    ]
    assert ages == [19, 20]


def test_a_declared_landing_keeps_what_does_not_fit(spark, tmp_path):
    rows = spark.createDataFrame([("7", "x", "y"), ("bad", "z", None)], "category_id string, category_name string, note string")
    rows.write.parquet(str(tmp_path / "dim_category.parquet"))
    lake = Lakehouse(spark, ParquetLanding(spark, str(tmp_path), RAW_TABLES), AS_OF)
    kept = {r["category_name"]: r["_rescued_data"] for r in lake.raw("dim_category").collect()}
    assert kept == {"x": '{"note":"y"}', "z": '{"category_id":"bad"}'}
    assert lake.table("silver_dim_category").columns == ["category_id", "category_name"]
    assert lake.table("silver_dim_category_alt").columns == ["category_id", "category_name"]


def test_stored_files_are_compressed_with_zstd(spark, tmp_path):
    write_table(spark.range(50), str(tmp_path / "table"))
    with SnapshotStore(spark, str(tmp_path / "store")).begin() as build:
        build.write("rows", spark.range(50))
    files = list(tmp_path.rglob("*.parquet"))
    found = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_row_groups}
    assert found == {"ZSTD"}


def test_orders_add_up_their_lines_exactly(spark, tmp_path):
    """Sums of lines in cents: half a cent rounded per line, lines without a price, orders without lines."""
    lines = [(1, 7, 10.05, 0.1, 2.0), (1, 3, 0.05, 0.1, 1.0), (2, 4, None, 0.1, 5.0), (4, 5, 99999999.99, 0.07, 1.0), (4, 5, 99999999.99, 0.07, 1.0)]
    columns = "l_orderkey long, l_suppkey long, l_extendedprice double, l_discount double, l_quantity double"
    orders = [(k, 1, "O", 0.0, dt.datetime(2000, 1, 1), "1") for k in (1, 2, 3, 4)]
    ddl = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(lines, columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame(orders, ddl).write.parquet(str(tmp_path / "orders.parquet"))
    made = SampleRetail(spark, str(tmp_path), dirt=False).fact_transaction()
    money = {r.transaction_id: (r.store_id, r.transaction_subtotal, r.transaction_discount_applied, r.transaction_cost, r.items_count) for r in made.collect()}
    assert money == {
        # 10.05 * 0.1 = 1.005 and 0.05 * 0.1 = 0.005 are rounded up each; so are the costs 6.03 and 0.03
        1: (3, Decimal("10.10"), Decimal("1.02"), Decimal("6.06"), 3),
        2: (4, None, None, None, 5),
        3: (None, None, None, None, None),
        4: (5, Decimal("199999999.98"), Decimal("14000000.00"), Decimal("119999999.98"), 2),
    }
    kinds = dict(made.dtypes)
    assert [kinds[f"transaction_{c}"] for c in ("subtotal", "discount_applied", "cost")] == ["decimal(20,2)", "decimal(24,2)", "decimal(22,2)"]
    plan = made._jdf.queryExecution().executedPlan().toString()
    # what is shuffled are whole numbers
    assert len(set(re.findall(r"partial_sum\(cast\(.*? as bigint\)\)", plan))) == 3 and "partial_sum(price" not in plan
