"""Snapshots over many tables, and rebuilding only what has changed."""

import datetime as dt

import pytest
from conftest import AS_OF
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shopledger import Lakehouse, incremental
from shopledger.sources.catalog import RAW_TABLES
from shopledger.sources.reader import ParquetLanding
from shopledger.sources.snapshots import Conflict, SnapshotStore
from shopledger.sources.writer import Folder


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, f"file:{tmp_path}/tables")


def _numbers(df):
    return sorted(r[0] for r in df.collect())


def _publish(store, **tables):
    with store.begin() as build:
        for name, df in tables.items():
            build.write(name, df)
    return build.published


def test_a_reader_sees_all_tables_of_one_build(spark, store):
    assert store.snapshot().tables == {}
    first = _publish(store, a=spark.range(3), b=spark.range(4))
    with store.begin() as build:
        build.write("a", spark.range(5))
        # not yet
        assert store.snapshot().table("a").count() == 3
        assert build.table("a").count() == 5
        build.write("b", spark.range(6))
    last = store.snapshot()
    assert (first.number, last.number) == (1, 2)
    assert [s.table(t).count() for s in (first, store.snapshot(1), last) for t in "ab"] == [3, 4, 3, 4, 5, 6]
    assert {t: v.rows for t, v in last.tables.items()} == {"a": 5, "b": 6}


def test_a_build_that_fails_half_way_leaves_nothing(spark, store, tmp_path):
    before = _publish(store, a=spark.range(3), b=spark.range(4))
    folders = sorted(p.name for p in (tmp_path / "tables").glob("*/version-*"))
    with pytest.raises(PySparkException, match="half way"), store.begin() as build:
        build.write("a", spark.range(9))
        build.write("b", spark.range(9).select(F.raise_error(F.lit("half way")).alias("id")))
    with pytest.raises(KeyError), store.begin() as build:
        build.write("a", spark.range(8))
        raise KeyError
    after = store.snapshot()
    assert after.number == before.number and after.tables == before.tables
    assert _numbers(after.table("a")) == [0, 1, 2]
    assert sorted(p.name for p in (tmp_path / "tables").glob("*/version-*")) == folders


def test_of_two_builds_from_one_snapshot_the_first_is_published(spark, store, tmp_path):
    _publish(store, a=spark.range(1))
    one, two = store.begin(), store.begin()
    one.write("a", spark.range(2))
    two.write("a", spark.range(3))
    assert one.publish().number == 2
    with pytest.raises(Conflict):
        two.publish()
    assert store.snapshot().table("a").count() == 2
    assert len(list((tmp_path / "tables" / "a").iterdir())) == 2
    assert [p.name for p in (tmp_path / "tables" / "_snapshots").iterdir() if p.name.startswith(".") and "crc" not in p.name] == []


def test_equal_rows_keep_their_version(spark, store):
    rows = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "id long, v string")
    _publish(store, a=rows)
    with store.begin() as build:
        assert not build.write("a", rows.orderBy(F.desc("id")))
    assert store.numbers() == [1]
    for other in (rows.limit(2), rows.unionByName(rows), rows.withColumn("id", F.col("id").cast("int")), rows.fillna("")):
        with store.begin() as build:
            assert build.write("a", other)


def test_old_snapshots_expire_with_the_versions_that_only_they_name(spark, store, tmp_path):
    same = spark.range(2)
    for n in range(4):
        _publish(store, a=spark.range(n + 1), same=same)
    held = store.snapshot(1)
    lost = Folder(spark, f"{store.root}/a")
    spark.range(7).write.parquet(f"{store.root}/a/version-lost")
    assert store.expire(keep=2, hold=[1]) == [2]
    assert store.numbers() == [1, 3, 4]
    assert held.table("a").count() == 1
    assert store.expire(keep=1) == [1, 3]
    assert store.snapshot().table("a").count() == 4 and store.snapshot().table("same").count() == 2
    assert len(lost.versions()) == 2  # that of a build at work, for all it knows
    assert store.sweep(3600) == [] and store.sweep(0) == ["a/version-lost"]
    assert len(list((tmp_path / "tables" / "a").iterdir())) == 1
    with pytest.raises(FileNotFoundError):
        store.snapshot(3)


def test_empty_partitioned_and_clustered_tables(spark, store):
    with store.begin() as build:
        build.write("none", spark.range(0))
        build.write("parts", spark.sql("SELECT id, id % 3 AS part FROM range(10)"), partition_by=["part"])
        build.write("grouped", spark.sql("SELECT id % 2 AS k, id FROM range(100)"), cluster_by=["k"])
    found = store.snapshot()
    assert [found.table(t).count() for t in ("none", "parts", "grouped")] == [0, 10, 100]
    assert found.tables["grouped"].rows == 100
    assert found.table("parts").columns == ["id", "part"]
    assert len(found.table("parts").filter("part = 1").inputFiles()) >= 1


def test_a_snapshot_by_catalogue_name(spark, store):
    for n in (2, 3):
        _publish(store, a=spark.range(n)).enter({"a": "entered_a"})
        assert spark.sql("SELECT count(*) FROM entered_a").first()[0] == n
    spark.sql("DROP TABLE entered_a")


# rebuilding


@pytest.fixture
def landed(spark, tmp_path):
    """A lakehouse over files, and a function that replaces a raw table."""
    folder = str(tmp_path / "landing")

    def put(**tables):
        for name, rows in tables.items():
            schema = ", ".join(f"`{c}` {kind}" for c, kind in RAW_TABLES[name].items())
            values = [tuple(row.get(c) for c in RAW_TABLES[name]) for row in rows]
            spark.createDataFrame(values, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")

    put(**{name: [] for name in RAW_TABLES})
    put(
        dim_brand=[{"Brand_ID": 1, "Brand_Name": "x"}],
        dim_campaign=[{"campaign_id": 1, "campaign_channel": "Mail"}],
        fact_transaction=[{"transaction_id": 1, "transaction_status": "Completed"}],
    )
    return lambda as_of=AS_OF: Lakehouse(spark, ParquetLanding(spark, folder), as_of), put


NAMES = ["silver_dim_brand", "silver_dim_campaign", "silver_dim_product", "silver_dim_customer", "gold_dim_product", "gold_dim_campaign"]


def _did(done):
    return {d.name for d in done if d.rebuilt}, {d.name for d in done if d.changed}


def test_edges_are_those_the_definitions_ask_for(landed):
    lake, _ = landed
    edges = incremental.dependencies(lake(), ["gold_dim_product", "silver_dim_customer"])
    assert edges["silver_dim_brand"] == {"bronze.dim_brand"}
    assert {"silver_dim_product", "silver_dim_brand"} <= edges["gold_dim_product"]
    assert edges["silver_dim_customer"] == {"bronze.dim_customer", "as_of"}
    order = incremental.build_order(edges)
    assert order.index("silver_dim_product") < order.index("gold_dim_product")
    assert incremental.descendants(edges, ["bronze.dim_brand"]) == {"silver_dim_brand", "gold_dim_product"}
    with pytest.raises(ValueError, match="cycle"):
        incremental.build_order({"a": {"b"}, "b": {"a"}})


def test_only_stale_tables_and_what_is_built_from_them_are_rebuilt(landed, store):
    lake, put = landed
    snapshot, done = incremental.refresh(lake(), store, NAMES)
    assert _did(done) == (set(NAMES), set(NAMES)) and snapshot.number == 1
    again, done = incremental.refresh(lake(), store, NAMES)
    assert _did(done) == (set(), set()) and again.number == 1

    put(dim_brand=[{"Brand_ID": 1, "Brand_Name": "y"}])
    snapshot, done = incremental.refresh(lake(), store, NAMES)
    assert _did(done)[0] == {"silver_dim_brand", "gold_dim_product"}
    assert {d.name: d.stale for d in done if d.rebuilt}["silver_dim_brand"] == ("bronze.dim_brand",)
    assert snapshot.table("silver_dim_brand").first().brand_name == "y"
    assert store.snapshot(1).table("silver_dim_brand").first().brand_name == "x"

    # the day changes the age of customers, and no other table asks for it
    _, done = incremental.refresh(lake(dt.date(2003, 1, 1)), store, NAMES)
    assert _did(done)[0] == {"silver_dim_customer"}

    _, done = incremental.refresh(lake(dt.date(2003, 1, 1)), store, NAMES, again=["silver_dim_campaign"])
    assert _did(done) == ({"silver_dim_campaign"}, set())


def test_rows_that_come_out_the_same_stop_the_rebuild(landed, store):
    lake, put = landed
    incremental.refresh(lake(), store, NAMES)
    # a new file; its second row is a duplicate that cleaning removes
    put(dim_brand=[{"Brand_ID": 1, "Brand_Name": "x"}, {"Brand_ID": 2, "Brand_Name": "x"}])
    _, done = incremental.refresh(lake(), store, NAMES)
    assert _did(done) == ({"silver_dim_brand"}, set())
    _, done = incremental.refresh(lake(), store, NAMES)
    assert _did(done) == (set(), set())


def test_views_pass_on_what_changes_below_them(landed, store):
    lake, put = landed
    incremental.refresh(lake(), store, ["gold_dim_product"])
    put(dim_brand=[{"Brand_ID": 5, "Brand_Name": "z"}])
    _, done = incremental.refresh(lake(), store, ["gold_dim_product"])
    assert _did(done)[0] == {"gold_dim_product"}
    put(dim_campaign=[])
    _, done = incremental.refresh(lake(), store, ["gold_dim_product"])
    assert _did(done)[0] == set()


def test_a_refresh_that_fails_keeps_the_last_snapshot(landed, store):
    lake, put = landed
    before, _ = incremental.refresh(lake(), store, NAMES)
    put(dim_brand=[{"Brand_ID": 1, "Brand_Name": "y"}])

    def broken(name, df):
        return df.withColumn("brand_name", F.raise_error(F.lit("no"))) if name == "silver_dim_brand" else df

    with pytest.raises(PySparkException):
        incremental.refresh(lake(), store, NAMES, prepare=broken)
    assert store.snapshot().tables == before.tables
    _, done = incremental.refresh(lake(), store, NAMES)
    assert _did(done)[0] == {"silver_dim_brand", "gold_dim_product"}


def test_rows_from_no_file_count_as_changed(tiny, store):
    lake = tiny(dim_brand=[{"Brand_ID": 1, "Brand_Name": "x"}])
    for rebuilt in ({"silver_dim_brand"}, {"silver_dim_brand"}):
        _, done = incremental.refresh(lake, store, ["silver_dim_brand"])
        assert _did(done)[0] == rebuilt
    _, done = incremental.refresh(lake, store, ["silver_dim_brand"], raw_version=lambda table: "1")
    _, done = incremental.refresh(lake, store, ["silver_dim_brand"], raw_version=lambda table: "1")
    assert _did(done)[0] == set()


def test_a_lakehouse_over_one_snapshot(landed, store):
    lake, put = landed
    first, _ = incremental.refresh(lake(), store, NAMES)
    put(dim_brand=[{"Brand_ID": 1, "Brand_Name": "y"}])
    incremental.refresh(lake(), store, NAMES)
    assert incremental.opened(lake(), first).table("silver_dim_brand").first().brand_name == "x"
    assert incremental.opened(lake(), store.snapshot()).table("silver_dim_brand").first().brand_name == "y"
