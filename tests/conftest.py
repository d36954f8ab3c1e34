from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

import shopledger.plans  # noqa: E402, F401
from shopledger import Lakehouse  # noqa: E402
from shopledger.sources.catalog import RAW_TABLES, WIDE_ID  # noqa: E402

SMALL = "/root/testdata/sf0.001"
AS_OF = dt.date(2002, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("shopledger-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def tiny(spark):
    """A lakehouse over literal rows: ``tiny(dim_brand=[{...}], ...)``; unnamed columns are NULL."""

    def build(as_of=AS_OF, **tables):
        def raw(name):
            schema = RAW_TABLES[name]
            rows = [
                tuple(Decimal(row[c]) if kind == WIDE_ID and row.get(c) is not None else row.get(c) for c, kind in schema.items())
                for row in tables.get(name, [])
            ]
            ddl = ", ".join(f"`{c}` {kind}" for c, kind in schema.items())
            return spark.createDataFrame(rows, T._parse_datatype_string(ddl))

        return Lakehouse(spark, raw, as_of)

    return build
