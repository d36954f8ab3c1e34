"""Intermediate tables in the folder that all executors share, and Arrow batches of bounded size."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.session import app_dir

#: Rows in an Arrow batch of texts; Python then holds so many texts at a time, whole.
BATCH_ROWS = 256


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{app_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """`df` as a stored Parquet table of a new name, so that a lost executor costs no more than reading it again."""
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches small for this session unless it sets a smaller size itself."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


def bounded_sample(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """About `rows` rows, and never more than twice as many, chosen by a hash of `key`; the same ones every time as
    long as there are not many more than expected. For fitting models only."""
    total = df.count()
    if total <= rows:
        return df
    share = int(rows / total * (1 << 31))
    return df.filter(F.pmod(F.xxhash64(*key), F.lit(1 << 31)) < share).limit(2 * rows)
