"""Reading raw Parquet: load, header clean-up, rescue of misfits, row-count manifest."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESCUED = "_rescued_data"


def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file, folder of part files, or glob, with the columns of all the files.

    A column that some files lack is NULL in their rows. Learning of all columns means that Spark reads every file's
    footer once, in parallel; a landing folder of very many files is better read with a declared schema.
    """
    return spark.read.option("mergeSchema", "true").parquet(path)


def snake_case(header: str) -> str:
    return re.sub(r"[^0-9a-z]+", "_", header.strip().lower()).strip("_")


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])


def rescue(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Fit ``df`` to ``schema`` without losing anything.

    Declared columns are cast where the value survives it, and NULL where not: a fraction does not become a whole
    number, nor a moment a day.  Values that don't fit, and all columns that were not declared, go as text into one
    JSON object in ``_rescued_data``, which is NULL for a row that fits.
    """
    given = dict(df.dtypes)
    fitted = {
        name: _if_kept(F.col(f"`{name}`"), given[name], kind) if name in given else F.lit(None).cast(kind)
        for name, kind in schema.items()
    }
    misfits = [
        F.when(fitted[name].isNull(), F.col(name).cast("string")).alias(name)
        for name in schema
        if name in df.columns
    ] + [F.col(c).cast("string").alias(c) for c in df.columns if c not in schema]
    text = F.to_json(F.struct(*misfits)) if misfits else F.lit(None).cast("string")
    return df.select(
        *[value.alias(name) for name, value in fitted.items()],
        F.when(text != "{}", text).alias(RESCUED),
    )


# For text: the widest type of the target's kind, in which the two values are compared.
_WIDEST = {"date": "timestamp_ntz", "decimal": "decimal(38,18)"} | dict.fromkeys(
    ("tinyint", "smallint", "int", "bigint"), "decimal(38,18)"
)


def _if_kept(value: Column, given: str, kind: str) -> Column:
    """``value`` as ``kind``, or NULL where that would change it."""
    cast = value.try_cast(kind)
    wide = given if given != "string" else _WIDEST.get(kind.partition("(")[0])
    if given == kind or wide is None:
        return cast
    # a value that even the widest type can't hold is left to the cast alone
    before, after = value.try_cast(wide), cast.try_cast(wide)
    return F.when(before.isNull() | before.eqNullSafe(after), cast)


class ParquetLanding:
    """Raw tables that lie as ``<root>/<table>.parquet`` (each a file or a folder).

    With ``declared`` (table -> columns and types) every table is fitted to its declaration, and what
    does not fit is kept in ``_rescued_data``.
    """

    def __init__(
        self, spark: SparkSession, root: str, declared: Mapping[str, Mapping[str, str]] | None = None
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.declared = declared or {}

    def __call__(self, table: str) -> DataFrame:
        loaded = load_parquet(self.spark, f"{self.root}/{table}.parquet")
        return rescue(loaded, self.declared[table]) if table in self.declared else loaded


def row_counts(
    table: Callable[[str], DataFrame],
    names: Iterable[str],
    name_column: str = "table_name",
    count_column: str = "rows",
) -> DataFrame:
    """One row per named table with its number of rows."""
    counts = [
        table(name).agg(F.count(F.lit(1)).alias(count_column)).select(F.lit(name).alias(name_column), count_column)
        for name in names
    ]
    manifest = counts[0]
    for part in counts[1:]:
        manifest = manifest.unionByName(part)
    return manifest
