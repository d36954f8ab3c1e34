"""Landing folders whose files differ in schema: files grouped by schema, one scan for each group, nothing lost.

Merging all files' schemas into one breaks where a column has changed its type, and makes every scan look for every
column. Here a job reads the footers, one task for many files, and tells which files are alike. Each group is scanned
with its own schema and fitted to the declared columns; what was added or changed since then is rescued as text in the
rows that have it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.sources.reader import RESCUED, rescue

#: Footers that one task reads, about.
FILES_A_TASK = 200


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the Parquet files of a file, folder or glob. Spark lists them; their content isn't read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return listed.select("path", "length")


def _footer(path: str) -> str:
    """The columns and types of a file, as text that is equal for files alike."""
    if path.startswith("file:"):
        system, inner = pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    else:
        system, inner = pyarrow.fs.FileSystem.from_uri(quote(path, safe=":/@"))
    with system.open_input_file(inner) as file:
        schema = pq.read_schema(file)
    return "; ".join(f"{field.name} {field.type}" for field in schema)


def file_schemas(files: DataFrame) -> DataFrame:
    """(path, columns) from (path, …): what each file's footer says."""
    n = files.count()
    dealt = files.select("path").repartition(max(1, -(-n // FILES_A_TASK)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            found = [pa.array(paths, pa.string()), pa.array([_footer(p) for p in paths], pa.string())]
            yield pa.RecordBatch.from_arrays(found, ["path", "columns"])

    return dealt.mapInArrow(run, "path string, columns string")


def schema_groups(spark: SparkSession, path: str) -> list[list[str]]:
    """The files of a landing folder, those of one schema together; groups and files in order of their names.

    The driver holds the names of the files, as it does for any scan of them.
    """
    grouped = file_schemas(list_files(spark, path)).groupBy("columns").agg(F.sort_array(F.collect_list("path")).alias("files"))
    return sorted(row.files for row in grouped.select("files").collect())


def load_by_schema(spark: SparkSession, path: str, declared: Mapping[str, str]) -> DataFrame:
    """All rows of a landing folder with the declared columns, and what doesn't fit them in ``_rescued_data``.

    A file that lacks a column gives NULL, one that has another type for it is cast where the value survives, and
    columns that aren't declared are rescued. A folder without files has no rows.
    """
    groups = schema_groups(spark, path)
    parts = [rescue(spark.read.parquet(*files), declared) for files in groups]
    if not parts:
        columns = ", ".join(f"`{name}` {kind}" for name, kind in {**declared, RESCUED: "string"}.items())
        return spark.createDataFrame([], columns)
    return reduce(DataFrame.unionByName, parts)


class DriftingLanding:
    """Raw tables that lie as ``<root>/<table>.parquet``, declared, with files of any number of schemas each."""

    def __init__(self, spark: SparkSession, root: str, declared: Mapping[str, Mapping[str, str]]):
        self.spark = spark
        self.root = root.rstrip("/")
        self.declared = declared

    def __call__(self, table: str) -> DataFrame:
        return load_by_schema(self.spark, f"{self.root}/{table}.parquet", self.declared[table])


def load_report(table: Callable[[str], DataFrame], names: Iterable[str]) -> DataFrame:
    """(table_name, rows, rescued_rows, rescued_columns): how much of each declared load didn't fit, and which columns
    it was, sorted and joined by commas. One pass over each table."""
    parts = []
    for name in names:
        misfits = F.json_object_keys(RESCUED)
        per_kind = table(name).groupBy(misfits.alias("columns")).agg(F.count(F.lit(1)).alias("n"))
        # so few rows are left: one for each set of columns that some row has rescued
        parts.append(
            per_kind.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(F.when(F.col("columns").isNotNull(), F.col("n"))), F.lit(0)).alias("rescued_rows"),
                F.array_join(
                    F.array_sort(F.array_distinct(F.flatten(F.collect_list("columns")))), ","
                ).alias("rescued_columns"),
            ).select(F.lit(name).alias("table_name"), "rows", "rescued_rows", "rescued_columns")
        )
    return reduce(DataFrame.unionByName, parts)
