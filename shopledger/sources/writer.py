"""Writing tables: full rebuilds that keep the last good version, clustered or bucketed where that helps the readers.

A table's folder holds one folder per version and a small file that names the current one. A rebuild writes a new
version and switches the file only after every row is written, so a rebuild that fails leaves the table as it was.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.session import shuffles_released

CURRENT = "_current"
#: How the files of stored tables are compressed: to seven tenths of Spark's default for the facts.
COMPRESSION = "zstd"
#: Finds the repeats of wide ids at some twentieth less bytes than the default of 3, and takes hardly longer; from 10 on it would.
LEVEL = 9


def file_options(schema: T.StructType) -> dict[str, str]:
    """How the files of a stored table are written. Ids are written as they are: where equal ones lie together that
    compresses better than a dictionary of nearly all of them."""
    ids = [f.name for f in schema.fields if f.name.endswith("_id") and isinstance(f.dataType, T.LongType)]
    plain = {f"parquet.enable.dictionary#{name}": "false" for name in ids}
    return {"compression": COMPRESSION, "parquet.compression.codec.zstd.level": str(LEVEL), **plain}


#: Tables of fewer rows a bucket gain nothing by buckets; of more, one task has too much to sort.
BUCKET_ROWS, BUCKET_MOST = 50_000, 2_000_000
#: A bucket stands out from so many times the mean on, as for Spark's splitting of skewed partitions.
SKEWED = 5


@dataclass(frozen=True)
class Buckets:
    """Rows by the hash of ``key`` in ``n`` buckets. Tables bucketed alike join and group by the key without a shuffle."""

    key: str
    n: int

    @classmethod
    def for_keys(cls, key: str, *columns: DataFrame) -> "Buckets | None":
        """Buckets for tables whose keys are those of one of the ``columns``; their largest has as many rows as tables have.

        There are as many as the session's shuffles have partitions, or a multiple of that, so that rows that a shuffle
        by the key laid out are written as one file a bucket. None where that is too many for so few rows, or one
        bucket would hold much of them: rows of such a key, or without one, are better left to shuffles, which can be
        split.
        """
        shuffled = int(columns[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
        most = max(column.count() for column in columns)
        if most < shuffled * BUCKET_ROWS:
            return None
        n = shuffled * max(1, math.ceil(most / (shuffled * BUCKET_MOST)))
        for column in columns:
            counted = column.groupBy(F.pmod(F.hash(*column.columns), F.lit(n)).alias("bucket")).count()
            largest, total = counted.agg(F.max("count"), F.sum("count")).first()
            if total and largest > SKEWED * max(total / n, BUCKET_ROWS):
                return None
        return cls(key, n)

    @contextmanager
    def _entered(self, spark: SparkSession, schema: T.StructType, version: str) -> Iterator[str]:
        """The folder's name in the catalogue for a moment, as Spark knows buckets of catalogue tables only."""
        name = f"bucketed_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        options = ", ".join(f"'{k}' '{v}'" for k, v in file_options(schema).items())
        # the catalogue has its own idea of what a path without a file system is relative to
        location = Folder(spark, version).qualified().replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS ({options})"
            f" CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.n} BUCKETS LOCATION '{location}'"
        )
        try:
            yield name
        finally:
            # a table with a path of its own: its files stay
            spark.sql(f"DROP TABLE {name}")

    def write(self, df: DataFrame, version: str) -> None:
        """Write rows to the new folder ``version``. Each task writes a file for each bucket that it has rows of, so
        give rows laid out by the key."""
        with self._entered(df.sparkSession, df.schema, version) as name:
            df.write.insertInto(name)

    def open(self, spark: SparkSession, schema: T.StructType, version: str) -> DataFrame:
        with self._entered(spark, schema, version) as name:
            return spark.table(name)


class Folder:
    """A folder on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        self._gateway = spark.sparkContext._gateway
        self.path = self._hadoop.Path(path)
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self.path.getFileSystem(self._conf)

    def qualified(self) -> str:
        return self._fs.makeQualified(self.path).toString()

    def _at(self, name: str):
        return self._hadoop.Path(self.path, name)

    def read(self, name: str) -> str | None:
        if not self._fs.exists(self._at(name)):
            return None
        stream = self._fs.open(self._at(name))
        try:
            return stream.readUTF()
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write beside the old file and rename over it, which is one step on a distributed file system."""
        fresh = self._at(f"{name}.{uuid.uuid4().hex}")
        stream = self._fs.create(fresh, True)
        try:
            stream.writeUTF(text)
        finally:
            stream.close()
        overwrite = self._gateway.new_array(self._gateway.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = self._gateway.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = self._hadoop.FileContext.getFileContext(self._fs.getUri(), self._conf)
        context.rename(self._fs.makeQualified(fresh), self._fs.makeQualified(self._at(name)), overwrite)

    def publish(self, name: str, text: str) -> bool:
        """Write a new file in one step; False, and no change, if there is one of that name."""
        self._fs.mkdirs(self.path)
        fresh = self._at(f".{name}.{uuid.uuid4().hex}")
        stream = self._fs.create(fresh, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._hadoop.FileContext.getFileContext(self._fs.getUri(), self._conf)
        plain = self._gateway.new_array(self._gateway.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._fs.makeQualified(fresh), self._fs.makeQualified(self._at(name)), plain)
        except Py4JJavaError as error:
            self._fs.delete(fresh, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def text(self, name: str) -> str:
        """The whole of a file that `publish` wrote."""
        stream = self._fs.open(self._at(name))
        try:
            return self._gateway.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def exists(self) -> bool:
        return self._fs.exists(self.path)

    def files(self) -> list[str]:
        if not self._fs.exists(self.path):
            return []
        return [f.getPath().getName() for f in self._fs.listStatus(self.path) if f.isFile()]

    def versions(self, older_than_s: float | None = None) -> list[str]:
        """Names of the folders in it; only of those not changed for so long, if that is given."""
        if not self._fs.exists(self.path):
            return []
        folders = [f for f in self._fs.listStatus(self.path) if f.isDirectory()]
        if older_than_s is not None:
            limit = (time.time() - older_than_s) * 1000
            folders = [f for f in folders if f.getModificationTime() <= limit]
        return [f.getPath().getName() for f in folders]

    def drop(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the table's current version, or None before the first."""
    name = Folder(spark, path).read(CURRENT)
    if not name:
        return None
    return name if "/" in name else f"{path}/{name}"


def point_to(spark: SparkSession, path: str, folder: str) -> bool:
    """Let the table at ``path`` be the Parquet files of ``folder``; False, and no change, if there is no such folder."""
    if not Folder(spark, folder).exists():
        return False
    Folder(spark, path).replace(CURRENT, folder)
    return True


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``write_table`` last finished at ``path``."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no finished table at {path}")
    return spark.read.parquet(version)


def write_table(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str] = (),
    table: str | None = None,
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    partition_by: Sequence[str] = (),
    finish: Callable[[DataFrame], DataFrame] | None = None,
    sort_by: Sequence[str] = (),
    laid_out: Buckets | None = None,
) -> DataFrame:
    """Replace the table at ``path`` by ``df`` and return a reader of it.

    ``cluster_by`` brings rows with equal values into the same file, in files of the session's
    advisory size; a value too large for one file is spread over several, so no task writes an
    outsized share.

    With ``table`` it is also entered in the session catalogue, which ``bucket_by`` needs.  Tables
    bucketed alike on a key join and group on it without a shuffle, but one task reads a whole
    bucket: use it for keys without a dominant value.

    ``laid_out`` buckets rows that their plan has laid out by a key, for the reader that is returned and without a
    name in the catalogue.

    ``sort_by`` orders the rows of each task, which makes files smaller where equal values come together.

    ``finish`` is applied to the rows as they are written, above any exchange; what it observes is counted by the
    tasks that write, once each, also where a task before them has to run again.

    ``df`` may read the table itself: its current version stays until the next rebuild.
    """
    spark = df.sparkSession
    schema = df.schema
    if bucket_by and not table:
        raise ValueError("a bucketed table needs a table name")
    if cluster_by:
        df = df.hint("rebalance", *cluster_by)
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    if finish:
        df = finish(df)
    writer = df.write.format("parquet").options(**file_options(schema))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    folder = Folder(spark, path)
    before = folder.read(CURRENT)
    name = f"version-{uuid.uuid4().hex}"
    version = f"{path}/{name}"
    with shuffles_released(spark):
        if laid_out:
            laid_out.write(df, version)
        elif bucket_by:
            _enter_bucketed(spark, writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by), version, table)
        else:
            writer.save(version)
    folder.replace(CURRENT, name)
    if table and not bucket_by:
        enter(spark, version, table)
    # readers of the version just replaced may still be at work; those before it are done with
    for old in folder.versions():
        if old.startswith("version-") and old not in (name, before):
            folder.drop(old)
    if laid_out:
        return laid_out.open(spark, schema, version)
    return spark.table(table) if bucket_by else spark.read.schema(schema).parquet(version)


def enter(spark: SparkSession, version: str, table: str) -> None:
    """Name the Parquet folder ``version`` as ``table`` in the session catalogue, in place of what had that name."""
    fresh = f"{table}__{uuid.uuid4().hex[:8]}"
    spark.catalog.createTable(fresh, path=version, source="parquet")
    _rename_over(spark, fresh, table)


def _enter_bucketed(spark: SparkSession, writer, version: str, table: str) -> None:
    fresh = f"{table}__{uuid.uuid4().hex[:8]}"
    writer.option("path", version).saveAsTable(fresh)
    _rename_over(spark, fresh, table)


def _rename_over(spark: SparkSession, fresh: str, table: str) -> None:
    # tables with a path of their own: dropping the old entry leaves its files
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
