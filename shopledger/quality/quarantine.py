"""The rows that break checks, kept as one set of tables: every row read once, tagged with all the checks it breaks.

A table's rows are read in one pass. Checks on keys (unique, referential) first find the keys at fault, from the key
column alone and added up per key; the rows then meet only those, without a shuffle unless the keys at fault are very
many. The rows are stored under the checks they break, and the tables of a run are published together.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.lakehouse import Lakehouse
from shopledger.quality.checks import Check, Referential, RowRule, Unique
from shopledger.sources.snapshots import Snapshot, SnapshotStore
from shopledger.sources.writer import point_to, write_table

BROKEN = "broken_checks"
CHECK = "check"
#: A row that breaks several checks is stored under each of them.
FOLDER = "_test_failures"
#: Keys at fault that are sent to every task, at most; each has a handful of names beside it. More of them are joined by
#: a shuffle of both sides.
BROADCAST_KEYS = 100_000


def slug(check: Check) -> str:
    return re.sub(r"[^0-9a-z]+", "_", check.name.lower()).strip("_")


def _faulty_keys(lake: Lakehouse, check: Unique | Referential) -> DataFrame:
    """(key) of the values of the check's column that are at fault."""
    if isinstance(check, Unique):
        return check.failing_rows(lake).select(F.col(check.column).alias("__key"))
    keys = lake.table(check.table).select(F.col(check.column).alias("__key")).filter("__key IS NOT NULL").distinct()
    return keys.join(lake.table(check.parent).select(F.col(check.parent_column).alias("__key")), "__key", "left_anti")


def tagged(lake: Lakehouse, table: str, checks: Iterable[Check]) -> DataFrame:
    """The rows of `table` that break any of its `checks`, with the sorted names of those they break. The keys at fault
    are stored and counted now, the rows are read when the result is.

    Of a key that occurs more than once all rows are at fault, of a missing parent all rows that name it; NULL is one
    key among others, and no link.
    """
    checks = [c for c in checks if c.table == table]
    rows = lake.table(table)
    broken = [F.when(c.violation(), F.lit(c.name)) for c in checks if isinstance(c, RowRule)]
    by_column: dict[str, list[DataFrame]] = {}
    for check in checks:
        if not isinstance(check, RowRule):
            keys = _faulty_keys(lake, check).withColumn("__name", F.lit(check.name))
            by_column.setdefault(check.column, []).append(keys)
    names = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    found = rows.withColumn(BROKEN, names)
    for column, parts in by_column.items():
        faulty = reduce(DataFrame.unionByName, parts).groupBy("__key").agg(F.collect_list("__name").alias("__names"))
        keys = write_table(faulty, f"{lake.root}/{FOLDER}/_keys/{table}.{column}")
        if keys.count() <= BROADCAST_KEYS:
            keys = F.broadcast(keys)
        found = found.join(keys, F.col(column).eqNullSafe(F.col("__key")), "left")
        more = F.coalesce("__names", F.array().cast("array<string>"))
        found = found.withColumn(BROKEN, F.concat(BROKEN, more)).drop("__key", "__names")
    return found.filter(F.size(BROKEN) > 0).withColumn(BROKEN, F.array_sort(BROKEN))


def filed(rows: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """Tagged rows, once for every check they break, whose short name is the column `check`."""
    short = F.create_map(*[F.lit(x) for c in checks for x in (c.name, slug(c))])
    return rows.withColumn(CHECK, F.explode(BROKEN)).withColumn(CHECK, short[F.col(CHECK)])


def store_of(lake: Lakehouse) -> SnapshotStore:
    return SnapshotStore(lake.spark, f"{lake.root}/{FOLDER}/_rows")


def quarantine(lake: Lakehouse, checks: Iterable[Check], store: SnapshotStore | None = None) -> Snapshot:
    """Store the rows that break `checks`, one table for each table checked, in place of those of the run before.

    Each table is written partitioned by check. Rows of a check that very many break are spread over files of the
    session's advisory size. What a failed run has written is removed, and the last run's rows stay.
    """
    checks = list(checks)
    store = store or store_of(lake)
    with store.begin() as build:
        for table in dict.fromkeys(c.table for c in checks):
            own = [c for c in checks if c.table == table]
            build.write(table, filed(tagged(lake, table, own), own), cluster_by=[CHECK], partition_by=[CHECK])
        for table in set(build.tables) - {c.table for c in checks}:
            build.remove(table)
    store.expire(keep=2)
    return build.published


def failing_rows(kept: Snapshot, check: Check) -> DataFrame:
    """The stored rows of one check, with all the checks they break; only its files are read."""
    return kept.table(check.table).filter(F.col(CHECK) == slug(check)).drop(CHECK)


def summary(kept: Snapshot) -> DataFrame:
    """(table_name, check, rows, also_broken): stored rows of every check that any row breaks, and how many of them
    break others too."""
    parts = [
        kept.table(name).select(F.lit(name).alias("table_name"), CHECK, (F.size(BROKEN) > 1).alias("several"))
        for name in kept.tables
    ]
    rows, several = F.count(F.lit(1)).alias("rows"), F.count_if("several").alias("also_broken")
    return reduce(DataFrame.unionByName, parts).groupBy("table_name", CHECK).agg(rows, several)


def link(lake: Lakehouse, kept: Snapshot, checks: Iterable[Check]) -> None:
    """Make ``read_table`` of a check's own folder read its stored rows, without writing them again."""
    for check in checks:
        path = f"{lake.root}/{FOLDER}/{slug(check)}"
        if not point_to(lake.spark, path, f"{kept.path(check.table)}/{CHECK}={slug(check)}"):
            none = kept.table(check.table).drop(CHECK).schema
            write_table(lake.spark.createDataFrame([], none), path)
