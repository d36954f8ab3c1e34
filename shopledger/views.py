"""Views in the catalogue over the tables of one snapshot, for users who have names and SQL only.

Cleaned tables and dimensions are entered as tables, facts that are copies of cleaned tables become views of them, and
each mart is a view over its stored rows, in its presentation order. Unlike temporary views these stay when the
session ends, as long as the catalogue does, and every session sees them.

The tables are entered under names of their snapshot, and a view is replaced only when all that it reads is there. So
whoever reads a view at any moment reads whole tables of one build; the tables of the build before go last.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession

from shopledger.lakehouse import DATASETS
from shopledger.sources.snapshots import Snapshot

#: Views that show the rows of another dataset, so these are stored once.
COPIES = {
    f"gold_{fact}{family}": f"silver_{fact}{family}"
    for fact in ("fact_transaction", "fact_inventory", "fact_clickstream")
    for family in ("", "_alt")
}


@dataclass(frozen=True)
class Databases:
    """Where names go: views and single tables in the database of their layer, the tables behind views in `rows`."""

    silver: str = "silver"
    gold: str = "gold"
    mart: str = "mart"
    rows: str = "snapshot_rows"

    @classmethod
    def prefixed(cls, prefix: str) -> "Databases":
        return cls(*(f"{prefix}{name}" for name in ("silver", "gold", "mart", "snapshot_rows")))

    def of(self, dataset: str) -> str:
        return getattr(self, DATASETS[dataset].layer)

    def all(self) -> list[str]:
        return [self.silver, self.gold, self.mart, self.rows]


def order_sql(order: Iterable[Column]) -> str:
    """The text of sort columns, such as ``net_revenue DESC NULLS LAST``."""
    return ", ".join(column._jc.toString() for column in order)


def statement(view: str, table: str, columns: Iterable[str], order: str, comment: str) -> str:
    """The text that makes a view: named columns, so that a later table of more columns doesn't change it."""
    listed = ", ".join(f"`{c}`" for c in columns)
    text = f"CREATE OR REPLACE VIEW {view} COMMENT '{comment}' AS SELECT {listed} FROM {table}"
    return f"{text} ORDER BY {order}" if order else text


def create_views(
    spark: SparkSession, snapshot: Snapshot, databases: Databases = Databases(), copies: Mapping[str, str] = COPIES
) -> list[str]:
    """Make a view of every dataset in the snapshot, and of the copies of those; the names made, in order.

    Names that earlier snapshots made and this one lacks are dropped, and so are the tables of other snapshots.
    """
    for database in databases.all():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    own = {name: f"{databases.rows}.{name}__{snapshot.number}" for name in snapshot.tables}
    snapshot.enter(own)
    shown = {name: name for name in snapshot.tables} | {
        copy: source for copy, source in copies.items() if source in own and copy not in own
    }
    made = []
    for name, source in shown.items():
        order = DATASETS[name].order
        text = statement(
            f"{databases.of(name)}.{name}",
            own[source],
            snapshot.table(source).columns,
            order_sql(order()) if order else "",
            f"snapshot {snapshot.number}",
        )
        # an earlier release may have entered a table under this name
        if not _is_view(spark, databases.of(name), name):
            spark.sql(f"DROP TABLE IF EXISTS {databases.of(name)}.{name}")
        spark.sql(text)
        made.append(f"{databases.of(name)}.{name}")
    _drop_others(spark, databases, set(made), set(own.values()))
    return made


def _is_view(spark: SparkSession, database: str, name: str) -> bool:
    return any(r.viewName == name for r in spark.sql(f"SHOW VIEWS IN {database} LIKE '{name}'").collect())


def _drop_others(spark: SparkSession, databases: Databases, views: set[str], tables: set[str]) -> None:
    for database in (databases.silver, databases.gold, databases.mart):
        for row in spark.sql(f"SHOW VIEWS IN {database}").collect():
            if not row.isTemporary and f"{database}.{row.viewName}" not in views:
                spark.sql(f"DROP VIEW {database}.{row.viewName}")
    for row in spark.sql(f"SHOW TABLES IN {databases.rows}").collect():
        if not row.isTemporary and f"{databases.rows}.{row.tableName}" not in tables:
            spark.sql(f"DROP TABLE {databases.rows}.{row.tableName}")


def drop_views(spark: SparkSession, databases: Databases = Databases()) -> None:
    """Drop all that `create_views` made; the rows stay in their files."""
    for database in databases.all():
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
