"""Expectations declared on tables: ``fail`` stops the run, ``warn`` records and keeps the row.

A condition that is NULL counts as a violation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shopledger.lakehouse import Lakehouse


@dataclass(frozen=True)
class Expectation:
    table: str
    name: str
    condition: str
    action: str = "fail"

    def violated(self) -> Column:
        return ~F.coalesce(F.expr(self.condition), F.lit(False))


def _key(table: str, column: str) -> Expectation:
    return Expectation(table, f"valid_{column}", f"{column} IS NOT NULL")


def _warn(table: str, name: str, condition: str) -> Expectation:
    return Expectation(table, name, condition, "warn")


# The declared expectations.
DECLARED = [
    _key("silver_dim_brand", "brand_id"),
    _key("silver_dim_category", "category_id"),
    _key("silver_dim_subcategory", "subcategory_id"),
    _key("silver_dim_product", "product_id"),
    _key("silver_dim_customer", "customer_id"),
    _key("silver_dim_location", "location_id"),
    _key("silver_dim_store", "store_id"),
    _key("silver_dim_campaign", "campaign_id"),
    _key("silver_dim_promotion", "promo_id"),
    _key("silver_dim_date", "date_id"),
    _key("silver_fact_sale", "sale_id"),
    _key("silver_fact_transaction", "transaction_id"),
    _key("silver_fact_clickstream", "session_id"),
    _key("silver_fact_inventory", "inventory_id"),
    _key("gold_dim_date", "date_id"),
    _key("gold_dim_product", "product_id"),
    _key("gold_dim_customer", "customer_id"),
    _key("gold_dim_store", "store_id"),
    _key("gold_dim_campaign", "campaign_id"),
    _key("gold_dim_promotion", "promo_id"),
    _key("gold_fact_transaction", "transaction_id"),
    _key("gold_fact_inventory", "inventory_id"),
    _key("gold_fact_sale", "sale_id"),
    _key("gold_fact_clickstream", "session_id"),
    _warn("silver_dim_product", "valid_unit_cost", "unit_cost >= 0"),
    _warn("silver_dim_product", "valid_unit_price", "unit_price >= 0"),
    _warn("silver_dim_customer", "valid_email", "email_address IS NOT NULL AND email_address LIKE '%@%'"),
    _warn("silver_fact_sale", "valid_quantity", "quantity > 0"),
    _warn("silver_fact_sale", "valid_line_total", "line_total >= 0"),
    _warn("silver_fact_transaction", "valid_transaction_total", "transaction_total >= 0"),
    _warn("silver_fact_inventory", "valid_closing_stock", "closing_stock >= 0"),
    _warn("gold_fact_sale", "valid_quantity", "quantity > 0"),
    _warn("gold_fact_sale", "valid_line_total", "line_total >= 0"),
]


# The alternative family declares them. The standard tables, which are cleaned, are held to the same.
EXPECTATIONS = [*[replace(e, table=f"{e.table}_alt") for e in DECLARED], *DECLARED]


def expectations_on(table: str, action: str | None = None) -> list[Expectation]:
    return [e for e in EXPECTATIONS if e.table == table and action in (None, e.action)]


def enforce(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """The same rows; reading a row that breaks a ``fail`` expectation stops the job.

    The test sits in a filter, which the optimizer keeps even where its column is not read.
    """
    for e in expectations:
        if e.action == "fail":
            complaint = F.lit(f"expectation {e.name} failed on {e.table}: {e.condition}")
            df = df.filter(F.when(~e.violated(), True).otherwise(F.raise_error(complaint).cast("boolean")))
    return df


def observe(df: DataFrame, expectations: Sequence[Expectation]) -> tuple[DataFrame, Observation | None]:
    """Count ``warn`` violations while the rows pass by; read them after the write."""
    warnings = [e for e in expectations if e.action == "warn"]
    if not warnings:
        return df, None
    seen = Observation()
    counts = [F.count_if(e.violated()).alias(e.name) for e in warnings]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


class Watch:
    """Counts what expectations find in the rows that a build writes, without reading them again.

    Give ``attach`` to the build as what prepares the rows: it counts all of a table's expectations, of both actions,
    and unless told otherwise stops the build at a row that breaks a ``fail`` one.
    """

    def __init__(self, expectations: Sequence[Expectation] = tuple(EXPECTATIONS), stop: bool = True):
        self._stop = stop
        self._by_table: dict[str, list[Expectation]] = {}
        for e in expectations:
            self._by_table.setdefault(e.table, []).append(e)
        self._seen: dict[str, Observation] = {}

    def attach(self, table: str, df: DataFrame) -> DataFrame:
        declared = self._by_table.get(table)
        if not declared:
            return df
        seen = self._seen[table] = Observation()
        counts = [F.count_if(e.violated()).alias(f"c{i}") for i, e in enumerate(declared)]
        # counted below the filter that stops the build: a row is counted also where it is the one that stops it
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
        return enforce(counted, declared) if self._stop else counted

    def counts(self) -> list[tuple[str, str, str, int, int]]:
        """(table, expectation, action, rows, violations) of the tables written so far."""
        found = []
        for table, seen in self._seen.items():
            got = seen.get
            for i, e in enumerate(self._by_table[table]):
                found.append((table, e.name, e.action, got["rows"], got[f"c{i}"]))
        return found


def violation_report(lake: Lakehouse, expectations: Sequence[Expectation]) -> DataFrame:
    """One row per expectation with rows and violations, one pass per table."""
    by_table: dict[str, list[Expectation]] = {}
    for e in expectations:
        by_table.setdefault(e.table, []).append(e)
    parts = []
    for table, group in by_table.items():
        counted = lake.table(table).agg(
            F.count(F.lit(1)).alias("n"), *[F.count_if(e.violated()).alias(f"c{i}") for i, e in enumerate(group)]
        )
        rows = [
            F.struct(
                F.lit(e.table).alias("table_name"),
                F.lit(e.name).alias("expectation"),
                F.lit(e.action).alias("action"),
                F.col("n").alias("rows"),
                F.col(f"c{i}").alias("violations"),
            )
            for i, e in enumerate(group)
        ]
        parts.append(counted.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


def enforced_counts(lake: Lakehouse, tables: Sequence[str]) -> DataFrame:
    """Rows per table after its ``fail`` expectations; stops if one is broken."""
    parts = [
        enforce(lake.table(t), expectations_on(t))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(t).alias("table_name"), "rows")
        for t in tables
    ]
    return reduce(DataFrame.unionByName, parts)
