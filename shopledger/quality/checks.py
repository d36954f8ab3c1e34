"""Checks that count offending rows (0 = pass), a report, a guard, and the offending rows themselves.

A condition that is NULL does not offend: a missing foreign key or value passes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.lakehouse import Lakehouse
from shopledger.sources.writer import write_table

# Status marks and messages.
PASS = "✅ PASS"
FAIL = "❌ FAIL"
ALL_PASSED = "All data quality checks passed"
FAILED = "Data quality FAILED for %d check(s); total offending rows = %d"


@dataclass(frozen=True)
class RowRule:
    """A row offends where ``violation`` is true."""

    name: str
    table: str
    violation: Callable[[], Column]

    def failing_rows(self, lake: Lakehouse) -> DataFrame:
        return lake.table(self.table).filter(self.violation())


def not_null(name: str, table: str, column: str) -> RowRule:
    return RowRule(name, table, lambda: F.col(column).isNull())


def accepted_values(
    name: str, table: str, column: str, values: Sequence[str], ignore_case: bool = False
) -> RowRule:
    def violation() -> Column:
        value = F.lower(column) if ignore_case else F.col(column)
        return ~value.isin(list(values))

    return RowRule(name, table, violation)


@dataclass(frozen=True)
class Unique:
    """Offenders are the keys that occur more than once, each with its number of rows."""

    name: str
    table: str
    column: str

    def failing_rows(self, lake: Lakehouse) -> DataFrame:
        per_key = lake.table(self.table).groupBy(self.column).agg(F.count(F.lit(1)).alias("n_rows"))
        return per_key.filter(F.col("n_rows") > 1)

    def count(self, lake: Lakehouse) -> DataFrame:
        return self.failing_rows(lake).agg(F.count(F.lit(1)).alias("failing_rows"))


@dataclass(frozen=True)
class Referential:
    """Offenders are rows whose key is set but missing from the parent table."""

    name: str
    table: str
    column: str
    parent: str
    parent_column: str

    def _parent_keys(self, lake: Lakehouse) -> DataFrame:
        return lake.table(self.parent).select(F.col(self.parent_column).alias(self.column))

    def failing_rows(self, lake: Lakehouse) -> DataFrame:
        rows = lake.table(self.table).filter(F.col(self.column).isNotNull())
        return rows.join(self._parent_keys(lake), self.column, "left_anti")

    def count(self, lake: Lakehouse) -> DataFrame:
        # Rows are counted per key first, so the join sees each key once however many rows carry it.
        rows = lake.table(self.table).filter(F.col(self.column).isNotNull())
        per_key = rows.groupBy(self.column).agg(F.count(F.lit(1)).alias("n_rows"))
        orphans = per_key.join(self._parent_keys(lake), self.column, "left_anti")
        return orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("failing_rows"))


Check = RowRule | Unique | Referential


def check_results(lake: Lakehouse, checks: Iterable[Check]) -> DataFrame:
    """(check_name, failing_rows); all row rules of one table share one pass over it."""
    row_rules: dict[str, list[RowRule]] = {}
    parts = []
    for check in checks:
        if isinstance(check, RowRule):
            row_rules.setdefault(check.table, []).append(check)
        else:
            parts.append(check.count(lake).select(F.lit(check.name).alias("check_name"), "failing_rows"))
    for table, rules in row_rules.items():
        counted = lake.table(table).agg(*[F.count_if(r.violation()).alias(f"c{i}") for i, r in enumerate(rules)])
        rows = [
            F.struct(F.lit(r.name).alias("check_name"), F.col(f"c{i}").alias("failing_rows"))
            for i, r in enumerate(rules)
        ]
        parts.append(counted.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


def report(results: DataFrame) -> DataFrame:
    """Results with a status, worst first."""
    status = F.when(F.col("failing_rows") == 0, PASS).otherwise(FAIL)
    return results.withColumn("status", status).orderBy(F.desc("failing_rows"), "check_name")


def _totals(results: DataFrame) -> DataFrame:
    """(offending, complaint): rows that offend any check, and what there is to say about them."""
    totals = results.agg(
        F.sum("failing_rows").alias("offending"), F.count_if(F.col("failing_rows") > 0).alias("failed")
    )
    return totals.select("offending", F.format_string(FAILED, "failed", "offending").alias("complaint"))


def guard(results: DataFrame) -> DataFrame:
    """One row saying that all passed; reading it fails the job if anything offends."""
    verdict = F.when(F.col("offending") == 0, ALL_PASSED).otherwise(F.raise_error(F.col("complaint")))
    return _totals(results).select(verdict.alias("result"))


def complaint(results: DataFrame) -> str | None:
    """What ``guard`` would say, without failing a job; None if nothing offends."""
    row = _totals(results).first()
    return row.complaint if row.offending else None


def store_failing_rows(lake: Lakehouse, check: Check) -> DataFrame:
    """Keep the offending rows as a table under ``_test_failures``, replaced on every run."""
    slug = re.sub(r"[^0-9a-z]+", "_", check.name.lower()).strip("_")
    return write_table(check.failing_rows(lake), f"{lake.root}/_test_failures/{slug}")


def _day_outside_month() -> Column:
    return (F.col("day") < 1) | (F.col("day") > F.dayofmonth(F.last_day("date")))


def _price_not_above_cost() -> Column:
    cost, price = F.col("unit_cost"), F.col("unit_price")
    return (cost >= price) | cost.isNull() | price.isNull()


def _campaign_from_elsewhere() -> Column:
    return F.col("campaign_id").isNotNull() & (F.col("traffic_source") != "Campaign")


def _purchase_without_view() -> Column:
    # Whether the cart was used does not matter, as long as it is known.
    return F.col("purchased_flag") & ~F.col("product_page_visited_flag") & F.col("added_to_cart_flag").isNotNull()


# The names of the checks and the accepted values.
SALES_CHANNELS = ["web", "mobile", "store"]
STATUSES = ["Completed", "Returned"]
PAYMENT_TYPES = ["Credit Card", "Debit Card", "Cash", "Gift Card", "Apple Pay", "Google Pay", "PayPal"]

NOT_NULL_CHECKS = [
    not_null("silver_fact_transaction.transaction_id not null", "silver_fact_transaction", "transaction_id"),
]
UNIQUE_CHECKS = [
    Unique("silver_fact_transaction.transaction_id unique", "silver_fact_transaction", "transaction_id"),
    Unique("silver_fact_sale.sale_id unique", "silver_fact_sale", "sale_id"),
    Unique("silver_fact_clickstream.session_id unique", "silver_fact_clickstream", "session_id"),
    Unique("silver_dim_customer.customer_id unique", "silver_dim_customer", "customer_id"),
    Unique("silver_dim_product.product_id unique", "silver_dim_product", "product_id"),
]
REFERENTIAL_CHECKS = [
    Referential(
        "fact_transaction.customer_id → dim_customer",
        "silver_fact_transaction",
        "customer_id",
        "silver_dim_customer",
        "customer_id",
    ),
    Referential(
        "fact_transaction.store_id → dim_store",
        "silver_fact_transaction",
        "store_id",
        "silver_dim_store",
        "store_id",
    ),
    Referential(
        "fact_transaction.transaction_date_id → dim_date",
        "silver_fact_transaction",
        "transaction_date_id",
        "silver_dim_date",
        "date_id",
    ),
    Referential(
        "fact_sale.product_id → dim_product",
        "silver_fact_sale",
        "product_id",
        "silver_dim_product",
        "product_id",
    ),
]
ACCEPTED_VALUE_CHECKS = [
    accepted_values(
        "fact_transaction.sales_channel in (web,mobile,store)",
        "silver_fact_transaction",
        "sales_channel",
        SALES_CHANNELS,
        ignore_case=True,
    ),
    accepted_values(
        "fact_transaction.transaction_status in (Completed,Returned)",
        "silver_fact_transaction",
        "transaction_status",
        STATUSES,
    ),
    accepted_values(
        "fact_transaction.payment_type accepted values",
        "silver_fact_transaction",
        "payment_type",
        PAYMENT_TYPES,
    ),
]
ROW_RULE_CHECKS = [
    RowRule("dim_date: day within 1..days_in_month", "silver_dim_date", _day_outside_month),
    RowRule("dim_product: unit_cost < unit_price and not null", "silver_dim_product", _price_not_above_cost),
    RowRule(
        "clickstream: campaign_id set ⇒ traffic_source = Campaign",
        "silver_fact_clickstream",
        _campaign_from_elsewhere,
    ),
    RowRule(
        "clickstream: funnel order (no purchase without cart/view)",
        "silver_fact_clickstream",
        _purchase_without_view,
    ),
    RowRule(
        "gold_fact_transaction: transaction_total >= 0",
        "gold_fact_transaction",
        lambda: F.col("transaction_total") < 0,
    ),
    RowRule(
        "inventory: no negative closing stock", "silver_fact_inventory", lambda: F.col("closing_stock") < 0
    ),
]
ALL_CHECKS: list[Check] = [
    *NOT_NULL_CHECKS,
    *UNIQUE_CHECKS,
    *REFERENTIAL_CHECKS,
    *ACCEPTED_VALUE_CHECKS,
    *ROW_RULE_CHECKS,
]


def constraint_checks() -> list[Check]:
    """The star schema's keys as checks: dimension keys set and unique, fact keys known."""
    keys = {
        "gold_dim_date": "date_id",
        "gold_dim_customer": "customer_id",
        "gold_dim_product": "product_id",
        "gold_dim_store": "store_id",
        "gold_dim_campaign": "campaign_id",
        "gold_dim_promotion": "promo_id",
    }
    links = [
        ("gold_fact_sale", "product_id", "gold_dim_product"),
        ("gold_fact_sale", "customer_id", "gold_dim_customer"),
        ("gold_fact_sale", "store_id", "gold_dim_store"),
        ("gold_fact_sale", "transaction_date_id", "gold_dim_date"),
        ("gold_fact_transaction", "customer_id", "gold_dim_customer"),
        ("gold_fact_transaction", "store_id", "gold_dim_store"),
        ("gold_fact_transaction", "transaction_date_id", "gold_dim_date"),
        ("gold_fact_inventory", "product_id", "gold_dim_product"),
        ("gold_fact_inventory", "store_id", "gold_dim_store"),
    ]
    return [
        *[not_null(f"{table}.{key} not null", table, key) for table, key in keys.items()],
        *[Unique(f"{table}.{key} unique", table, key) for table, key in keys.items()],
        *[Referential(f"{t}.{column} → {parent}", t, column, parent, keys[parent]) for t, column, parent in links],
    ]
