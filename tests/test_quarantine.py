"""Rows that break checks, stored once with all that they break."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shopledger.quality import checks, quarantine
from shopledger.quality.checks import Referential, RowRule, Unique, accepted_values, not_null
from shopledger.sources.writer import read_table

TABLE = "silver_fact_transaction"
UNIQUE = Unique("order unique", TABLE, "transaction_id")
KNOWN = Referential("customer known", TABLE, "customer_id", "silver_dim_customer", "customer_id")
STORE = Referential("store known", TABLE, "store_id", "silver_dim_store", "store_id")
CHANNEL = accepted_values("channel", TABLE, "sales_channel", ["web", "store"])
SET = not_null("order set", TABLE, "transaction_id")
ALL = [UNIQUE, KNOWN, STORE, CHANNEL, SET]


def _orders(*rows):
    return [dict(zip(("transaction_id", "customer_id", "store_id", "sales_channel"), r, strict=True)) for r in rows]


@pytest.fixture
def lake(tiny):
    return tiny(
        fact_transaction=_orders(
            (1, 10, 1, "web"), (1, 10, 1, "fax"), (2, 99, 7, "web"), (3, None, None, None), (None, 10, 1, "web"),
            (None, 99, 1, "x"), (4, 10, 1, "store"),
        ),
        dim_customer=[{"customer_id": 10, "email_address": "a"}, {"customer_id": 10, "email_address": "b"}],
        dim_store=[{"store_id": 1}],
    )


def _rows(df):
    return sorted((tuple(r[c] for c in ("transaction_id", "customer_id", "sales_channel")) for r in df.collect()), key=repr)


def test_rows_carry_all_that_they_break(lake):
    found = {(r.transaction_id, r.customer_id, r.sales_channel): r[quarantine.BROKEN] for r in quarantine.tagged(lake, TABLE, ALL).collect()}
    assert found == {
        (1, 10, "web"): ["order unique"],
        (1, 10, "fax"): ["channel", "order unique"],
        (2, 99, "web"): ["customer known", "store known"],
        (None, 10, "web"): ["order set", "order unique"],
        (None, 99, "x"): ["channel", "customer known", "order set", "order unique"],
    }


def test_stored_rows_are_those_that_fail_each_check(lake):
    kept = quarantine.quarantine(lake, ALL)
    for check in (KNOWN, STORE, CHANNEL, SET):
        assert _rows(quarantine.failing_rows(kept, check)) == _rows(check.failing_rows(lake))
    repeated = {r.transaction_id: r.n_rows for r in UNIQUE.failing_rows(lake).collect()}
    counted = quarantine.failing_rows(kept, UNIQUE).groupBy("transaction_id").count()
    assert {r.transaction_id: r["count"] for r in counted.collect()} == repeated == {1: 2, None: 2}
    shown = {r.check: (r.rows, r.also_broken) for r in quarantine.summary(kept).collect()}
    assert shown == {
        "order_unique": (4, 3), "customer_known": (2, 2), "store_known": (1, 1), "channel": (2, 2), "order_set": (2, 2)
    }


def test_reading_one_check_reads_its_files_alone(lake):
    kept = quarantine.quarantine(lake, ALL)
    plan = quarantine.failing_rows(kept, CHANNEL)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(check" in plan and "= channel)]" in plan
    files = {f.split("/check=")[1].split("/")[0] for f in kept.table(TABLE).inputFiles()}
    assert files == {"order_unique", "customer_known", "store_known", "channel", "order_set"}


def test_the_next_run_replaces_the_rows(lake, tiny):
    quarantine.quarantine(lake, ALL)
    other = tiny(fact_transaction=_orders((5, None, None, "fax")))
    other._root = lake.root
    for _ in range(3):
        kept = quarantine.quarantine(other, [CHANNEL])
    assert _rows(quarantine.failing_rows(kept, CHANNEL)) == [(5, None, "fax")]
    assert quarantine.store_of(other).snapshot().tables == kept.tables
    assert len(quarantine.store_of(other).numbers()) <= 2


def test_a_run_that_fails_leaves_the_rows_of_the_one_before(lake):
    before = quarantine.quarantine(lake, [CHANNEL])
    broken = RowRule("broken", "silver_dim_store", lambda: F.raise_error(F.lit("no")).cast("boolean"))
    with pytest.raises(PySparkException):
        quarantine.quarantine(lake, [CHANNEL, broken])
    now = quarantine.store_of(lake).snapshot()
    assert now.tables == before.tables and quarantine.failing_rows(now, CHANNEL).count() == 2


def test_checks_have_tables_of_their_own_without_a_second_write(lake):
    kept = quarantine.quarantine(lake, [*ALL, *checks.ROW_RULE_CHECKS])
    quarantine.link(lake, kept, [*ALL, *checks.ROW_RULE_CHECKS])
    assert _rows(read_table(lake.spark, f"{lake.root}/_test_failures/channel")) == [(1, 10, "fax"), (None, 99, "x")]
    clean = quarantine.slug(checks.ROW_RULE_CHECKS[0])
    assert read_table(lake.spark, f"{lake.root}/_test_failures/{clean}").count() == 0
    # and can be written as plain tables afterwards
    assert checks.store_failing_rows(lake, CHANNEL).count() == 2


def test_rows_meet_the_keys_at_fault_without_a_shuffle(lake, monkeypatch):
    def exchanges():
        found = quarantine.tagged(lake, TABLE, [KNOWN, UNIQUE, CHANNEL])
        plan = found._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning"), sorted(map(str, found.collect()))

    n, rows = exchanges()
    monkeypatch.setattr(quarantine, "BROADCAST_KEYS", 0)
    lake.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        more, same = exchanges()
    finally:
        lake.spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert n == 0 and more > 0 and rows == same


def test_empty_tables(tiny):
    empty = tiny()
    kept = quarantine.quarantine(empty, checks.ALL_CHECKS)
    assert all(v.rows == 0 for v in kept.tables.values()) and len(kept.tables) == 8
    assert quarantine.summary(kept).collect() == []
