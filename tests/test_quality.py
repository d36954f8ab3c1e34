import itertools

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import AS_OF, SMALL
from shopledger import Lakehouse
from shopledger.quality import checks, expectations
from shopledger.quality.checks import Referential, Unique, accepted_values, not_null
from shopledger.sources.writer import read_table
from test_marts import session


def counts(lake, *instances):
    return {r["check_name"]: r["failing_rows"] for r in checks.check_results(lake, instances).collect()}


def orders(*rows):
    return [dict(zip(("transaction_id", "customer_id", "sales_channel"), r, strict=True)) for r in rows]


TABLE = "silver_fact_transaction"


def test_kinds(tiny):
    lake = tiny(
        fact_transaction=orders(
            (1, 10, "Web"), (1, 11, "web"), (1, None, None), (2, 99, "fax"), (None, 10, "store"), (None, 99, "x")
        ),
        dim_customer=[{"customer_id": 10, "email_address": "a"}, {"customer_id": 11, "email_address": "b"}],
    )
    unique = Unique("u", TABLE, "transaction_id")
    known = Referential("r", TABLE, "customer_id", "silver_dim_customer", "customer_id")
    listed = accepted_values("a", TABLE, "sales_channel", ["web", "store"])
    found = counts(lake, not_null("n", TABLE, "transaction_id"), unique, known, listed)
    # Duplicate keys are counted, not rows, and NULL is one key; a NULL link or value passes.
    assert found == {"n": 2, "u": 2, "r": 2, "a": 2}
    assert {(r["transaction_id"], r["n_rows"]) for r in unique.failing_rows(lake).collect()} == {(1, 3), (None, 2)}
    for check, n in ((unique, 2), (known, 2), (listed, 2)):
        assert checks.store_failing_rows(lake, check).count() == n
        assert checks.store_failing_rows(lake, check).count() == n


def test_accepted_values_mind_case_unless_told(tiny):
    lake = tiny(fact_clickstream=[session(i, traffic_source=s) for i, s in enumerate(["Web", "web", None, "tv"])])
    table = "silver_fact_clickstream"
    strict = accepted_values("strict", table, "traffic_source", ["web"])
    loose = accepted_values("loose", table, "traffic_source", ["web"], ignore_case=True)
    assert counts(lake, strict, loose) == {"strict": 2, "loose": 1}


def test_funnel_rule_takes_purchases_without_a_view(tiny):
    flags = list(itertools.product([True, False, None], repeat=3))
    lake = tiny(fact_clickstream=[session(i, v, c, b) for i, (v, c, b) in enumerate(flags)])
    rule = next(c for c in checks.ROW_RULE_CHECKS if "funnel" in c.name)
    caught = {flags[r["session_id"]] for r in rule.failing_rows(lake).collect()}
    assert caught == {(False, True, True), (False, False, True)}


def test_campaign_rule_passes_an_unknown_source(tiny):
    lake = tiny(
        fact_clickstream=[
            session(1, campaign_id=1, traffic_source="Campaign"),
            session(2, campaign_id=1, traffic_source="Email"),
            session(3, campaign_id=1, traffic_source=None),
            session(4, traffic_source="Email"),
        ]
    )
    rule = next(c for c in checks.ROW_RULE_CHECKS if "campaign_id" in c.name)
    assert [r["session_id"] for r in rule.failing_rows(lake).collect()] == [2]


def test_there_are_19_checks_with_one_name_each():
    assert len({c.name for c in checks.ALL_CHECKS}) == len(checks.ALL_CHECKS) == 19
    assert len(checks.constraint_checks()) == 6 + 6 + 9


def test_report_puts_the_worst_first(tiny):
    lake = tiny(inventory=[{"inventory_id": i, "closing_stock": -1} for i in range(3)])
    shown = checks.report(checks.check_results(lake, checks.ALL_CHECKS)).collect()
    assert (shown[0]["check_name"], shown[0]["failing_rows"], shown[0]["status"]) == (
        "inventory: no negative closing stock",
        3,
        "❌ FAIL",
    )
    assert {r["status"] for r in shown[1:]} == {"✅ PASS"}
    names = [r["check_name"] for r in shown[1:]]
    assert names == sorted(names)


def test_guard(tiny):
    good = tiny()
    assert checks.guard(checks.check_results(good, checks.ALL_CHECKS)).first()["result"] == checks.ALL_PASSED
    bad = tiny(
        inventory=[{"inventory_id": i, "closing_stock": -1} for i in range(3)],
        fact_transaction=[{"transaction_id": None}],
    )
    with pytest.raises(PySparkException, match=r"FAILED for 2 check\(s\); total offending rows = 4"):
        checks.guard(checks.check_results(bad, checks.ALL_CHECKS)).collect()


def test_row_rules_of_one_table_share_a_scan(tiny):
    lake = tiny()
    plan = checks.check_results(lake, checks.ACCEPTED_VALUE_CHECKS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LocalRelation") + plan.count("LogicalRDD") <= 1


def test_expectations_are_complete():
    declared = expectations.DECLARED
    assert len(expectations.EXPECTATIONS) == 66
    assert {e.table for e in expectations.EXPECTATIONS} == {t for e in declared for t in (e.table, f"{e.table}_alt")}
    assert len(declared) == 33
    assert sum(e.action == "fail" for e in declared) == 24
    assert len({e.table for e in declared}) == 24


def test_a_failed_expectation_stops_even_a_count(tiny):
    lake = tiny(fact_sale=[{"sale_id": 1}, {"sale_id": None}])
    table = "silver_fact_sale"
    guarded = expectations.enforce(lake.table(table), expectations.expectations_on(table))
    with pytest.raises(PySparkException, match="valid_sale_id"):
        guarded.count()
    with pytest.raises(PySparkException, match="valid_sale_id"):
        guarded.select("quantity").collect()


def test_a_kept_expectation_changes_nothing(tiny):
    lake = tiny(fact_sale=[{"sale_id": 1, "quantity": -1}])
    table = "silver_fact_sale"
    assert expectations.enforce(lake.table(table), expectations.expectations_on(table)).count() == 1


def test_warnings_are_counted_while_the_rows_are_written(tiny, tmp_path):
    lake = tiny(fact_sale=[{"sale_id": 1, "quantity": 1}, {"sale_id": 2, "quantity": 0}, {"sale_id": 3}])
    table = "silver_fact_sale"
    df, seen = expectations.observe(lake.table(table), expectations.expectations_on(table))
    df.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 3, "valid_quantity": 2, "valid_line_total": 3}
    plain, nothing = expectations.observe(lake.table(table), [])
    assert nothing is None and plain is lake.table(table)


def test_email_warning(tiny):
    emails = ["a@b", "ab", None]
    lake = tiny(dim_customer=[{"customer_id": i, "email_address": e} for i, e in enumerate(emails)])
    email = [e for e in expectations.EXPECTATIONS if e.name == "valid_email"]
    rows = expectations.violation_report(lake, email).collect()
    assert {(r["table_name"], r["rows"], r["violations"]) for r in rows} == {
        ("silver_dim_customer", 3, 2),
        ("silver_dim_customer_alt", 3, 2),
    }


def test_enforced_counts(tiny):
    lake = tiny(fact_sale=[{"sale_id": 1}])
    result = expectations.enforced_counts(lake, ["silver_fact_sale", "silver_dim_date"])
    assert {r["table_name"]: r["rows"] for r in result.select(F.col("table_name"), "rows").collect()} == {
        "silver_fact_sale": 1,
        "silver_dim_date": 0,
    }


def test_a_run_rebuilds_checks_and_counts_warnings(spark):
    from shopledger.plans import pipeline
    from shopledger.sources.sample import SampleRetail

    clean = Lakehouse(spark, SampleRetail(spark, SMALL, dirt=False), AS_OF)
    report = pipeline.run(clean)
    assert report.rows["silver_fact_sale"] == report.rows["gold_fact_sale"] == 6000
    standard = {k: n for k, n in report.violations.items() if not k[0].endswith("_alt")}
    assert set(standard.values()) == {0} | {standard["silver_fact_transaction", "valid_transaction_total"]}
    assert len(standard) == 9 and len(report.violations) == 18
    assert spark.table("gold.gold_fact_sale_alt").count() == 6000
    assert {r["status"] for r in report.checks.collect()} == {"✅ PASS"}


def test_a_run_over_empty_tables_ends(tiny):
    from shopledger.plans import pipeline

    lake = tiny()
    for _ in range(2):
        report = pipeline.run(lake)
        assert set(report.rows.values()) == {0}


def test_a_run_over_defects_stops_at_the_guard_and_keeps_the_rows(spark):
    from shopledger.plans import pipeline
    from shopledger.sources.sample import SampleRetail

    lake = Lakehouse(spark, SampleRetail(spark, SMALL), AS_OF)
    orphans = checks.REFERENTIAL_CHECKS[0]
    with pytest.raises(pipeline.ChecksFailed, match=r"Data quality FAILED for \d+ check") as failed:
        pipeline.run(lake, alternative=False)
    kept = read_table(spark, f"{lake.root}/_test_failures/fact_transaction_customer_id_dim_customer")
    assert kept.count() == orphans.failing_rows(lake).count() > 0
    shown = {r["check_name"]: r["failing_rows"] for r in failed.value.report.checks.collect()}
    assert len(shown) == 19 and shown[orphans.name] == kept.count()
    assert failed.value.report.rows["silver_fact_sale"] == 6000
