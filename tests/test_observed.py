"""Expectations counted by the writes of a build."""

import subprocess
import sys
import textwrap

import pytest
from conftest import ROOT
from pyspark.errors import PySparkException

from shopledger import incremental
from shopledger.quality import expectations
from shopledger.quality.expectations import Expectation, Watch
from shopledger.sources.snapshots import SnapshotStore

SALE, ORDERS = "silver_fact_sale", "silver_fact_transaction"
WATCHED = [
    Expectation(SALE, "set", "sale_id IS NOT NULL"),
    Expectation(SALE, "positive", "quantity > 0", "warn"),
    Expectation("gold_fact_sale", "positive", "quantity > 0", "warn"),
    Expectation(ORDERS, "set", "transaction_id IS NOT NULL"),
]
LINES = [{"sale_id": i, "transaction_id": 1, "quantity": q} for i, q in enumerate([1, 0, -1, None, 2])]


def _lake(tiny, lines=LINES):
    return tiny(fact_sale=lines, fact_transaction=[{"transaction_id": 1}])


def test_counts_are_those_of_a_second_pass(tiny):
    lake, watch = _lake(tiny), Watch(WATCHED)
    lake.store([SALE, ORDERS, "gold_fact_sale"], prepare=watch.attach)
    found = sorted(watch.counts())
    assert found == sorted(tuple(r) for r in expectations.violation_report(lake, WATCHED).collect())
    assert (SALE, "positive", "warn", 5, 3) in found and ("gold_fact_sale", "positive", "warn", 5, 3) in found


def test_a_row_that_breaks_a_fail_expectation_stops_the_build(tiny):
    lines = [*LINES, {"sale_id": None, "transaction_id": 1, "quantity": 1}]
    with pytest.raises(PySparkException, match="expectation set failed"):
        _lake(tiny, lines).store([SALE], prepare=Watch(WATCHED).attach)
    watch = Watch(WATCHED, stop=False)
    _lake(tiny, lines).store([SALE], prepare=watch.attach)
    assert (SALE, "set", "fail", 6, 1) in watch.counts()


def test_a_refresh_counts_what_it_rebuilds(spark, tiny, tmp_path):
    watch, store = Watch(WATCHED), SnapshotStore(spark, str(tmp_path / "tables"))
    version = {"raw_version": lambda table: "1"}
    incremental.refresh(_lake(tiny), store, [SALE, "gold_fact_sale"], prepare=watch.attach, **version)
    assert {c[:2]: c[4] for c in watch.counts()} == {(SALE, "set"): 0, (SALE, "positive"): 3, ("gold_fact_sale", "positive"): 3}
    again = Watch(WATCHED)
    incremental.refresh(_lake(tiny), store, [SALE, "gold_fact_sale"], prepare=again.attach, **version)
    assert again.counts() == []


def test_tasks_that_run_again_count_once(tmp_path):
    """In a session of its own, whose tasks may fail: the first attempt at each partition dies after half of its rows."""
    script = f"""
        import sys
        sys.path[:0] = [{str(ROOT)!r}]
        from pyspark import TaskContext
        from pyspark.sql import SparkSession
        from shopledger.quality.expectations import Expectation, Watch
        from shopledger.sources.writer import write_table
        spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "3").getOrCreate())
        spark.sparkContext.setLogLevel("OFF")

        def dies(batches):
            for n, batch in enumerate(batches):
                yield batch
                if TaskContext.get().attemptNumber() == 0 and n == 1:
                    raise RuntimeError("lost")

        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
        for cluster_by in ([], ["k"]):
            rows = spark.range(0, 4000, 1, 4).mapInArrow(dies, "id long").selectExpr("id", "id % 7 AS k")
            watch = Watch([Expectation("t", "e", "id % 10 <> 0", "warn")])
            write_table(rows, {str(tmp_path)!r} + f"/t{{len(cluster_by)}}", cluster_by=cluster_by,
                        finish=lambda df: watch.attach("t", df))
            print("COUNTED", watch.counts())
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=300)
    counted = [line for line in done.stdout.splitlines() if line.startswith("COUNTED")]
    assert counted == ["COUNTED [('t', 'e', 'warn', 4000, 400)]"] * 2, done.stderr[-2000:]
