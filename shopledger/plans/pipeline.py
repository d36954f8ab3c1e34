"""One scheduled run: schemas, raw load, rebuild under expectations, checks, guard."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from shopledger.lakehouse import Lakehouse
from shopledger.quality import checks, expectations, quarantine
from shopledger.sources.catalog import RAW_TABLES
from shopledger.sources.snapshots import Snapshot
from shopledger.sources.writer import write_table


@dataclass
class RunReport:
    """``violations`` maps (table, expectation) to its count; ``checks`` reads the stored check report, and
    ``quarantine`` has the rows that break checks."""

    rows: dict[str, int] = field(default_factory=dict)
    violations: dict[tuple[str, str], int] = field(default_factory=dict)
    checks: DataFrame | None = None
    quarantine: Snapshot | None = None


class ChecksFailed(RuntimeError):
    """Some check found offending rows; ``report`` is that of the run."""

    def __init__(self, message: str, report: RunReport):
        super().__init__(message)
        self.report = report


def run(
    lake: Lakehouse,
    guard: bool = True,
    keep_failures: Iterable[checks.Check] = checks.ALL_CHECKS,
    alternative: bool = True,
) -> RunReport:
    """Rebuild everything and return what was found; stop on a broken expectation or check.

    Violations of ``warn`` expectations are counted by the writes themselves, without another pass.
    The results of the checks are stored once, and report and guard read them.  With ``guard`` a
    failing check raises ``ChecksFailed``, which carries the report, after the rows behind
    ``keep_failures`` are stored; each table's rows are read once for that, whatever the number of checks.
    """
    report = RunReport()
    watched = {}

    def watch(name: str, df: DataFrame) -> DataFrame:
        declared = expectations.expectations_on(name)
        df, seen = expectations.observe(expectations.enforce(df, declared), declared)
        if seen is not None:
            watched[name] = seen
        return df

    lake.create_schemas()
    lake.store_raw(RAW_TABLES)
    lake.build(prepare=watch)
    if alternative:
        lake.build(prepare=watch, alternative=True)
    lake.enter_tables()
    for name, seen in watched.items():
        counts = seen.get
        report.rows[name] = counts.pop("rows")
        report.violations.update({(name, expectation): n for expectation, n in counts.items()})
    keep_failures = list(keep_failures)
    if keep_failures:
        report.quarantine = quarantine.quarantine(lake, keep_failures)
        quarantine.link(lake, report.quarantine, keep_failures)
    results = write_table(checks.check_results(lake, checks.ALL_CHECKS), f"{lake.root}/_checks")
    report.checks = checks.report(results)
    if guard:
        message = checks.complaint(results)
        if message:
            raise ChecksFailed(message, report)
    return report
