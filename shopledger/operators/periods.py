"""Reports over a stretch of time that read only the months they need.

Facts are stored by month of their own day. A lakehouse cut to some months leaves out the other months' files before
any is opened: for a range of dates when the plan is made, for a condition on the calendar while the query runs, once
the days that meet it are known. Every dataset built from a cut lakehouse sees those months' rows only.
"""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.dates import month_id
from shopledger.lakehouse import Lakehouse
from shopledger.operators.report import date_range
from shopledger.sources.writer import write_table

MONTH = "stored_month"
#: The moment that dates each fact.
MOMENTS = {
    "gold_order_totals": "transaction_timestamp",
    "gold_fact_sale": "transaction_timestamp",
    "gold_fact_transaction": "transaction_timestamp",
    "gold_fact_clickstream": "session_start_time",
}


def day_of(fact: str) -> Column:
    return F.col(MOMENTS[fact]).cast("date")


def store_by_month(lake: Lakehouse, facts: Iterable[str]) -> Lakehouse:
    """Store facts with a folder for every month; rows without a moment have a folder of their own.

    The rows of a month come together in files of the session's advisory size, so a month that holds much of the table
    is spread and a small one is one file.
    """
    for fact in facts:
        dated = lake.define(fact).withColumn(MONTH, month_id(day_of(fact)))
        lake.keep(fact, write_table(dated, lake.path(fact), cluster_by=[MONTH], partition_by=[MONTH]))
    return lake


def _by_month(lake: Lakehouse) -> dict[str, DataFrame]:
    stored = {fact: lake.table(fact) for fact in MOMENTS if lake.is_stored(fact)}
    return {fact: df for fact, df in stored.items() if MONTH in df.columns}


def months_between(lake: Lakehouse, start: dt.date, end: dt.date) -> Lakehouse:
    """The lakehouse with the facts stored by month cut to the months from that of `start` to that of `end`, whole."""
    first, last = (day.year * 100 + day.month for day in (start, end))
    cut = {fact: df.filter(F.col(MONTH).between(first, last)) for fact, df in _by_month(lake).items()}
    return lake.with_tables(cut)


def days_where(lake: Lakehouse, condition: str | Column, days: str = "gold_dim_date") -> Lakehouse:
    """The lakehouse with the facts stored by month cut to the calendar days that meet a condition.

    The calendar is joined by month and day, so the months of the days that qualify prune the facts' folders.
    """
    picked = lake.table(days).filter(condition).select(month_id(F.col("date")).alias("__month"), F.col("date").alias("__day"))
    cut = {}
    for fact, df in _by_month(lake).items():
        on_day = (F.col(MONTH) == F.col("__month")) & (day_of(fact) == F.col("__day"))
        cut[fact] = df.join(picked, on_day, "left_semi")
    return lake.with_tables(cut)


def series_between(lake: Lakehouse, mart: str, column: str, start: dt.date, end: dt.date) -> DataFrame:
    """A mart by day or month between two dates, from the facts of those months alone.

    Equal to the whole mart cut to the dates, since each of its rows is made of one month's facts at most. Marts that
    look back in time, such as first purchases, are not of this kind.
    """
    last = end.replace(day=calendar.monthrange(end.year, end.month)[1])
    return date_range(months_between(lake, start, last).table(mart), column, start, end)
