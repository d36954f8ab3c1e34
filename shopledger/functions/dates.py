"""Calendar helpers; all work on dates, so no session time zone is involved."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(moment: Column) -> Column:
    return F.trunc(moment.cast("date"), "MM")


def month_id(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def whole_years(start: Column, end: Column) -> Column:
    """Completed years: the count goes up on the anniversary, not before."""
    before_anniversary = F.struct(F.month(end), F.dayofmonth(end)) < F.struct(
        F.month(start), F.dayofmonth(start)
    )
    return F.year(end) - F.year(start) - F.when(before_anniversary, 1).otherwise(0)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end.cast("date"), start.cast("date"))
