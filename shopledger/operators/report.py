"""Reading a mart the way a report does: its best rows, or a stretch of time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, measure: str, n: int, tiebreak: Sequence[str]) -> DataFrame:
    """The ``n`` rows with the largest measure; ties go by the tiebreak columns."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in tiebreak]).limit(n)


def date_range(df: DataFrame, column: str, start: dt.date, end: dt.date) -> DataFrame:
    """Rows whose date lies in the closed range."""
    return df.filter(F.col(column).between(F.lit(start), F.lit(end)))
