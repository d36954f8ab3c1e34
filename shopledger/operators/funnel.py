"""Turn one row of stage counts into one row per stage."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def funnel_stages(
    counts: DataFrame,
    stages: Sequence[tuple[str, str]],
    share: Callable[[int, Column, Column], Column],
) -> DataFrame:
    """``stages`` are (count column, label), the first being the base of every percentage.

    ``share(step, count, base)`` gives the percentage of a stage.
    """
    base = F.col(stages[0][0])
    rows = [
        F.struct(
            F.lit(step).alias("step"),
            F.lit(label).alias("stage"),
            F.col(column).alias("sessions"),
            share(step, F.col(column), base).alias("pct_of_sessions"),
        )
        for step, (column, label) in enumerate(stages, start=1)
    ]
    return counts.select(F.inline(F.array(*rows)))
