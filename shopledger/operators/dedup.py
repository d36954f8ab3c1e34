"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    keep_null_keys: bool = False,
) -> DataFrame:
    """The first row of each key under ``order`` (ascending, NULLs first).

    All rows with a NULL key form one group, of which one row stays, unless ``keep_null_keys``.
    Give an order that ends in a unique column, so that the choice is repeatable.  ``rank = 1``
    becomes a per-task group limit below the shuffle: each task sends one row per key, however many
    rows share it.
    """
    rank = "__rank"
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    if not keep_null_keys:
        return ranked.filter(F.col(rank) == 1).drop(rank)
    incomplete = F.lit(False)
    for key in keys:
        incomplete = incomplete | F.col(key).isNull()
    first = df.filter(~incomplete).withColumn(
        rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return first.filter(F.col(rank) == 1).drop(rank).unionByName(df.filter(incomplete))
