"""Grouped sums together with exact distinct counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_distinct(
    df: DataFrame,
    keys: Sequence[str],
    entity: str,
    sums: Mapping[str, Column] | None = None,
    flags: Mapping[str, Column] | None = None,
    earliest: Mapping[str, Column] | None = None,
    latest: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per ``keys``: the ``sums``, and per flag how many distinct entities ever raise it.

    ``earliest`` and ``latest`` add minima and maxima.

    Two aggregations instead of several COUNT(DISTINCT): first one row per (keys, entity) with its
    part sums and OR-ed flags, then the group.  The rows are never multiplied, a group holding much of
    the data is spread over its entities, and both steps combine before they shuffle.  Input already
    laid out by the entity (the join of lines and orders) is not shuffled again for the first step.
    Rows without an entity id add to the sums but not to the counts.
    """
    sums, flags, earliest, latest = sums or {}, flags or {}, earliest or {}, latest or {}
    per_entity = df.groupBy(*keys, entity).agg(
        *[F.sum(value).alias(f"__s_{name}") for name, value in sums.items()],
        *[F.max(flag).alias(f"__f_{name}") for name, flag in flags.items()],
        *[F.min(value).alias(f"__e_{name}") for name, value in earliest.items()],
        *[F.max(value).alias(f"__l_{name}") for name, value in latest.items()],
    )
    known = F.col(entity).isNotNull()
    return per_entity.groupBy(*keys).agg(
        *[F.sum(f"__s_{name}").alias(name) for name in sums],
        *[F.count_if(known & F.col(f"__f_{name}")).alias(name) for name in flags],
        *[F.min(f"__e_{name}").alias(name) for name in earliest],
        *[F.max(f"__l_{name}").alias(name) for name in latest],
    )


def rollup_via(
    df: DataFrame,
    link: str,
    dimension: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    how: str = "inner",
) -> DataFrame:
    """Sums per dimension attribute: add up per link id, look the id up, add up again.

    The lookup joins one row per id instead of one per fact row, so neither a dimension that outgrew
    broadcasting nor an id that owns much of the fact table makes the join heavy.
    """
    per_id = df.groupBy(link).agg(*[F.sum(value).alias(name) for name, value in sums.items()])
    looked_up = per_id.join(dimension.select(link, *keys), link, how)
    return looked_up.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in sums])


def rollup_distinct_via(
    df: DataFrame,
    link: str,
    dimension: DataFrame,
    keys: Sequence[str],
    entity: str,
    sums: Mapping[str, Column],
    flags: Mapping[str, Column],
    how: str = "inner",
) -> DataFrame:
    """``rollup_distinct`` per dimension attribute, looked up only after the rows are one per (link, entity).

    The join sees an order once for each id it has lines of, not once for every line.
    """
    reduced = df.groupBy(link, entity).agg(
        *[F.sum(value).alias(f"__s_{name}") for name, value in sums.items()],
        *[F.max(flag).alias(f"__f_{name}") for name, flag in flags.items()],
    )
    own = [k for k in keys if k != link]
    looked_up = reduced.join(dimension.select(link, *own), link, how)
    return rollup_distinct(
        looked_up,
        keys,
        entity,
        {name: F.col(f"__s_{name}") for name in sums},
        {name: F.col(f"__f_{name}") for name in flags},
    )


@dataclass(frozen=True)
class Grain:
    """A grouping by `keys`, of the rows for which `rows` is true (all, if None)."""

    name: str
    keys: tuple[str, ...]
    rows: Column | None = None


def rollup_grains(
    df: DataFrame,
    grains: Sequence[Grain],
    entity: str,
    sums: Mapping[str, Column],
    flags: Mapping[str, Column],
) -> DataFrame:
    """``rollup_distinct`` at several grains from one reading of ``df``: a row for each grain and group, with the
    grain's name in ``grain`` and NULL in the key columns that it doesn't have.

    The rows are shuffled once, by entity, and only then copied for each grain: an entity's copies are where they are
    needed, so the step that makes one row of an entity in a group takes no exchange, and what leaves it is added up
    per group before the last, small one. Rows without an entity add to the sums only; they are spread by their keys.

    A task holds the copies of its entities in memory, a row for each grain, so there are as many times the session's
    number of tasks as there are grains. That number is given, as Spark would merge partitions by their size before
    the copies are made.
    """
    keys = list(dict.fromkeys(key for grain in grains for key in grain.keys))
    spread = F.when(F.col(entity).isNotNull(), F.xxhash64(F.lit(0), entity)).otherwise(F.xxhash64(F.lit(1), *keys))
    narrow = df.select(
        F.col(entity).alias("__entity"),
        spread.alias("__spread"),
        *keys,
        *[value.alias(f"__s_{name}") for name, value in sums.items()],
        *[flag.alias(f"__f_{name}") for name, flag in flags.items()],
        *[grain.rows.alias(f"__r_{grain.name}") for grain in grains if grain.rows is not None],
    )
    types = dict(narrow.dtypes)
    copies = []
    for grain in grains:
        own = [(F.col(k) if k in grain.keys else F.lit(None).cast(types[k])).alias(k) for k in keys]
        copy = F.struct(F.lit(grain.name).alias("grain"), *own)
        copies.append(copy if grain.rows is None else F.when(F.col(f"__r_{grain.name}"), copy))
    measures = [c for c in narrow.columns if c.startswith(("__s_", "__f_"))]
    tasks = len(grains) * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copied = narrow.repartition(tasks, "__spread").select(
        "__entity", "__spread", *measures, F.explode(F.array_compact(F.array(*copies))).alias("__copy")
    )
    placed = copied.select("__entity", "__spread", *measures, "__copy.*")
    per_entity = placed.groupBy("grain", *keys, "__entity", "__spread").agg(
        *[F.sum(f"__s_{name}").alias(f"__s_{name}") for name in sums],
        *[F.max(f"__f_{name}").alias(f"__f_{name}") for name in flags],
    )
    known = F.col("__entity").isNotNull()
    return per_entity.groupBy("grain", *keys).agg(
        *[F.sum(f"__s_{name}").alias(name) for name in sums],
        *[F.count_if(known & F.col(f"__f_{name}")).alias(name) for name in flags],
    )
