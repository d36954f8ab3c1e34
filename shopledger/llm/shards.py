"""Tables dealt to shards of bounded size, each met by every question, one shard after another in a task.

Rows of a shard come first, then the questions in small batches, so a task holds one shard and one batch of
questions, whatever the size of either table. Neither side is copied more often than there are shards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Shard(Protocol):
    def add(self, rows: pa.RecordBatch) -> None: ...

    def answer(self, questions: pa.RecordBatch) -> Iterator[pa.RecordBatch]: ...


def dealt(rows: DataFrame, shards: int, *key: str) -> DataFrame:
    """`rows` with the shard that a hash of `key` gives."""
    return rows.withColumn("shard", F.pmod(F.xxhash64(*key), F.lit(shards)).cast("int"))


def asked_of_all(questions: DataFrame, shards: int) -> DataFrame:
    """`questions`, once for every shard."""
    return questions.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))


def _runs(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of a batch with equal keys."""
    values = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in keys], axis=1)
    edges = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
    for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(values)]):
        yield tuple(values[start].tolist()), batch.slice(start, end - start)


def answers(
    rows: DataFrame,
    questions: DataFrame,
    shards: int | None,
    shard_of: Callable[[], Shard],
    schema: str,
    within: Iterable[str] = (),
) -> DataFrame:
    """What the shards answer. Both tables have a column `shard`; `within` names integer columns whose values are
    never mixed in one shard. Other columns may differ: those that one side lacks are null in its rows. Without a
    number of `shards` the session decides how many tasks there are."""
    keys = [*within, "shard"]
    both = rows.withColumn("asks", F.lit(0)).unionByName(
        questions.withColumn("asks", F.lit(1)), allowMissingColumns=True
    )
    ordered = both.repartition(*([max(shards, 1)] if shards else []), *keys).sortWithinPartitions(*keys, "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: Shard | None = None
        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            for (*found, asks), part in _runs(batch, [*keys, "asks"]):
                if found != key:
                    here, key = shard_of(), found
                if asks:
                    yield from here.answer(part)
                else:
                    here.add(part)

    return ordered.mapInArrow(run, schema)
