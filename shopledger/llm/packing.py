"""Variable-capacity best-fit packing of documents into training sequences.

Items of equal length are interchangeable, so the packing is planned on the histogram of lengths, which has no more
entries than the largest capacity has positions, however many items there are. Best fit, longest first, treats bins
with the same room as one group: a group takes in as many items at a time as it holds bins. Each item then finds its
place by its number among those of its length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.tables import written


@dataclass(frozen=True)
class Packing:
    """capacities: permitted sequence lengths. A sequence costs its capacity plus `overhead`. credits: prices tried for
    a free position of a bin that is opened, from worthless to as good as filled; with each of them, every capacity is
    tried as the least one to be opened, and the plan of least cost is taken. bucket_rows: items that one task numbers
    at a time."""

    capacities: tuple[int, ...] = (2048, 4096, 8192, 16384)
    overhead: int = 64
    credits: tuple[float, ...] = (0.0, 0.9, 1.0)
    bucket_rows: int = 4_096

    def cost(self, capacity: int) -> int:
        return capacity + self.overhead


@dataclass
class Plan:
    """Runs of items: of `length`, numbers from `rank` on, `each` to a bin from bin `bin` on, starting at position
    `base` of the bin. Runs of bins: from `bin` on, `count` of them, of `capacity`, `used` of it."""

    items: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    bins: list[tuple[int, int, int, int]] = field(default_factory=list)
    cost: int = 0


def best_fit(histogram: dict[int, int], options: Packing, credit: float, least: int = 0) -> Plan:
    """Best fit, longest first, of bins with equal room the one opened first; if no open bin has room, the
    capacity opened is, of those from `least` on, the one of least cost an item, a free position being credited with
    `credit`. Finally each bin shrinks to the least capacity that holds its contents."""
    capacities = sorted(options.capacities)
    plan, n_bins = Plan(), 0
    rooms: list[int] = []  # in order, of bins that are open
    groups: dict[int, list[tuple[int, int, int]]] = {}  # room -> (first bin, bins, capacity)

    def put(room: int, first: int, count: int, capacity: int) -> None:
        if count:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            heappush(groups[room], (first, count, capacity))

    def opened(length: int) -> int:
        def price(capacity: int) -> tuple[float, int]:
            each = capacity // length
            free = capacity - each * length
            return (options.cost(capacity) - credit * free) / each, capacity

        return min((c for c in capacities if c >= max(length, least)), key=price)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, count, capacity = heappop(groups[room])
                if not groups[room]:
                    del groups[room]
                    rooms.pop(at)
            else:
                room = capacity = opened(length)
                first, count = n_bins, -(-left // (capacity // length))
                n_bins += count
            # the bin that takes an item has then the least room, so it takes the next one too, as long as it can
            each = room // length
            full = min(count, left // each)
            some = left - full * each if full < count else 0
            base = capacity - room
            if full:
                plan.items.append((length, rank, each, first, base))
            if some:
                plan.items.append((length, rank + full * each, each, first + full, base))
            put(room - each * length, first, full, capacity)
            put(room - some * length, first + full, 1 if some else 0, capacity)
            put(room, first + full + (some > 0), count - full - (some > 0), capacity)
            rank += full * each + some
            left -= full * each + some
    for room, held in groups.items():
        for first, count, capacity in held:
            used = capacity - room
            final = next(c for c in capacities if c >= used)
            plan.bins.append((first, count, final, used))
            plan.cost += count * options.cost(final)
    plan.items.sort()
    plan.bins.sort()
    return plan


def jointly_best(histogram: dict[int, int], options: Packing) -> Plan:
    """The least costly of the plans for all credits and least capacities; of equal ones the first."""
    tried = (best_fit(histogram, options, c, least) for least in sorted(options.capacities) for c in options.credits)
    return min(tried, key=lambda plan: plan.cost)


def _placed(plan: Plan):
    items = np.array(plan.items, np.int64).reshape(-1, 5)
    bins = np.array(plan.bins, np.int64).reshape(-1, 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = np.rec.fromarrays([items[:, 0], items[:, 1]], names="length,rank")
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            asked = np.rec.fromarrays([length, rank], names="length,rank")
            of = items[np.searchsorted(starts, asked, side="right") - 1]
            nth = rank - of[:, 1]
            bin_id = of[:, 3] + nth // of[:, 2]
            offset = of[:, 4] + nth % of[:, 2] * length
            capacity = bins[np.searchsorted(bins[:, 0], bin_id, side="right") - 1, 2]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(bin_id), pa.array(offset), pa.array(capacity)],
                ["doc_id", "piece", "start", "length", "bin_id", "offset", "capacity"],
            )

    return run


def pack(
    docs: DataFrame, length_col: str = "length", id_col: str = "doc_id", options: Packing = Packing()
) -> DataFrame:
    """(doc_id, piece, start, length, bin_id, offset, capacity): where each piece of each row of `docs` goes.

    Rows longer than the largest capacity are cut into pieces of that capacity and a rest. A bin's pieces lie one
    behind the other from offset 0. The driver sees the histogram of lengths and nothing else.

    Items are numbered within their length in buckets of bounded size, so a length that a third of all items have is
    numbered by many tasks.

    Defined cases: a length that is null or under 1 counts as 1; a null id is passed on; repeated rows are packed as
    often as they come; an empty table gives an empty table; other columns are not looked at.
    """
    spark, largest = docs.sparkSession, max(options.capacities)
    total = F.greatest(F.coalesce(F.col(f"`{length_col}`").cast("long"), F.lit(1)), F.lit(1))
    sized = docs.select(F.col(f"`{id_col}`").alias("doc_id"), total.alias("_total"))
    cut = sized.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_total - 1) div {largest}"))))
    start = F.col("piece") * largest
    pieces = written(
        spark,
        cut.select(
            "doc_id",
            F.col("piece").cast("int").alias("piece"),
            start.alias("start"),
            F.least(F.col("_total") - start, F.lit(largest)).alias("length"),
            # stored, so that every reader deals the rows out alike
            F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()).alias("salt"),
        ),
        "pieces",
    )
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = jointly_best(histogram, options)
    buckets = max(1, sum(histogram.values()) // options.bucket_rows)
    dealt = pieces.withColumn("bucket", F.pmod("salt", F.lit(buckets))).drop("salt")
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece"))
    ranked = dealt.withColumn("nth", nth).join(offsets, ["length", "bucket"])
    ready = ranked.select("doc_id", "piece", "start", "length", (F.col("before") + F.col("nth") - 1).alias("rank"))
    kind = docs.schema[id_col].dataType.simpleString()
    return ready.mapInArrow(
        _placed(plan),
        f"doc_id {kind}, piece int, start long, length long, bin_id long, offset long, capacity long",
    )


def byte_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, length): positions that a byte-level model needs for the text, an end mark included; null: empty."""
    size = F.octet_length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))) + 1
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), size.cast("long").alias("length"))
