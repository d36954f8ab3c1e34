"""SimHash near-duplicates, found by covering locality-sensitive hashing and joined to components.

Fingerprints within the radius are never missed: bit i gets a non-zero vector of radius + 1 bits, and table v masks
in the bits whose vector has odd parity with v. The at most `radius` vectors of differing bits have some v in common
that is orthogonal to all of them, so the two fingerprints agree in table v.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopledger.llm.components import components
from shopledger.llm.tables import small_batches, written

SEED = 42
BITS = 64
#: Fingerprints compared in one go; larger buckets are split into pairs of parts of this size.
CELL = 2048


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """The 2^(radius+1) - 1 masks, as unsigned numbers."""
    vectors = 2 ** (radius + 1) - 1
    codes = [1 + i % vectors for i in range(bits)]
    return [sum(1 << i for i, code in enumerate(codes) if (code & v).bit_count() % 2) for v in range(1, vectors + 1)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The signed 64-bit SimHash of a UTF-8 text; 0 if it has no words."""
    words = text.lower().split() if text else []  # of bytes: A-Z only, and space and 0x09 to 0x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - width]]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[width - 1 :])], ">u8")
    set_in = np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp) for every row; without a shuffle."""
    small_batches(docs.sparkSession)
    text = F.col(f"`{text_col}`").cast("binary")
    picked = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text, shingle) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(found, pa.int64())],
                ["doc_id", "text_hash", "fp"],
            )

    return picked.mapInArrow(run, "doc_id long, text_hash long, fp long")


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of differing bits; of signed numbers numpy would count those of the absolute value."""
    return np.bitwise_count(np.bitwise_xor(a, b).view(np.uint64))


def spanning_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the values within `radius` bits of each other: fewer than there are values."""
    links: list[tuple[int, int]] = []
    rest = values
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            here = frontier.pop()
            near = differing(rest, here) <= radius
            if near.any():
                found = rest[near]
                links += [(int(here), int(x)) for x in found]
                frontier += list(found)
                rest = rest[~near]
    return links


def _linked(radius: int):
    """For rows sorted by cell: links inside each run of equal cells, the last run of a batch waiting for the next."""

    def links(cells: np.ndarray, values: np.ndarray) -> list[tuple[int, int]]:
        edge = np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1
        bounds = np.concatenate(([0], edge, [len(cells)]))
        starts, sizes = bounds[:-1], np.diff(bounds)
        pairs = starts[sizes == 2]
        a, b = values[pairs], values[pairs + 1]
        near = differing(a, b) <= radius
        out = list(zip(a[near].tolist(), b[near].tolist()))
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            out += spanning_links(values[start : start + size], radius)
        return out

    def batch_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
        low = [min(x) for x in found]
        high = [max(x) for x in found]
        return pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, values = np.empty((0, 4), np.int64), np.empty(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("v", "key", "i", "j")], axis=1)
            cells = np.concatenate([cells, new])
            values = np.concatenate([values, batch.column("fp").to_numpy()])
            changed = np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1))
            if len(changed):
                cut = int(changed[-1]) + 1
                yield batch_of(links(cells[:cut], values[:cut]))
                cells, values = cells[cut:], values[cut:]
        if len(cells):
            yield batch_of(links(cells, values))

    return run


def close_pairs(classes: DataFrame, radius: int, cell: int = CELL) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints of `classes` (fp) as far as links within `radius` do.

    A bucket of n fingerprints becomes one cell, or a cell for each pair of its ceil(n / cell) parts, so no task has
    to hold a bucket. A cell returns a spanning forest, never all its pairs.
    """
    tables = F.array(
        *[
            F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(signed(mask))).alias("key"))
            for v, mask in enumerate(covering_masks(radius))
        ]
    )
    placed = classes.select("fp", F.explode(tables).alias("t")).select("fp", "t.v", "t.key")
    buckets = placed.groupBy("v", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    parts = placed.join(buckets, ["v", "key"]).withColumn("parts", F.ceil(F.col("n") / cell).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    # with one part: the cell (0, 0); else the cell of the own part with every other
    others = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: j != F.col("own"))
    )
    cells = (
        parts.withColumn("own", own)
        .select("v", "key", "fp", "own", F.explode(others).alias("other"))
        .select("v", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    )
    keys = ["v", "key", "i", "j"]
    sorted_cells = cells.repartition(*keys).sortWithinPartitions(*keys)
    return sorted_cells.mapInArrow(_linked(radius), "a long, b long").distinct()


def _rooted(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, cell: int
) -> tuple[DataFrame, DataFrame]:
    """Every row's (doc_id, text_hash, fp), and every fingerprint's (fp, root)."""
    spark: SparkSession = docs.sparkSession
    fps = written(spark, fingerprints(docs, id_col, text_col, shingle), "simhash")
    classes = fps.select("fp").distinct()
    roots = components(spark, close_pairs(classes, max_bits, cell))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return fps, rooted.select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 3,
    cell: int = CELL,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row; fingerprints link at `max_bits` or fewer differing bits.

    Equal fingerprints are one class from the start, so copies cost a count and not pairs. Other columns of `docs`
    are not looked at.

    Defined cases: a text that is null, empty or has no words has fingerprint zero and links like any other; fewer
    words than the shingle length make one shingle; a null id takes part but names no component unless all of its
    component are null; repeated rows each get their row; an empty table gives an empty table.
    """
    fps, rooted = _rooted(docs, id_col, text_col, shingle, max_bits, cell)
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least")).join(rooted, "fp")
    ids = least.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = rooted.join(ids, "root").select("fp", "component_id")
    return fps.join(of_class, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3, cell: int = CELL) -> DataFrame:
    """The rows of `docs` (with doc_id and text) without near-duplicates: one row stays of every component.

    It has the component's smallest id; of several rows with that id (or of rows that all have none) the one with the
    least text hash stays, and of rows equal in both any one.
    """
    fps, rooted = _rooted(docs, "doc_id", "text", shingle, max_bits, cell)
    row = F.struct(F.col("doc_id").isNull().alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id"), "text_hash")
    by_class = fps.groupBy("fp").agg(F.min(row).alias("row")).join(rooted, "fp")
    chosen = by_class.groupBy("root").agg(F.min("row").alias("row")).select("row.*")
    keyed = docs.select(
        F.struct("*").alias("_row"),
        F.col("doc_id").isNull().alias("_none"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"),
        F.xxhash64(F.col("text").cast("binary")).alias("text_hash"),
    )
    keys = ["_none", "_id", "text_hash"]
    kept = keyed.join(chosen, keys)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    return kept.withColumn("_nth", nth).filter("_nth = 1").select("_row.*")
