"""Nearest neighbours by inner product over randomly rotated one-bit codes, reranked where error bounds leave doubt.

A vector x of norm |x| is kept as the signs of its rotated direction, packed to bits, with two scalars: |x| and
c = <sign vector / sqrt(D), rotated direction>. For a rotated query q, <x, q> is estimated as
|x| * <signs, q> / (sqrt(D) * c). The part of the direction that the signs don't show is, seen from a random
rotation, random too, so the error is at most |x| * |q| * sqrt(1 - c^2) / c * epsilon / sqrt(D - 1), but for a chance
that falls as exp(-epsilon^2 / 2).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.tables import small_batches


@dataclass(frozen=True)
class BitCodes:
    """epsilon: width of the bounds in standard errors. Cells of the search hold so many rows of either side."""

    neighbours: int = 20
    epsilon: float = 4.0
    candidate_block: int = 4096
    query_block: int = 1024
    seed: int = 7


def rotation(dimension: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, norms and corrections c of non-zero vectors."""
    # scaled by the largest component first, so that the square of no finite component overflows or vanishes
    scale = np.abs(vectors).max(axis=1)
    unit = vectors / scale[:, None]
    length = np.sqrt((unit * unit).sum(axis=1))
    turned = (unit / length[:, None]) @ turn.T
    correction = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(turned > 0, axis=1), scale * length, correction


def estimate(
    codes: np.ndarray, norms: np.ndarray, correction: np.ndarray, query: np.ndarray, dimension: int, epsilon: float
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of every coded vector with every (rotated) query, and half the width of the bounds."""
    signs = np.unpackbits(codes, axis=1, count=dimension).astype(np.float64) * 2 - 1
    found = (query @ signs.T) * (norms / (np.sqrt(dimension) * correction))
    blur = np.sqrt(np.maximum(0.0, 1 - correction**2)) / correction * epsilon / np.sqrt(max(dimension - 1, 1))
    width = np.sqrt((query * query).sum(axis=1))[:, None] * (norms * blur)
    # what rounding alone may add
    return found, width + 1e-9 * np.abs(found) + np.finfo(np.float64).tiny


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added up from the first component to the last."""
    total = np.zeros(len(vectors))
    for i in range(vectors.shape[1]):
        total += vectors[:, i] * query[i]
    return total


def _top(vectors: np.ndarray, query: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best and of all that rounding could have kept from being one of them."""
    scores = vectors @ query
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.partition(scores, -k)[-k]
    slack = 1e-12 * np.sqrt((vectors * vectors).sum(axis=1) * (query @ query))
    return np.flatnonzero(scores + slack >= least - slack.max())


def _search(options: BitCodes):
    def run(key, candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )
        if candidates.empty or queries.empty:
            return none
        dimension = len(candidates["vector"].iloc[0])
        turn = rotation(dimension, options.seed)
        vectors = np.stack(candidates["vector"].to_numpy()).astype(np.float64)
        asked = np.stack(queries["vector"].to_numpy()).astype(np.float64)
        ids, asked_ids = candidates["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
        codes = np.stack([np.frombuffer(c, np.uint8) for c in candidates["code"]])
        norms, correction = candidates["norm"].to_numpy(), candidates["correction"].to_numpy()
        out = []
        for start in range(0, len(asked), 64):
            some, some_ids = asked[start : start + 64], asked_ids[start : start + 64]
            guess, width = estimate(codes, norms, correction, some @ turn.T, dimension, options.epsilon)
            own = ids[None, :] == some_ids[:, None]
            low, high = guess - width, guess + width
            low[own] = high[own] = -np.inf
            # the k-th best of what is certain: whoever can't reach it needs no second look
            k = min(options.neighbours, low.shape[1])
            least = np.partition(low, -k, axis=1)[:, -k]
            maybe = (high >= least[:, None]) & ~own
            for n, query_id in enumerate(some_ids):
                picked = np.flatnonzero(maybe[n])
                picked = picked[_top(vectors[picked], some[n], options.neighbours)]
                scores = exact(vectors[picked], some[n])
                best = np.lexsort((ids[picked], -scores))[: options.neighbours]
                out.append((np.full(len(best), query_id), ids[picked][best], scores[best]))
        columns = [np.concatenate(x) for x in zip(*out)]
        return pd.DataFrame(dict(zip(["query_id", "vec_id", "score"], columns)))

    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    picked = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return picked.filter(
        F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0)
    )


def index(vectors: DataFrame, options: BitCodes = BitCodes(), id_col: str = "vec_id", vector_col: str = "embedding"):
    """Every usable row with its code: vec_id, vector, dimension, code, norm, correction. No shuffle."""
    small_batches(vectors.sparkSession, 4096)
    rows = usable(vectors, id_col, vector_col).withColumn("dimension", F.size("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            dimensions = batch.column("dimension").to_numpy()
            for dimension in np.unique(dimensions).tolist():
                part = batch.filter(pa.array(dimensions == dimension))
                values = part.column("vector").flatten().to_numpy().reshape(-1, dimension)
                turn = turns.setdefault(dimension, rotation(dimension, options.seed))
                codes, norms, correction = encode(values, turn)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("vec_id", "vector", "dimension")),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(norms),
                        pa.array(correction),
                    ],
                    ["vec_id", "vector", "dimension", "code", "norm", "correction"],
                )

    return rows.mapInArrow(
        run, "vec_id long, vector array<double>, dimension int, code binary, norm double, correction double"
    )


def nearest(
    vectors: DataFrame, options: BitCodes = BitCodes(), id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows of every row whose id is divisible by 20, by inner product.

    Both sides are dealt to blocks by a hash of their id, and each pair of a candidate block and a query block is a
    cell, searched by one task. Each cell returns at most `neighbours` rows a query, and the cells' lists are merged.
    A cell always holds about as many rows, whatever the size of the table.

    Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows
    without an id; vectors of different lengths are never compared; fewer candidates than asked for are all returned;
    ties go to the smaller id; a repeated id is one more candidate, and as a query is asked once, with its
    least vector; other columns are
    not looked at; an empty table gives an empty table.
    """
    coded = index(vectors, options, id_col, vector_col)
    asked = usable(vectors, id_col, vector_col)
    asked = asked.filter(F.col("vec_id") % 20 == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = asked.withColumn("dimension", F.size("vector"))
    # the number of blocks follows the table; both counts are single numbers
    n = usable(vectors, id_col, vector_col).agg(
        F.count(F.lit(1)), F.count(F.when(F.col("vec_id") % 20 == 0, 1))
    ).first()
    blocks, query_blocks = -(-max(n[0], 1) // options.candidate_block), -(-max(n[1], 1) // options.query_block)
    candidate = coded.withColumn(
        "block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    ).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    query = asked.withColumn("query_block", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    cell = ["dimension", "block", "query_block"]
    found = candidate.groupBy(*cell).cogroup(query.groupBy(*cell)).applyInPandas(
        _search(options), "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= options.neighbours)
    return ranked.select("query_id", "rank", "vec_id", "score")
