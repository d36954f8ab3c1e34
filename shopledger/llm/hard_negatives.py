"""Hard negatives by an inverted multi-index: cells of two half-space codebooks, visited best bound first.

A vector is cut into two halves, and each half belongs to the nearest centroid of that half's codebook; a pair of
centroids is a cell. For an anchor (a1, a2) no row of cell (i, j) scores more than u_i + v_j, where
u_i = <a1, c_i> + |a1| * r_i and r_i is the largest distance of a half from its centroid; v_j likewise. With both lists
sorted, a heap (the multi-sequence algorithm) yields the cells by falling bound without looking at all of them, and a
search ends as soon as no cell left can change what it has found.

Rows are dealt to shards of bounded size by a hash of their id. Each shard has codebooks of its own, fitted on at most
`sample` of its rows, and an index over all of its rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.shards import answers, asked_of_all, dealt


@dataclass(frozen=True)
class Mining:
    """A negative qualifies if least * positive_score <= 100 * negative_score <= most * positive_score."""

    positives: int = 5
    negatives: int = 10
    least: int = 30
    most: int = 90
    scale: int = 256
    shard_rows: int = 16_384
    centroids: int = 16
    sample: int = 2048
    rounds: int = 6
    visit: int = 512


#: Scaled components lie within this, so that scores of up to 32,768 components fit 64 bits.
LARGEST = 1 << 24


def nearest_centroid(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids * centroids).sum(axis=1) - 2 * (points @ centroids.T)).argmin(axis=1)


def codebook(points: np.ndarray, options: Mining) -> np.ndarray:
    """Centroids by Lloyd's rounds on an evenly spaced sample of the points."""
    some = points[:: -(-len(points) // options.sample)]
    centroids = some[:: -(-len(some) // options.centroids)].copy()
    for _ in range(options.rounds):
        own = nearest_centroid(some, centroids)
        counts = np.bincount(own, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, some)
        centroids[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centroids


class MultiIndex:
    """Rows (id, label, whole-number vector) of one shard by cell."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, options: Mining = Mining()):
        half = (vectors.shape[1] + 1) // 2
        self.halves = (slice(0, half), slice(half, None))
        cell = np.zeros(len(ids), np.int64)
        self.books, self.radii = [], []
        for part in self.halves:
            points = vectors[:, part].astype(np.float64)
            book = codebook(points, options)
            own = nearest_centroid(points, book)
            away = np.sqrt(((points - book[own]) ** 2).sum(axis=1))
            radius = np.full(len(book), -np.inf)
            np.maximum.at(radius, own, away)
            used = radius >= 0
            self.books.append(book[used])
            self.radii.append(radius[used])
            cell = cell * used.sum() + (np.cumsum(used) - 1)[own]
        order = np.lexsort((ids, cell))
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        n_cells = len(self.books[0]) * len(self.books[1])
        self.starts = np.searchsorted(cell[order], np.arange(n_cells + 1)).tolist()
        largest = float(np.abs(vectors).max(initial=0))
        # whole numbers below 2^53 are exact in floating point, whose matrix product is the faster
        self.exact = largest * LARGEST * max(vectors.shape[1], 1) < 2**53
        self.floats = self.vectors.astype(np.float64) if self.exact else None

    def scores(self, anchor: np.ndarray, start: int, end: int) -> np.ndarray:
        if self.exact:
            return (self.floats[start:end] @ anchor.astype(np.float64)).astype(np.int64)
        return self.vectors[start:end] @ anchor

    def cells(self, anchor: np.ndarray) -> Iterator[tuple[float, float, int, int]]:
        """(most, least, start, end) of every cell with rows: what bounds its scores, and its rows; by falling `most`."""
        sides = []
        for part, book, radii in zip(self.halves, self.books, self.radii):
            asked = anchor[part].astype(np.float64)
            middle, reach = book @ asked, np.sqrt(asked @ asked) * radii
            slack = 1e-9 * (np.abs(middle) + reach) + 1e-6
            order = np.argsort(-(middle + reach + slack), kind="stable")
            sides.append(
                ((middle + reach + slack)[order].tolist(), (middle - reach - slack)[order].tolist(), order.tolist())
            )
        (most_u, least_u, at_u), (most_v, least_v, at_v) = sides
        heap = [(-(most_u[0] + most_v[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            # each pair is pushed once: along the row from its left neighbour, down the first column from above
            if j + 1 < len(at_v):
                heapq.heappush(heap, (-(most_u[i] + most_v[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(at_u):
                heapq.heappush(heap, (-(most_u[i + 1] + most_v[0]), i + 1, 0))
            place = at_u[i] * len(at_v) + at_v[j]
            start, end = self.starts[place], self.starts[place + 1]
            if start < end:
                yield -bound, least_u[i] + least_v[j], start, end

    def visits(self, anchor: np.ndarray, rows: int) -> Iterator[tuple[float, float, list[tuple[int, int]]]]:
        """Cells gathered to about `rows` rows: bound on all cells not given yet, least score, stretches of rows."""
        gathered, size, low = [], 0, np.inf
        for most, least, start, end in self.cells(anchor):
            if size >= rows:
                yield most, low, gathered
                gathered, size, low = [], 0, np.inf
            gathered.append((start, end))
            size, low = size + end - start, min(low, least)
        if gathered:
            yield -np.inf, low, gathered


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:n]
    return scores[order], ids[order]


def first_positives(index: MultiIndex, anchor_id: int, label: int, anchor: np.ndarray, options: Mining):
    """(scores, ids) of the anchor's first rows of its own label in this shard."""
    scores, ids = np.empty(0, np.int64), np.empty(0, np.int64)
    for rest, _, stretches in index.visits(anchor, options.visit):
        own = [np.flatnonzero(index.labels[s:e] == label) + s for s, e in stretches]
        found = np.concatenate([index.scores(anchor, s, e)[o - s] for (s, e), o in zip(stretches, own)])
        found_ids = index.ids[np.concatenate(own)]
        other = found_ids != anchor_id
        scores, ids = _best(
            np.concatenate([scores, found[other]]), np.concatenate([ids, found_ids[other]]), options.positives
        )
        if len(scores) == options.positives and scores[-1] > rest:
            break
    return scores, ids


def windows_of(positive_scores: np.ndarray, options: Mining) -> list[tuple[int, int]]:
    """For each positive the least and the largest score that a negative may have; none qualifies if least > largest."""
    return [(-(-options.least * p // 100), options.most * p // 100) for p in map(int, positive_scores)]


def first_negatives(
    index: MultiIndex, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], options: Mining
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every window (scores, ids) of the first rows of other labels in it, in this shard.

    A window is certified once it has all the rows it takes, the last of them above what any cell left can hold, or
    once no cell left reaches up to it.
    """
    none = (np.empty(0, np.int64), np.empty(0, np.int64))
    found = [none for _ in windows]
    open_ = [k for k, (low, high) in enumerate(windows) if low <= high]
    if not open_:
        return found
    for rest, least, stretches in index.visits(anchor, options.visit):
        # cells wholly above every window hold nothing for them
        if least <= max(windows[k][1] for k in open_):
            scores = np.concatenate([index.scores(anchor, s, e) for s, e in stretches])
            other = np.concatenate([index.labels[s:e] for s, e in stretches]) != label
            ids = np.concatenate([index.ids[s:e] for s, e in stretches])
            for k in open_:
                low, high = windows[k]
                inside = other & (scores >= low) & (scores <= high)
                if inside.any():
                    found[k] = _best(
                        np.concatenate([found[k][0], scores[inside]]),
                        np.concatenate([found[k][1], ids[inside]]),
                        options.negatives,
                    )
        open_ = [
            k
            for k in open_
            if rest >= windows[k][0] and (len(found[k][0]) < options.negatives or found[k][0][-1] <= rest)
        ]
        if not open_:
            break
    return found


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("vector")
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(len(column), len(values) // len(column))


class _Shard:
    """Collects the rows of a shard, then answers anchors from their index."""

    def __init__(self, options: Mining):
        self.options = options
        self.batches: list[pa.RecordBatch] = []
        self.index: MultiIndex | None = None

    def add(self, rows: pa.RecordBatch) -> None:
        self.batches.append(rows)

    def _built(self) -> MultiIndex | None:
        if self.batches:
            ids, labels = (np.concatenate([b.column(c).to_numpy() for b in self.batches]) for c in ("vec_id", "label"))
            self.index = MultiIndex(ids, labels, np.concatenate([_vectors(b) for b in self.batches]), self.options)
            self.batches = []
        return self.index


class PositiveShard(_Shard):
    SCHEMA = "anchor_id long, positive_id long, positive_score long"

    def answer(self, questions: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        index = self._built()
        if index is None:
            return
        out = []
        ids, labels = questions.column("vec_id").to_pylist(), questions.column("label").to_pylist()
        for anchor_id, label, anchor in zip(ids, labels, _vectors(questions)):
            scores, found = first_positives(index, anchor_id, label, anchor, self.options)
            out.append((np.full(len(found), anchor_id, np.int64), found, scores))
        columns = [pa.array(np.concatenate(c)) for c in zip(*out)]
        yield pa.RecordBatch.from_arrays(columns, ["anchor_id", "positive_id", "positive_score"])


class NegativeShard(_Shard):
    SCHEMA = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"

    def answer(self, questions: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        index = self._built()
        if index is None:
            return
        out = []
        ids, labels = questions.column("vec_id").to_pylist(), questions.column("label").to_pylist()
        positives = questions.column("positives").to_pylist()
        for anchor_id, label, anchor, own in zip(ids, labels, _vectors(questions), positives):
            windows = windows_of([p["positive_score"] for p in own], self.options)
            for p, (scores, found) in zip(own, first_negatives(index, label, anchor, windows, self.options)):
                same = [np.full(len(found), x, np.int64) for x in (anchor_id, p["positive_id"], p["positive_score"])]
                out.append((*same, found, scores))
        if out:
            columns = [pa.array(np.concatenate(c)) for c in zip(*out)]
            names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
            yield pa.RecordBatch.from_arrays(columns, names)


def labelled_rows(
    vectors: DataFrame, options: Mining, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(vec_id, label, vector of whole numbers, dimension) of the rows that take part, one for each id."""
    picked = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{label_col}`").cast("long").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    bound = float(LARGEST)
    whole = F.transform(
        "vector", lambda x: F.least(F.greatest(F.floor(x * float(options.scale)), F.lit(-bound)), F.lit(bound)).cast("int")
    )
    rows = picked.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite).select(
        "vec_id", F.struct("label", whole.alias("vector")).alias("row")
    )
    one = rows.groupBy("vec_id").agg(F.min("row").alias("row"))
    return one.select("vec_id", "row.label", "row.vector", F.size("row.vector").alias("dimension"))


def mine(rows: DataFrame, anchors: DataFrame, options: Mining = Mining()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and positive.

    `rows` and `anchors` have vec_id, label, vector and dimension, as `labelled_rows` gives them; anchors are some of
    the rows. Scores are inner products; an anchor's positives are its first other rows of the same label, and the
    negatives its first rows of other labels whose score lies in the positive's window. Ties go to the smaller id.

    Each of the two searches deals the rows once to shards of about `shard_rows` rows and sends every anchor to every
    shard; a shard returns at most `positives` rows an anchor, or `negatives` rows an anchor and positive.

    Defined cases: an anchor without positives, and a positive without a qualifying negative, have no rows; a positive
    with a negative score has none either, its window being empty; vectors of different lengths are never compared;
    empty vectors score 0; fewer rows than asked for are all returned; empty tables give an empty table.
    """
    # one number; the number of shards follows the table
    shards = max(1, -(-rows.count() // options.shard_rows))
    sharded = dealt(rows, shards, "vec_id")
    asked = asked_of_all(anchors, shards)
    within = ["dimension"]
    local = answers(sharded, asked, shards, lambda: PositiveShard(options), PositiveShard.SCHEMA, within)
    nearest = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    positives = (
        local.withColumn("nth", F.row_number().over(nearest))
        .filter(F.col("nth") <= options.positives)
        .groupBy(F.col("anchor_id").alias("vec_id"))
        .agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    )
    asked = asked_of_all(anchors.join(positives, "vec_id"), shards)
    local = answers(sharded, asked, shards, lambda: NegativeShard(options), NegativeShard.SCHEMA, within)
    hardest = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = local.withColumn("rank", F.row_number().over(hardest)).filter(F.col("rank") <= options.negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negatives(
    vectors: DataFrame,
    options: Mining = Mining(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    every: int = 100,
    relabel_every: int = 7,
    labels: int = 10,
) -> DataFrame:
    """`mine` over a table of vectors with labels; anchors are the rows whose id is divisible by `every`.

    Components x become floor(scale * x). Where the id is divisible by `relabel_every` (0: nowhere) the label first
    becomes (label + 1) % `labels`, which plants wrong labels for tests.

    Defined cases: rows without an id, a label or a vector, or with a null or non-finite component, take no part; of
    rows with one id the one with the least label, then the least vector, takes part; scaled components beyond 2^24 in
    size count as 2^24; other columns are not looked at; see also `mine`.
    """
    rows = labelled_rows(vectors, options, id_col, vector_col, label_col)
    if relabel_every:
        wrong = (F.col("label") + 1) % labels
        rows = rows.withColumn("label", F.when(F.col("vec_id") % relabel_every == 0, wrong).otherwise(F.col("label")))
    return mine(rows, rows.filter(F.col("vec_id") % every == 0), options)
