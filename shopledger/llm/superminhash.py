"""Near-duplicates by SuperMinHash signatures: banding, verification on full sets, union-find grouping.

SuperMinHash gives each element of a set a random permutation of the signature's slots and a random fraction for every
step; what the element says about the slot in place j of its permutation is j plus the fraction of step j. A slot keeps
the least that any element says. So each element takes each rank once, which makes slots negatively correlated and the
share of equal slots a better estimate of similarity than independent minima are. No element can say less than j in
step j, so the steps end for a set once all of its slots hold less than that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.llm.components import components
from shopledger.llm.shards import answers
from shopledger.llm.tables import small_batches, written

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
UNSET = np.uint64((1 << 64) - 1)
LOW = np.uint64((1 << 32) - 1)


@dataclass(frozen=True)
class Linking:
    """Sets link where 100 * intersection >= percent * union.

    Two sets of similarity s share a band with a chance of 1 - (1 - s^rows)^bands, which for 32 bands of 5 rows is
    0.999997 at 0.8. All pairs that share one are decided by their full sets. `cell_sets` and `cell_shingles` bound
    what a task holds at a time; up to `broadcast_keys` keys are sent to every task, more are joined by a shuffle.
    """

    shingle: int = 2
    percent: int = 80
    bands: int = 32
    rows: int = 5
    cell_sets: int = 1024
    cell_shingles: int = 1 << 20
    broadcast_keys: int = 1_000_000
    seed: int = 42

    @property
    def slots(self) -> int:
        return self.bands * self.rows


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit number of each (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, width: int, seed: int) -> np.ndarray:
    """Sorted hashes of the different shingles of a UTF-8 text; those of its whole sequence if that is shorter."""
    words = text.lower().split() if text else []  # of bytes: A-Z only, and space and 0x09 to 0x0D only
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width_here = min(width, len(words))
    # a number for the length keeps a short sequence apart from the start of a longer one
    total = np.full(len(words) - width_here + 1, seed * 1_000_003 + width_here, np.uint64)
    for k in range(width_here):
        total = mixed(total * GOLDEN + each[k : len(words) - width_here + 1 + k])
    return np.unique(total)


def signatures(hashes: np.ndarray, owners: np.ndarray, sets: int, slots: int) -> np.ndarray:
    """The SuperMinHash signatures, (sets, slots): step number in the upper half, fraction in the lower.

    `owners` says which set a hash belongs to, in ascending order. All elements of all sets take a step together, and
    sets that are done drop out. Sets without elements keep unset slots.
    """
    out = np.full((sets, slots), UNSET, np.uint64)
    flat = out.reshape(-1)
    kind = np.uint8 if slots <= 256 else np.uint16
    turn: np.ndarray | None = None  # each element's permutation so far, from the second step on
    for step in range(slots):
        draw = mixed(hashes + np.uint64((step + 1) * int(GOLDEN) & int(UNSET)))
        at = step + (((draw >> np.uint64(32)) * np.uint64(slots - step)) >> np.uint64(32)).astype(np.int64)
        if turn is None:
            slot = at
        else:
            rows = np.arange(len(at))
            slot = turn[rows, at].astype(np.int64)
            turn[rows, at] = turn[rows, step]
        np.minimum.at(flat, owners * slots + slot, (np.uint64(step) << np.uint64(32)) | (draw & LOW))
        ends = np.flatnonzero(np.append(owners[1:] != owners[:-1], True)) if len(owners) else np.empty(0, np.int64)
        left = owners[ends]  # the sets still at work
        done = out[left].max(axis=1, initial=0) < (np.uint64(step + 1) << np.uint64(32))
        if not done.all() and turn is None:
            keep = np.repeat(~done, np.diff(ends, prepend=-1))
            hashes, owners, at = hashes[keep], owners[keep], at[keep]
            turn = np.tile(np.arange(slots, dtype=kind), (len(hashes), 1))
            turn[np.arange(len(at)), at] = 0
        elif done.all():
            break
        elif done.any():
            keep = np.repeat(~done, np.diff(ends, prepend=-1))
            hashes, owners, turn = hashes[keep], owners[keep], turn[keep]
    return out


def signed_sets(docs: DataFrame, id_col: str, text_col: str, options: Linking) -> DataFrame:
    """For every row: doc_id, its number, n_shingles, 128 bits that tell its set (d1, d2) and its text (t1, t2), and a
    key for every band. No shuffle."""
    small_batches(docs.sparkSession)
    text = F.col(f"`{text_col}`").cast("binary")
    picked = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), *_text_keys(text))
    schema = "doc_id long, n_shingles long, d1 long, d2 long, t1 long, t2 long, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, options.shingle, options.seed) for t in batch.column("text").to_pylist()]
            sizes = np.array([len(s) for s in sets], np.int64)
            slots = _signed(sets, sizes, options.slots)
            keys = np.tile(np.arange(options.bands, dtype=np.uint64), (len(sets), 1))
            for k in range(options.rows):
                keys = mixed(keys * GOLDEN + slots[:, k :: options.rows])
            digests = [xxhash.xxh128_intdigest(s.tobytes()) for s in sets]
            halves = np.array([[d >> 64, d & ((1 << 64) - 1)] for d in digests], np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    batch.column("t1"),
                    batch.column("t2"),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(sets) + 1, dtype=np.int32) * options.bands),
                        pa.array(keys.view(np.int64).reshape(-1)),
                    ),
                ],
                ["doc_id", "n_shingles", "d1", "d2", "t1", "t2", "bands"],
            )

    return picked.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


def _signed(sets: list[np.ndarray], sizes: np.ndarray, slots: int, elements: int = 1 << 17) -> np.ndarray:
    """Signatures of sets taken together while they have no more than so many elements, or are one set."""
    out, start = [], 0
    while start < len(sets):
        end = max(start + 1, int(np.searchsorted(np.cumsum(sizes[start:]), elements, "right")) + start)
        some = sets[start:end]
        out.append(signatures(np.concatenate(some), np.repeat(np.arange(end - start), sizes[start:end]), end - start, slots))
        start = end
    return np.concatenate(out) if out else np.empty((0, slots), np.uint64)


def _text_keys(text) -> list:
    """128 bits that tell a text, found without Python."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def full_sets(docs: DataFrame, wanted: DataFrame, text_col: str, options: Linking) -> DataFrame:
    """(node, n, shingles) for the nodes of `wanted` (node, n, t1, t2), read again from the texts. Copies of a text are
    one before it is cut up."""
    text = F.col(f"`{text_col}`").cast("binary")
    keyed = docs.filter(text.isNotNull()).select(text.alias("text"), *_text_keys(text))
    keys = wanted.select("t1").distinct()
    if wanted.count() <= options.broadcast_keys:
        keys = F.broadcast(keys)
    texts = keyed.join(keys, "t1", "left_semi").groupBy("t1", "t2").agg(F.min("text").alias("text"))
    found = texts.join(wanted, ["t1", "t2"]).select("node", "n", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, options.shingle, options.seed) for t in batch.column("text").to_pylist()]
            shingles = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            columns = [batch.column("node"), batch.column("n"), shingles]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "shingles"])

    return found.mapInArrow(run, "node long, n long, shingles array<long>")


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of a batch, and how many each row has."""
    column = batch.column("shingles")
    return column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)


class _Cell:
    """Some sets of a group as an index from shingle to sets; sources that come by are linked to them.

    A source is compared with all of them by counting common shingles. Of its links only those are returned that join
    two parts not known to hang together, so a cell returns fewer links than it has met sets.
    """

    SCHEMA = "a long, b long"

    def __init__(self, options: Linking):
        self.options = options
        self.batches: list[pa.RecordBatch] = []
        self.joined: dict[int, int] = {}

    def add(self, rows: pa.RecordBatch) -> None:
        self.batches.append(rows)

    def _top(self, root: int) -> int:
        while root in self.joined:
            root = self.joined[root]
        return root

    def _built(self) -> bool:
        if self.batches:
            shingles, sizes = (np.concatenate(x) for x in zip(*map(_lists, self.batches)))
            self.nodes, self.roots = (
                np.concatenate([b.column(c).to_numpy() for b in self.batches]) for c in ("node", "root")
            )
            self.sizes = sizes.astype(np.int64)
            owners = np.repeat(np.arange(len(sizes)), sizes)
            order = np.argsort(shingles, kind="stable")
            self.owners = owners[order]
            self.known, starts = np.unique(shingles[order], return_index=True)
            self.starts = np.append(starts, len(shingles))
            self.batches = []
        return hasattr(self, "nodes")

    def _common(self, shingles: np.ndarray) -> np.ndarray:
        """For every set of the cell, how many of these shingles it has."""
        at = np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)
        at = at[self.known[at] == shingles]
        starts, counts = self.starts[at], self.starts[at + 1] - self.starts[at]
        before = np.cumsum(counts) - counts
        places = np.repeat(starts - before, counts) + np.arange(counts.sum())
        return np.bincount(self.owners[places], minlength=len(self.nodes))

    def answer(self, questions: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not self._built():
            return
        shingles, sizes = _lists(questions)
        ends = np.cumsum(sizes)
        found = []
        nodes, roots = (questions.column(c).to_pylist() for c in ("node", "root"))
        for node, root, start, end in zip(nodes, roots, (ends - sizes).tolist(), ends.tolist()):
            root = self._top(root)
            other = self.roots != root
            if not other.any():
                continue
            common = self._common(shingles[start:end])
            alike = 100 * common >= self.options.percent * (self.sizes + (end - start) - common)
            while (places := np.flatnonzero(alike & (self.roots != root))).size:
                found.append((node, int(self.nodes[places[0]])))
                other_root = int(self.roots[places[0]])
                self.joined[root] = other_root
                self.roots[self.roots == root] = other_root
                root = other_root
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])


def links_of(targets: DataFrame, sources: DataFrame, sets: DataFrame, options: Linking) -> DataFrame:
    """Links (a, b) that connect sources with the targets of their groups as far as links between them do.

    Both have group, node and root. A group's targets are dealt to cells of bounded size, by number and by shingles;
    its sources pass by every cell of it. Pairs of one root are left out.
    """
    load = targets.join(sets.select("node", "n"), "node").groupBy("group").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / options.cell_sets), F.ceil(F.sum("n") / options.cell_shingles)
        ).cast("int").alias("cells")
    )
    cell = F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")
    columns = ["group", "shard", "node", "root", "shingles"]
    held = targets.join(load, "group").withColumn("shard", cell)
    asked = sources.join(load, "group").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    held, asked = (x.join(sets, "node").select(*columns) for x in (held, asked))
    return answers(held, asked, None, lambda: _Cell(options), _Cell.SCHEMA, ["group"])


def linked_nodes(spark: SparkSession, docs: DataFrame, nodes: DataFrame, text_col: str, options: Linking) -> DataFrame:
    """(node, root) of the nodes that have a link. `nodes`: node, n, t1, t2, bands, stored.

    A bucket's hub is its least node, and a node's home the least hub of its buckets. First every node is compared with
    its home, which makes one component of most of a large group; then those left over with all nodes of their home;
    at last those left over in a bucket with all nodes of the other homes in it. So any two nodes that share a bucket
    are in one component, or have been compared; and a node's set is sent once to its home, and as a source once to
    every other home that it has to be compared with.
    """
    keys = nodes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("node").alias("hub"))
    placed = written(spark, keys.join(shared.filter("rows > 1").drop("rows"), "key"), "buckets")
    homes = written(spark, placed.groupBy("node").agg(F.min("hub").alias("group")), "homes")
    wanted = nodes.select("node", "n", "t1", "t2").join(homes.select("node"), "node")
    sets = written(spark, full_sets(docs, wanted, text_col, options), "sets")

    alone = homes.withColumn("root", F.col("node"))
    hubs = homes.select(F.col("group").alias("node")).distinct().select("node", "node", "node").toDF("group", "node", "root")
    links = written(spark, links_of(alone.filter("node <> group"), hubs, sets, options), "links")

    rooted = _rooted(homes, components(spark, links))
    minor = _minor(rooted, "group")
    held = rooted.join(minor.select("group").distinct(), "group", "left_semi")
    more = links_of(held, minor, sets, options)
    links = written(spark, links.unionByName(more), "links")

    rooted = written(spark, _rooted(homes, components(spark, links)), "rooted")
    left = _minor(placed.select("key", "node").join(rooted, "node"), "key")
    others = placed.select("key", "node").join(rooted.select("node", F.col("group").alias("home")), "node")
    others = others.select("key", "home").distinct()
    abroad = left.join(others, "key").filter("home <> group").select(F.col("home").alias("group"), "node", "root")
    abroad = written(spark, abroad.distinct(), "abroad")
    held = rooted.join(abroad.select("group").distinct(), "group", "left_semi")
    links = written(spark, links.unionByName(links_of(held, abroad, sets, options)), "links")
    return components(spark, links)


def _rooted(homes: DataFrame, roots: DataFrame) -> DataFrame:
    return homes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _minor(rooted: DataFrame, by: str) -> DataFrame:
    """The rows outside the most frequent root of their `by`."""
    counts = rooted.groupBy(by, "root").agg(F.count(F.lit(1)).alias("rows"))
    most = counts.groupBy(by).agg(F.max(F.struct("rows", "root")).alias("most"), F.count(F.lit(1)).alias("roots"))
    return rooted.join(most.filter("roots > 1"), by).filter("root <> most.root").drop("most", "roots")


def superminhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", options: Linking = Linking()
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row: near-duplicates by the similarity of shingle sets.

    Equal sets are one node from the start, so copies cost a count and not pairs. Every two nodes that share a band are
    decided by their full sets, unless links already connect them; texts are read a second time for the sets of nodes
    that share a band with another.

    Defined cases: a text that is null, empty or has no words has 0 shingles and is linked with nothing; fewer words
    than the shingle length make one shingle; a missing id takes part but names no component unless all ids of its
    component are missing; repeated rows each get their row; other columns are not looked at; an empty table gives an
    empty table.
    """
    spark: SparkSession = docs.sparkSession
    rows = written(spark, signed_sets(docs, id_col, text_col, options), "superminhash")
    worded = rows.filter("n_shingles > 0")
    least = F.min(F.struct("row", "n_shingles", "t1", "t2", "bands")).alias("of")
    nodes = worded.groupBy("d1", "d2").agg(least, F.min("doc_id").alias("least_id"))
    nodes = nodes.select("d1", "d2", "least_id", F.col("of.row").alias("node"), F.col("of.n_shingles").alias("n"), "of.*")
    nodes = written(spark, nodes.drop("row", "n_shingles"), "nodes")
    roots = linked_nodes(spark, docs, nodes, text_col, options)
    rooted = nodes.select("d1", "d2", "node", "least_id").join(roots, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    names = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(names, "root").select("d1", "d2", "component_id")
    plain = rows.select("doc_id", "n_shingles", "d1", "d2")
    found = plain.filter("n_shingles > 0").join(named, ["d1", "d2"]).select("doc_id", "n_shingles", "component_id")
    alone = plain.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
