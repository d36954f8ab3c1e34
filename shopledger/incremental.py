"""Rebuilding only what has changed: datasets, what they are built from, and one snapshot of the result.

Building a dataset's plan tells which raw tables, datasets and date its definition asks for. A stored table carries the
versions of these that it was built from, so it is stale exactly if one of them now has another version, whatever has
happened in between. Tables are brought up to date in topological order; one whose rebuilt rows are the old ones keeps
its version, and what is built from it stays as it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from graphlib import TopologicalSorter
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.lakehouse import AS_OF, DATASETS, Lakehouse
from shopledger.sources.snapshots import Build, Snapshot, SnapshotStore, TableVersion
from shopledger.sources.writer import Buckets

RAW = "bronze."
UNKNOWN = "unknown"


@dataclass(frozen=True)
class Refreshed:
    """`stale`: the inputs whose version had changed, None for a table that was built for the first time.
    `rebuilt`: its definition ran; `changed`: and gave other rows than before."""

    name: str
    rebuilt: bool
    changed: bool
    stale: tuple[str, ...] | None = ()


def dependencies(lake: Lakehouse, names: Iterable[str]) -> dict[str, set[str]]:
    """For `names` and all datasets they are built from: what each asks for directly. Plans are made, no job runs but
    those that opening the raw tables takes."""
    planning = lake.fresh()
    found: dict[str, set[str]] = {}
    left = list(names)
    while left:
        name = left.pop()
        if name not in found:
            planning.table(name)
            found[name] = planning.inputs(name)
            left += [x for x in found[name] if x in DATASETS]
    return found


def waves(edges: Mapping[str, set[str]]) -> Iterator[list[str]]:
    """The datasets in groups, each after all that it is built from; a cycle is an error that names it."""
    order = TopologicalSorter(edges)
    order.prepare()
    while order.is_active():
        ready = order.get_ready()
        yield [name for name in ready if name in edges]
        order.done(*ready)


def build_order(edges: Mapping[str, set[str]]) -> list[str]:
    return [name for wave in waves(edges) for name in wave]


def descendants(edges: Mapping[str, set[str]], changed: Iterable[str]) -> set[str]:
    """The datasets that are built from any of `changed`, directly or not."""
    reached = set(changed)
    for name in build_order(edges):
        if edges[name] & reached:
            reached.add(name)
    return reached & set(edges)


def files_version(df: DataFrame) -> str:
    """A mark of the files that `df` reads: it changes when one is added, removed, replaced or written again.

    Files are listed by Spark and summed up in tasks; the driver holds their names and gets one row. Rows that come
    from no file have no mark, so they count as changed every time.
    """
    files = df.inputFiles()
    if not files:
        return UNKNOWN
    listed = df.sparkSession.read.format("binaryFile").load([unquote(f) for f in files]).select("path", "length", "modificationTime")
    each = F.xxhash64("path", "length", "modificationTime")
    row = listed.agg(F.count(F.lit(1)), F.bit_xor(each), F.sum(each.cast("decimal(20,0)"))).first()
    return ":".join(str(x) for x in row)


class _Versions:
    """The versions that things have while a refresh goes on; those of views are made of their inputs'."""

    def __init__(self, lake: Lakehouse, edges: Mapping[str, set[str]], raw: Callable[[str], str] | None):
        self._lake = lake
        self._edges = edges
        self._raw = raw
        self._known: dict[str, str] = {}

    def put(self, name: str, version: str) -> None:
        self._known[name] = version

    def inputs(self, name: str) -> dict[str, str]:
        return {x: self.of(x) for x in sorted(self._edges[name])}

    def of(self, name: str) -> str:
        if name not in self._known:
            self._known[name] = self._find(name)
        return self._known[name]

    def _find(self, name: str) -> str:
        if name == AS_OF:
            return self._lake.as_of.isoformat()
        if name.startswith(RAW):
            table = name.removeprefix(RAW)
            return self._raw(table) if self._raw else files_version(self._lake.raw(table))
        inputs = self.inputs(name)
        if UNKNOWN in inputs.values():
            return UNKNOWN
        return hashlib.sha256(repr(sorted(inputs.items())).encode()).hexdigest()[:16]


def refresh(
    lake: Lakehouse,
    store: SnapshotStore,
    names: Iterable[str],
    raw_version: Callable[[str], str] | None = None,
    again: Iterable[str] = (),
    prepare: Callable[[str, DataFrame], DataFrame] | None = None,
    together: int = 4,
    laid_out: Mapping[str, Buckets] | None = None,
) -> tuple[Snapshot, list[Refreshed]]:
    """Bring the stored datasets `names` up to date in one snapshot, and say what was done to each, in build order.

    Datasets that are not among `names` are views: plans inside those that are. `raw_version` gives the version of a
    raw table; without it that is a mark of its files. `again` rebuilds datasets whose definition has changed, which no
    version shows. ``prepare(name, df)`` may attach something to the rows on their way, such as expectations. Up to
    `together` tables that don't depend on each other are written at the same time. `laid_out` names datasets to be stored
    in buckets of a key that their plan lays them out by, or their inputs' buckets do.

    Names from earlier snapshots that are not among `names` leave the snapshot, as nothing keeps them up to date. If
    anything fails, the last snapshot stays the last.
    """
    names, again = list(dict.fromkeys(names)), set(again)
    edges = dependencies(lake, names)
    reading = lake.fresh()
    versions = _Versions(reading, edges, raw_version)
    done: list[Refreshed] = []
    build: Build = store.begin()
    with build, ThreadPoolExecutor(together) as pool:
        for wave in waves(edges):
            tasks = []
            for name in (x for x in wave if x in names):
                inputs = versions.inputs(name)
                stale = _stale(build.tables.get(name), inputs)
                if stale == () and name not in again:
                    done.append(Refreshed(name, False, False))
                    continue
                finish = partial(prepare, name) if prepare else None
                rows = reading.define(name)
                layout = {"sort_by": DATASETS[name].sort_by, "laid_out": (laid_out or {}).get(name)}
                written = pool.submit(build.write, name, rows, inputs, finish=finish, **layout)
                tasks.append((name, stale, written))
            done += [Refreshed(name, True, written.result(), stale) for name, stale, written in tasks]
            for name in (x for x in wave if x in names):
                reading.keep(name, build.table(name))
                versions.put(name, build.tables[name].folder)
        for name in set(build.tables) - set(names):
            build.remove(name)
    return build.published, done


def _stale(before: TableVersion | None, inputs: Mapping[str, str]) -> tuple[str, ...] | None:
    """The inputs that came, went or changed since the version before; None if there is none."""
    if before is None:
        return None
    either = sorted({*before.inputs, *inputs})
    return tuple(k for k in either if before.inputs.get(k) != inputs.get(k) or inputs.get(k) == UNKNOWN)


def opened(lake: Lakehouse, snapshot: Snapshot) -> Lakehouse:
    """A lakehouse whose datasets are those of one snapshot; what isn't in it is computed from what is."""
    pinned = lake.fresh()
    for name in snapshot.tables:
        pinned.keep(name, snapshot.table(name))
    return pinned
