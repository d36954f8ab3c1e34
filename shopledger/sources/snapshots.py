"""One snapshot over many tables: readers see all tables of a build, or none of them.

A snapshot is a small file that names one version of every table, with what that version was built from. A build
writes new versions beside the old ones and publishes the next snapshot in one step at its end; until then nobody sees
its tables, and a build that fails leaves the last snapshot as it was. A reader holds on to one snapshot: what it reads
stays the same, and of the same build, however many builds follow, until that snapshot expires.

Snapshots are numbered. Publishing is a rename that fails where the number is taken, so of two builds that started from
the same snapshot only the first is published.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.session import shuffles_released
from shopledger.sources.writer import Buckets, Folder, enter, file_options

LOG = "_snapshots"


class Conflict(RuntimeError):
    """Another build was published first."""


@dataclass(frozen=True)
class TableVersion:
    """`folder` is relative to the root. `inputs` says which version of what the table was built from. `content` is a
    sum of hashes of the rows, equal for equal rows in any order. Its files are in `buckets` by the hash of `bucket_key`, if any."""

    folder: str
    schema: str
    rows: int
    content: str
    inputs: Mapping[str, str] = field(default_factory=dict)
    bucket_key: str = ""
    buckets: int = 0


class Snapshot:
    """Tables of one build, by name."""

    def __init__(self, spark: SparkSession, root: str, number: int, tables: Mapping[str, TableVersion]):
        self._spark = spark
        self._root = root
        self.number = number
        self.tables = dict(tables)

    def table(self, name: str) -> DataFrame:
        """Opened without reading a footer: the snapshot has the schema."""
        found = self.tables[name]
        schema = T.StructType.fromJson(json.loads(found.schema))
        if found.buckets:
            return Buckets(found.bucket_key, found.buckets).open(self._spark, schema, self.path(name))
        return self._spark.read.schema(schema).parquet(self.path(name))

    def path(self, name: str) -> str:
        """The folder of the table's version."""
        return f"{self._root}/{self.tables[name].folder}"

    def enter(self, names: Mapping[str, str]) -> None:
        """Name tables in the session catalogue: table -> catalogue name. Each name then means this snapshot's version."""
        for name, entered in names.items():
            enter(self._spark, self.path(name), entered)


class Build:
    """New versions on their way into the next snapshot. As a context manager it is published at the end, or given up
    if an error leaves the block."""

    def __init__(self, store: "SnapshotStore", base: Snapshot):
        self._store = store
        self.base = base
        self.tables = dict(base.tables)
        self.published: Snapshot | None = None
        self._written: list[str] = []

    def write(
        self,
        name: str,
        df: DataFrame,
        inputs: Mapping[str, str] | None = None,
        cluster_by: Sequence[str] = (),
        partition_by: Sequence[str] = (),
        finish: Callable[[DataFrame], DataFrame] | None = None,
        sort_by: Sequence[str] = (),
        laid_out: Buckets | None = None,
    ) -> bool:
        """Write a new version of a table; False if its rows are those of the version before, which then stays.

        Rows are counted and summed up by the tasks that write them, after any exchange that clustering needs, so a
        task or executor that is lost and run again counts once. ``finish`` is applied there too, and ``sort_by`` orders
        the rows of each task. ``laid_out`` buckets rows that their plan has laid out by a key.
        """
        folder = f"{name}/version-{uuid.uuid4().hex}"
        if cluster_by:
            df = df.hint("rebalance", *cluster_by)
        if sort_by:
            df = df.sortWithinPartitions(*sort_by)
        if finish:
            df = finish(df)
        seen = Observation()
        # of a row and of its number in a fixed range: no overflow, and a row twice doesn't cancel out
        hashed = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        observed = df.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.sum(hashed.cast("decimal(20,0)")).alias("total"),
            F.bit_xor(hashed).alias("mixed"),
        )
        self._written.append(folder)
        writer = observed.write.options(**file_options(df.schema))
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        spark, path = self._store.spark, f"{self._store.root}/{folder}"
        with shuffles_released(spark):
            if laid_out:
                laid_out.write(observed, path)
            else:
                writer.parquet(path)
        found = seen.get
        content = f"{found['total']}:{found['mixed']}"
        layout = {"bucket_key": laid_out.key, "buckets": laid_out.n} if laid_out else {}
        made = TableVersion(folder, df.schema.json(), found["rows"], content, dict(inputs or {}), **layout)
        before = self.tables.get(name)
        same = before is not None and (before.schema, before.rows, before.content) == (made.schema, made.rows, content)
        if same:
            self._drop(folder)
            made = replace(before, inputs=made.inputs)
        self.tables[name] = made
        return not same

    def table(self, name: str) -> DataFrame:
        """A table as it stands in this build."""
        return Snapshot(self._store.spark, self._store.root, self.base.number, self.tables).table(name)

    def remove(self, name: str) -> None:
        """The next snapshot has no such table."""
        self.tables.pop(name, None)

    def publish(self) -> Snapshot:
        """The next snapshot, or the last one if nothing has changed."""
        if self.tables == self.base.tables:
            return self.base
        number = self.base.number + 1
        text = json.dumps({name: asdict(found) for name, found in self.tables.items()}, sort_keys=True)
        if not self._store.log.publish(_file(number), text):
            self.give_up()
            raise Conflict(f"snapshot {number} was published by another build")
        return Snapshot(self._store.spark, self._store.root, number, self.tables)

    def give_up(self) -> None:
        """Remove what was written."""
        for folder in list(self._written):
            self._drop(folder)

    def _drop(self, folder: str) -> None:
        self._store.folder.drop(folder)
        self._written.remove(folder)

    def __enter__(self) -> "Build":
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.published = self.publish()
        else:
            self.give_up()


def _file(number: int) -> str:
    return f"{number:012d}.json"


class SnapshotStore:
    """The tables under one folder, and the snapshots over them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.folder = Folder(spark, self.root)
        self.log = Folder(spark, f"{self.root}/{LOG}")

    def numbers(self) -> list[int]:
        """Of the snapshots that haven't expired, oldest first."""
        names = self.log.files()
        return sorted(int(name.removesuffix(".json")) for name in names if name.removesuffix(".json").isdigit())

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The last snapshot or the one of that number; before the first build an empty one of number 0."""
        known = self.numbers()
        if number is None:
            number = known[-1] if known else 0
            if not number:
                return Snapshot(self.spark, self.root, 0, {})
        if number not in known:
            raise FileNotFoundError(f"no snapshot {number} at {self.root}")
        tables = {name: TableVersion(**found) for name, found in json.loads(self.log.text(_file(number))).items()}
        return Snapshot(self.spark, self.root, number, tables)

    def begin(self) -> Build:
        return Build(self, self.snapshot())

    def expire(self, keep: int = 2, hold: Iterable[int] = ()) -> list[int]:
        """Remove all snapshots but the last `keep` and those in `hold`, and the versions that only they name.

        Versions that no snapshot ever named belong to builds at work, or to lost ones: see `sweep`.
        """
        numbers = self.numbers()
        stay = set(numbers[max(0, len(numbers) - keep) :]) | set(hold)
        gone = [n for n in numbers if n not in stay]
        named = {v.folder for n in numbers if n in stay for v in self.snapshot(n).tables.values()}
        old = {v.folder for n in gone for v in self.snapshot(n).tables.values()}
        # the snapshots go first, so no reader finds one whose versions are missing
        for n in gone:
            self.log.drop(_file(n))
        for folder in sorted(old - named):
            self.folder.drop(folder)
        return gone

    def sweep(self, older_than_s: float) -> list[str]:
        """Remove versions that no snapshot names and that were begun longer ago than any build takes."""
        named = {v.folder for n in self.numbers() for v in self.snapshot(n).tables.values()}
        lost = []
        for name in self.folder.versions():
            if name != LOG:
                inside = Folder(self.spark, f"{self.root}/{name}")
                lost += [f"{name}/{v}" for v in inside.versions(older_than_s) if f"{name}/{v}" not in named]
        for folder in lost:
            self.folder.drop(folder)
        return lost
