"""Named datasets over one set of raw tables.

A dataset is a function from a :class:`Lakehouse` to a lazy DataFrame; asking for it by name builds
its plan once.  Whether it stays a view or becomes a stored table is the caller's choice
(:meth:`Lakehouse.store`), and every later plan then reads the stored files.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession

from shopledger.session import app_dir, apply_runtime_defaults
from shopledger.sources.writer import Buckets, current_version, enter, write_table

LAYERS = ("bronze", "silver", "gold", "mart")
AS_OF = "as_of"


@dataclass(frozen=True)
class Dataset:
    name: str
    layer: str
    build: Callable[["Lakehouse"], DataFrame]
    order: Callable[[], list[Column]] | None = None
    sort_by: tuple[str, ...] = ()


DATASETS: dict[str, Dataset] = {}


def dataset(
    name: str, layer: str, order: Callable[[], list[Column]] | None = None, sort_by: Iterable[str] = ()
):
    """Register a dataset function; a name can be defined only once.

    ``order`` is for its readers; ``sort_by`` is how the rows of each task lie in the files, where it is stored.
    """

    def register(build):
        if name in DATASETS:
            raise ValueError(f"dataset {name!r} is already defined")
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        DATASETS[name] = Dataset(name, layer, build, order, tuple(sort_by))
        return build

    return register


class Lakehouse:
    """Raw tables plus the datasets defined over them.

    ``raw`` maps a raw table name to a DataFrame (a landing folder, the sample adapter, or a plain
    function).  ``as_of`` stands in for the current date, so a run can be repeated.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: Callable[[str], DataFrame],
        as_of: dt.date,
        root: str | None = None,
    ):
        self.spark = apply_runtime_defaults(spark)
        self._as_of = as_of
        self._raw = raw
        self._root = root
        self._run = uuid.uuid4().hex[:12]
        self._built: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}
        self._making: list[str] = []
        self._inputs: dict[str, set[str]] = {}

    @property
    def as_of(self) -> dt.date:
        self._asked_for(AS_OF)
        return self._as_of

    def raw(self, name: str) -> DataFrame:
        return self._memo(f"bronze.{name}", lambda: self._raw(name))

    def table(self, name: str) -> DataFrame:
        """The dataset as an unordered lazy DataFrame."""
        return self._memo(name, lambda: self.define(name))

    def define(self, name: str) -> DataFrame:
        """The dataset by its definition, whether or not it is stored; what the definition asks for is noted."""
        self._inputs[name] = set()
        self._making.append(name)
        try:
            return DATASETS[name].build(self)
        finally:
            self._making.pop()

    def inputs(self, name: str) -> set[str]:
        """What the dataset's definition has asked this lakehouse for: datasets, raw tables as ``bronze.x``, and
        ``as_of`` for the date. Empty before it was built."""
        return set(self._inputs.get(name, ()))

    def fresh(self) -> "Lakehouse":
        """Another lakehouse over the same raw tables and day, with nothing built or stored yet."""
        return Lakehouse(self.spark, self._raw, self._as_of, self._root)

    def with_tables(self, tables: Mapping[str, DataFrame]) -> "Lakehouse":
        """Another lakehouse with the same stored tables, but for these in their place."""
        other = self.fresh()
        for key, stored in {**self._stored, **tables}.items():
            other.keep(key, stored)
        return other

    def is_stored(self, name: str) -> bool:
        return name in self._stored

    def report(self, name: str) -> DataFrame:
        """The dataset in its presentation order."""
        order = DATASETS[name].order
        df = self.table(name)
        return df.orderBy(*order()) if order else df

    def names(self, layer: str) -> list[str]:
        return [d.name for d in DATASETS.values() if d.layer == layer]

    @property
    def root(self) -> str:
        """Where tables are stored: the given folder, or one of this run's own in the shared folder."""
        return self._root or f"{app_dir(self.spark)}/{self._run}"

    def path(self, name: str) -> str:
        layer = "bronze" if name.startswith("bronze.") else DATASETS[name].layer
        return f"{self.root}/{layer}/{name.removeprefix('bronze.')}"

    def store(
        self,
        names: Iterable[str],
        prepare: Callable[[str, DataFrame], DataFrame] | None = None,
        laid_out: Mapping[str, Buckets] | None = None,
    ) -> "Lakehouse":
        """Write datasets as Parquet tables; from then on their name means the stored table.

        Order matters only for speed: a table stored earlier is read, not recomputed, by the next.
        Storing a table again rebuilds it from its definition.  ``prepare(name, df)`` may attach
        something to the rows on their way, such as expectations.

        Rows are written as their definition lays them out.  ``gold_fact_sale`` comes from the join of
        lines and orders, so an order's lines share a file without another exchange of the widest rows
        there are, and a very long order, which the skew-join rule splits, is spread.  ``laid_out`` names those to
        be stored in buckets of a key that their plan, or their inputs' buckets, lay them out by.
        """
        for name in names:
            finish = partial(prepare, name) if prepare else None
            layout = {"sort_by": DATASETS[name].sort_by, "laid_out": (laid_out or {}).get(name)}
            self.keep(name, write_table(self.define(name), self.path(name), finish=finish, **layout))
        return self

    def store_raw(self, names: Iterable[str]) -> "Lakehouse":
        for name in names:
            key = f"bronze.{name}"
            self.keep(key, write_table(self._raw(name), self.path(key)))
        return self

    def keep(self, key: str, stored: DataFrame) -> None:
        """From now on the name means this stored table."""
        self._stored[key] = stored
        # Plans made before now would still compute this table, or read its replaced files.
        self._built.clear()

    def build(
        self, prepare: Callable[[str, DataFrame], DataFrame] | None = None, alternative: bool = False
    ) -> "Lakehouse":
        """Full rebuild of a family: every cleaned table, then every dimension and the order lines.

        The other facts are their cleaned tables under another name, so they are not written twice, and
        ``prepare`` does not see them.
        """
        suffix = "_alt" if alternative else ""
        family = {layer: [n for n in self.names(layer) if n.endswith("_alt") == alternative] for layer in LAYERS}
        self.store(family["silver"], prepare)
        copies = [n for n in family["gold"] if n.startswith("gold_fact") and n != f"gold_fact_sale{suffix}"]
        return self.store((name for name in family["gold"] if name not in copies), prepare)

    def standard(self, layer: str) -> list[str]:
        return [name for name in self.names(layer) if not name.endswith("_alt")]

    def create_views(self, layers: Iterable[str] = ("silver", "gold", "mart")) -> list[str]:
        """Temporary views for SQL users; marts come in presentation order."""
        made = []
        for layer in layers:
            for name in self.names(layer):
                self.report(name).createOrReplaceTempView(name)
                made.append(name)
        return made

    def enter_tables(self) -> list[str]:
        """Name every stored table in the catalogue, in the database of its layer, in place of the one before."""
        made = []
        for key in self._stored:
            layer = "bronze" if key.startswith("bronze.") else DATASETS[key].layer
            name = f"{layer}.{key.removeprefix('bronze.')}"
            enter(self.spark, current_version(self.spark, self.path(key)), name)
            made.append(name)
        return made

    def create_schemas(self, schemas: Iterable[str] = ("bronze", "silver", "gold", "_test_failures")):
        for schema in schemas:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")

    def _asked_for(self, key: str) -> None:
        if self._making:
            self._inputs[self._making[-1]].add(key)

    def _memo(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        self._asked_for(key)
        if key in self._stored:
            return self._stored[key]
        if key not in self._built:
            self._built[key] = build()
        return self._built[key]
