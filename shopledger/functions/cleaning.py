"""Column-level cleaning: conforming types, recoding values, cutting values into bands."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conform(
    df: DataFrame,
    schema: Mapping[str, str],
    clean: Mapping[str, Callable[[Column], Column]] | None = None,
    drop: Iterable[str] = (),
) -> DataFrame:
    """Project to the declared columns and types, cleaning the text columns named in ``clean``."""
    clean = clean or {}
    dropped = set(drop)
    return df.select(
        *[
            clean.get(name, lambda c: c)(F.col(name).cast(kind)).alias(name)
            for name, kind in schema.items()
            if name not in dropped
        ]
    )


def recode(value: Column, mapping: Mapping[str, str], ignore_case: bool = False) -> Column:
    """Replace listed values; any other value is lower-cased."""
    probe = F.lower(value) if ignore_case else value
    result = None
    for old, new in mapping.items():
        hit = probe == (old.lower() if ignore_case else old)
        result = F.when(hit, new) if result is None else result.when(hit, new)
    return F.lower(value) if result is None else result.otherwise(F.lower(value))


@dataclass(frozen=True)
class Band:
    label: str
    at_least: int | None = None
    at_most: int | None = None
    below: int | None = None

    def holds(self, value: Column) -> Column:
        tests = [
            value >= self.at_least if self.at_least is not None else None,
            value <= self.at_most if self.at_most is not None else None,
            value < self.below if self.below is not None else None,
        ]
        tests = [t for t in tests if t is not None]
        whole = tests[0]
        for test in tests[1:]:
            whole = whole & test
        return whole


def band(value: Column, bands: Iterable[Band], otherwise: str) -> Column:
    """Label of the first band that holds; ``otherwise`` takes the rest, NULL included."""
    label = None
    for b in bands:
        label = F.when(b.holds(value), b.label) if label is None else label.when(b.holds(value), b.label)
    return label.otherwise(otherwise)
