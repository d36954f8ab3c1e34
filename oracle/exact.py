"""Exact decimal arithmetic as integer SQL, so that no rounding depends on an engine's DOUBLE."""

from __future__ import annotations


def cents(money: str) -> str:
    return f"(({money}) * 100)::HUGEINT"


def half_up(num: str, den: str, digits: int) -> str:
    """num / den with ``digits`` fraction digits, ties away from zero, as a scaled integer; den > 0."""
    n, d = f"({num})::HUGEINT", f"nullif(({den})::HUGEINT, 0)"
    return f"(sign({n})::HUGEINT * ((2 * abs({n}) * {10**digits} + {d}) // (2 * {d})))"


def shorten(scaled: str, dropped: int) -> str:
    """Drop fraction digits of a scaled integer, ties away from zero."""
    return f"(sign({scaled})::HUGEINT * ((2 * abs({scaled}) + {10**dropped}) // {2 * 10**dropped}))"


def number(scaled: str, digits: int) -> str:
    return f"(({scaled})::DOUBLE / 1e{digits})"


def rounded(num: str, den: str, kept: int) -> str:
    """A quotient that the engine keeps with ``kept`` digits before it is rounded to 2."""
    return number(shorten(half_up(num, den, kept), kept - 2), 2)


def unrounded(num: str, den: str, kept: int) -> str:
    """A quotient kept with ``kept`` digits, compared at 6; an empty base gives 0."""
    scaled = half_up(num, den, kept)
    if kept > 6:
        scaled = shorten(scaled, kept - 6)
    return f"(case when ({den}) > 0 then {number(scaled, 6)} else 0.0 end)"
