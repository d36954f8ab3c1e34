"""Spread an order-level amount over the order's lines in proportion to a weight."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide sums lose fraction digits when divided; amounts of this width keep 20 of them.
AMOUNT = "decimal(18,2)"
# Fraction digits kept of a quotient of two DECIMAL(10,2) amounts.
QUOTIENT = "decimal(23,13)"
ALLOCATED = "decimal(24,2)"


def _quotient(part: Column, whole: Column) -> Column:
    return (part.cast(AMOUNT) / F.nullif(whole.cast(AMOUNT), F.lit(0))).cast(QUOTIENT)


def allocate_by_share(weight: Column, total: Column, amount: Column) -> Column:
    """round(weight / total * amount, 2): an absent amount counts as 0, an empty total gives NULL."""
    due = F.coalesce(amount.cast(AMOUNT), F.lit(0))
    return F.round(_quotient(weight, total) * due, 2).cast(ALLOCATED)


def allocate_by_rate(weight: Column, total: Column, amount: Column) -> Column:
    """weight * (amount / total), 2 digits: an absent amount or empty total gives NULL."""
    return (weight * _quotient(amount, total)).cast(ALLOCATED)
