"""The measure library: every mart figure is defined here once."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPLETED = "Completed"
RETURNED = "Returned"
HUNDRED = Decimal("100.0")


@dataclass(frozen=True)
class Style:
    """How a family of marts treats empty groups, rounding and rows without a dimension match."""

    suffix: str
    dim_join: str
    empty_as_zero: bool
    digits: int | None

    def only(self, condition: Column, value: Column) -> Column:
        chosen = F.when(condition, value)
        return chosen.otherwise(F.lit(0)) if self.empty_as_zero else chosen

    def money(self, value: Column) -> Column:
        return value if self.digits is None else F.round(value, self.digits)

    def ratio(self, part: Column, whole: Column) -> Column:
        """part / whole; an empty whole gives NULL, or 0 where empty groups count as zero."""
        if self.empty_as_zero:
            return self.money(F.when(whole > 0, part / whole).otherwise(F.lit(0)))
        return self.money(part / F.nullif(whole, F.lit(0)))

    def percent(self, part: Column, whole: Column) -> Column:
        return self.ratio(F.lit(HUNDRED) * part, whole)

    def margin(self, profit: Column, revenue: Column) -> Column:
        if self.empty_as_zero:
            share = F.when(revenue > 0, profit / revenue * 100).otherwise(F.lit(0))
            return self.money(share)
        return self.percent(profit, revenue)


STANDARD = Style(suffix="", dim_join="inner", empty_as_zero=False, digits=2)
ALTERNATIVE = Style(suffix="_alt", dim_join="left", empty_as_zero=True, digits=None)


def is_completed() -> Column:
    return F.col("transaction_status") == COMPLETED


def is_returned() -> Column:
    return F.col("transaction_status") == RETURNED


def line_sums(style: Style) -> dict[str, Column]:
    """Additive figures of order lines."""
    revenue = F.col("net_line_revenue")
    return {
        "gross_revenue": revenue,
        "listed_revenue": F.col("line_total"),
        "net_revenue": style.only(is_completed(), revenue),
        "gross_profit": style.only(is_completed(), F.col("net_line_profit")),
        "cost_of_goods": style.only(is_completed(), F.col("line_cost")),
        "returned_revenue": style.only(is_returned(), revenue),
        "units_sold": style.only(is_completed(), F.col("quantity")),
    }


def order_flags() -> dict[str, Column]:
    """Which orders a count of distinct orders takes in."""
    return {"orders": is_completed(), "returned_orders": is_returned(), "all_orders": F.lit(True)}


def session_flags() -> dict[str, Column]:
    """Which sessions a count of distinct sessions takes in."""
    return {
        "sessions": F.lit(True),
        "product_view_sessions": F.col("product_page_visited_flag"),
        "add_to_cart_sessions": F.col("added_to_cart_flag"),
        "purchase_sessions": F.col("purchased_flag"),
        "short_sessions": F.col("number_of_pages_viewed") < 2,
    }


def stock_sums() -> dict[str, Column]:
    """Additive figures of stock snapshots; averages are kept as a sum and a count.

    The level of a snapshot is the mean of two whole numbers, so it is added up as a whole number of halves.
    """
    halves = F.col("starting_stock") + F.col("closing_stock")
    return {
        "sold_units": F.col("sold_units"),
        "received_stock": F.col("received_stock"),
        "shrinkage_loss": F.col("shrinkage_loss"),
        "level_halves": halves,
        "level_count": F.when(halves.isNotNull(), 1).otherwise(0),
        "closing_sum": F.col("closing_stock"),
        "closing_count": F.when(F.col("closing_stock").isNotNull(), 1).otherwise(0),
        "backorders": F.when(F.col("backorder_flag"), 1).otherwise(0),
        "snapshots": F.lit(1),
    }


def stock_turnover(style: Style) -> Column:
    """Units sold over the average stock level (closing stock only, in the alternative family)."""
    sold = F.col("sold_units")
    if style.empty_as_zero:
        level = F.col("closing_sum").cast("double") / F.nullif(F.col("closing_count"), F.lit(0))
        return F.when(level > 0, sold / level).otherwise(F.lit(0.0))
    # An average of levels has 10 fraction digits. The quotient of these two widths has 19, however large the sums.
    halves = F.col("level_halves").cast("decimal(19,0)")
    level = F.round(halves / F.nullif(2 * F.col("level_count"), F.lit(0)).cast("decimal(20,0)"), 10)
    return F.round(sold.cast("decimal(19,0)") / F.nullif(level, F.lit(0)).cast("decimal(30,10)"), 2)


def backorder_percent(style: Style) -> Column:
    backorders, snapshots = F.col("backorders"), F.col("snapshots")
    if style.empty_as_zero:
        return style.percent(backorders, snapshots)
    # An average of DECIMAL(2,1) flags has 5 fraction digits.
    share = (backorders / snapshots.cast("decimal(20,0)")).cast("decimal(6,5)")
    return F.round(F.lit(HUNDRED) * share, 2)
