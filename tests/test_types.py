"""Types of all stored and shown columns, which the comparison with SQL does not see."""

import re

import pytest

from shopledger.lakehouse import DATASETS
from shopledger.sources.catalog import RAW_TABLES
from shopledger.sources.reader import snake_case

RAW_OF = {f"silver_{raw}": raw for raw in RAW_TABLES if raw != "inventory"} | {"silver_fact_inventory": "inventory"}
MONEY_2 = re.compile(r"decimal\(\d+,2\)")
# Columns of the standard marts by what they end in or are called.
MART_TYPES = [
    (r"avg_orders_per_customer", re.compile("double")),  # the mean of whole numbers
    (r"(net|gross)_revenue|gross_profit|.*_revenue|.*_revenue_per_.*|discount_given|aov|avg_.*|.*_pct|pct_.*|inventory_turnover", MONEY_2),
    (r"orders|.*_orders|.*sessions|.*customers|units_sold|total_.*|returned_transactions|sold_units|received_stock|shrinkage_loss", re.compile("bigint")),
    (r".*_date|month_start|snapshot_month", re.compile("date")),
    (r".*_ts", re.compile("timestamp_ntz")),
    (r"is_.*", re.compile("boolean")),
    (r"step|day_of_week|days_since_last_order", re.compile("int|bigint")),
    (r"(customer|store|campaign|promo)_id", re.compile("bigint")),
]


@pytest.mark.parametrize("name", RAW_OF)
def test_cleaned_columns_have_the_declared_types(tiny, name):
    declared = {snake_case(c): kind for c, kind in RAW_TABLES[RAW_OF[name]].items()}
    kinds = dict(tiny().table(name).dtypes)
    assert len(set(declared) & set(kinds)) >= 2
    for column in set(declared) & set(kinds):
        assert kinds[column] == declared[column], (name, column)


@pytest.mark.parametrize("name", [n for n, d in DATASETS.items() if d.layer == "gold" and not n.endswith("_alt")])
def test_star_columns_keep_their_types(tiny, name):
    lake = tiny()
    cleaned = {}
    for table in RAW_OF:
        cleaned |= dict(lake.table(table).dtypes)
    kinds = dict(lake.table(name).dtypes)
    summed = ("quantity", "line_cost", "line_total") if name == "gold_order_totals" else ()
    for column in set(kinds) & set(cleaned) - set(summed):
        assert kinds[column] == cleaned[column], (name, column)
    for column in ("allocated_line_discount", "net_line_revenue", "net_line_profit"):
        if column in kinds:
            assert MONEY_2.fullmatch(kinds[column])


@pytest.mark.parametrize("name", [n for n, d in DATASETS.items() if d.layer == "mart" and not n.endswith("_alt")])
def test_mart_columns_have_types_that_hold_at_scale(tiny, name):
    for column, kind in tiny().table(name).dtypes:
        expected = next((k for pattern, k in MART_TYPES if re.fullmatch(pattern, column)), re.compile("string|boolean"))
        assert expected.fullmatch(kind), (name, column, kind)
