"""The 25 business marts, each in two families.

The standard family counts completed orders only, rounds to cents, leaves empty figures NULL and drops
facts without a dimension row.  The alternative family (``*_alt``) reads the alternative star schema,
keeps unmatched facts, shows empty figures as 0, does not round, and defines some figures differently;
each such difference is visible below as a branch on ``style``.

No mart aggregates an order-level amount after joining order lines to it.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from shopledger.functions.dates import days_between, month_start
from shopledger.functions.measures import (
    ALTERNATIVE,
    STANDARD,
    backorder_percent,
    is_completed,
    is_returned,
    line_sums,
    order_flags,
    session_flags,
    stock_sums,
    stock_turnover,
)
from shopledger.lakehouse import dataset
from shopledger.operators.cohort import new_versus_returning
from shopledger.operators.funnel import funnel_stages
from shopledger.operators.rollup import Grain, rollup_distinct, rollup_distinct_via, rollup_grains, rollup_via

ONE = Decimal("1.0")
# Totals of order amounts; dividing one by a count keeps 12 fraction digits instead of 6.
ORDER_TOTAL = "decimal(28,2)"

# Funnel stage labels.
STAGE_LABELS = ["Sessions", "Product views", "Add to cart", "Purchases"]
STAGE_LABELS_ALT = ["Session", "Product View", "Add to Cart", "Purchase"]


def mart(name, order=()):
    """Register one definition for both families; a leading '-' sorts descending."""

    def sort_columns():
        return [
            F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_first()
            for c in order
        ]

    def register(build):
        dataset(name, "mart", sort_columns if order else None)(lambda lake: build(lake, STANDARD))
        dataset(f"{name}_alt", "mart", sort_columns if order else None)(
            lambda lake: build(lake, ALTERNATIVE)
        )
        return build

    return register


def _gold(lake, name, style):
    return lake.table(f"gold_{name}{style.suffix}")


def _per_order(style, revenue, orders):
    total = F.col(revenue).cast(ORDER_TOTAL) if style is STANDARD else F.col(revenue)
    return style.ratio(total, F.col(orders))


def _pick(mapping, *names):
    return {name: mapping[name] for name in names}


def _finish(df, style, keys, money=(), **figures):
    """Keys, then the figures in the given order; one without a formula is the column of that name."""

    def shown(name, formula):
        if formula is not None:
            return formula
        return style.money(F.col(name)) if name in money else F.col(name)

    return df.select(*keys, *[shown(name, formula).alias(name) for name, formula in figures.items()])


# --- sales -----------------------------------------------------------------------------------------


def _orders(lake, style):
    """Sold orders with the sums of their lines, under the names of the lines' columns."""
    return lake.table(f"gold_order_totals{style.suffix}")


@mart("bi_kpi_summary")
def kpi_summary(lake, style):
    lines = _orders(lake, style)
    if style is STANDARD:
        totals = rollup_distinct(
            lines,
            [],
            "transaction_id",
            _pick(
                line_sums(style), "gross_revenue", "net_revenue", "cost_of_goods", "returned_revenue", "units_sold"
            ),
            order_flags(),
        )
        # Cost counts every completed line, also one whose net revenue is unknown.
        profit = F.col("net_revenue") - F.col("cost_of_goods")
        return totals.select(
            F.round("net_revenue", 2).alias("net_revenue"),
            F.round("gross_revenue", 2).alias("gross_revenue"),
            F.round(profit, 2).alias("gross_profit"),
            style.percent(profit, F.col("net_revenue")).alias("gross_margin_pct"),
            F.col("orders").alias("total_transactions"),
            F.col("returned_orders").alias("returned_transactions"),
            F.col("all_orders").alias("total_orders"),
            "units_sold",
            style.ratio(F.col("net_revenue"), F.col("orders")).alias("aov"),
            style.percent(F.col("returned_revenue"), F.col("gross_revenue")).alias("return_rate_pct"),
        )
    sums = _pick(line_sums(style), "net_revenue", "listed_revenue", "gross_profit", "units_sold")
    sales = lines.agg(*[F.sum(value).alias(name) for name, value in sums.items()])
    orders = _gold(lake, "fact_transaction", style).agg(
        F.count_if(is_completed()).alias("total_transactions"),
        F.count_if(is_returned()).alias("returned_transactions"),
        F.count(F.lit(1)).alias("total_orders"),
    )
    # Both sides are one row.
    return sales.crossJoin(orders).select(
        "net_revenue",
        F.col("listed_revenue").alias("gross_revenue"),
        "gross_profit",
        style.margin(F.col("gross_profit"), F.col("net_revenue")).alias("gross_margin_pct"),
        "total_transactions",
        "returned_transactions",
        "total_orders",
        "units_sold",
        style.ratio(F.col("net_revenue"), F.col("total_transactions")).alias("aov"),
        style.percent(F.col("returned_transactions"), F.col("total_orders")).alias("return_rate_pct"),
    )


def _dated_lines(lake, style):
    """Orders with their calendar day: the order time, or in the alternative the date dimension."""
    lines = _orders(lake, style)
    if style is STANDARD:
        return lines.withColumn("sale_date", F.col("transaction_timestamp").cast("date"))
    days = _gold(lake, "dim_date", style).select(
        F.col("date_id").alias("transaction_date_id"), F.col("date").alias("sale_date")
    )
    return lines.join(days, "transaction_date_id", "left")


def _sales_by(lines, style, keys, sums):
    return rollup_distinct(
        lines, keys, "transaction_id", _pick(line_sums(style), *sums), _pick(order_flags(), "orders")
    )


@mart("bi_revenue_by_month", order=["month_start"])
def revenue_by_month(lake, style):
    lines = _dated_lines(lake, style).withColumn("month_start", month_start(F.col("sale_date")))
    totals = _sales_by(lines, style, ["month_start"], ["net_revenue", "gross_profit", "units_sold"])
    return _finish(
        totals,
        style,
        ["month_start"],
        money=["net_revenue", "gross_profit"],
        net_revenue=None,
        gross_profit=None,
        gross_margin_pct=style.margin(F.col("gross_profit"), F.col("net_revenue")),
        orders=None,
        units_sold=None,
    )


@mart("bi_daily_sales", order=["sale_date"])
def daily_sales(lake, style):
    totals = _sales_by(
        _dated_lines(lake, style), style, ["sale_date"], ["net_revenue", "gross_profit", "units_sold"]
    )
    return _finish(
        totals,
        style,
        ["sale_date"],
        money=["net_revenue", "gross_profit"],
        net_revenue=None,
        gross_profit=None,
        orders=None,
        units_sold=None,
        aov=style.ratio(F.col("net_revenue"), F.col("orders")),
    )


def _product_mart(lake, style, keys, sums):
    totals = rollup_via(
        _gold(lake, "fact_sale", style),
        "product_id",
        _gold(lake, "dim_product", style),
        keys,
        _pick(line_sums(style), *sums),
        style.dim_join,
    )
    return _finish(totals, style, keys, money=["net_revenue", "gross_profit"], **dict.fromkeys(sums))


@mart("bi_sales_by_category", order=["-net_revenue", "category_name"])
def sales_by_category(lake, style):
    return _product_mart(lake, style, ["category_name"], ["net_revenue", "gross_profit", "units_sold"])


@mart("bi_sales_by_subcategory", order=["-net_revenue", "category_name", "subcategory_name"])
def sales_by_subcategory(lake, style):
    keys = ["category_name", "subcategory_name"]
    return _product_mart(lake, style, keys, ["net_revenue", "gross_profit", "units_sold"])


@mart("bi_sales_by_brand", order=["-net_revenue", "brand_name"])
def sales_by_brand(lake, style):
    return _product_mart(lake, style, ["brand_name"], ["net_revenue", "gross_profit", "units_sold"])


@mart("bi_top_products", order=["-net_revenue", "product_name", "category_name", "brand_name"])
def top_products(lake, style):
    # Grouped by name: two products of one name are one row.
    keys = ["product_name", "category_name", "brand_name"]
    return _product_mart(lake, style, keys, ["net_revenue", "units_sold"])


@mart("bi_sales_by_channel", order=["-net_revenue", "sales_channel"])
def sales_by_channel(lake, style):
    totals = _sales_by(_orders(lake, style), style, ["sales_channel"], ["net_revenue"])
    return _finish(
        totals,
        style,
        ["sales_channel"],
        money=["net_revenue"],
        net_revenue=None,
        orders=None,
        aov=style.ratio(F.col("net_revenue"), F.col("orders")),
    )


def _sales_by_place(lake, style, keys, sums):
    return rollup_distinct_via(
        _orders(lake, style),
        "store_id",
        _gold(lake, "dim_store", style),
        keys,
        "transaction_id",
        _pick(line_sums(style), *sums),
        _pick(order_flags(), "orders"),
    )


@mart("bi_sales_by_store", order=["-net_revenue", "store_id"])
def sales_by_store(lake, style):
    keys = ["store_id", "store_name", "city", "state_province", "store_type"]
    totals = _sales_by_place(lake, style, keys, ["net_revenue", "gross_profit"])
    return _finish(
        totals,
        style,
        keys,
        money=["net_revenue", "gross_profit"],
        net_revenue=None,
        gross_profit=None,
        gross_margin_pct=style.margin(F.col("gross_profit"), F.col("net_revenue")),
        orders=None,
        aov=style.ratio(F.col("net_revenue"), F.col("orders")),
    )


@mart("bi_sales_by_region", order=["-net_revenue", "country", "state_province", "city"])
def sales_by_region(lake, style):
    keys = ["country", "state_province", "city"]
    totals = _sales_by_place(lake, style, keys, ["net_revenue"])
    return _finish(totals, style, keys, money=["net_revenue"], net_revenue=None, orders=None)


@mart("bi_sales_by_weekday", order=["day_of_week"])
def sales_by_weekday(lake, style):
    keys = ["day_of_week", "day_name"]
    days = _gold(lake, "dim_date", style).select(F.col("date_id").alias("transaction_date_id"), *keys)
    lines = _orders(lake, style).join(days, "transaction_date_id", style.dim_join)
    return _finish(
        _sales_by(lines, style, keys, ["net_revenue"]),
        style,
        keys,
        money=["net_revenue"],
        net_revenue=None,
        orders=None,
        aov=style.ratio(F.col("net_revenue"), F.col("orders")),
    )


# The groupings of the marts of orders; what a look-up misses is left out of the grain that needs it.
SALES_GRAINS = {
    "month": ["month_start"],
    "day": ["sale_date"],
    "channel": ["sales_channel"],
    "store": ["store_id", "store_name", "city", "state_province", "store_type"],
    "region": ["country", "state_province", "city"],
    "weekday": ["day_of_week", "day_name"],
}


def sales_grains(lake):
    """Revenue, profit, orders and units of the standard family at all grains of its marts of orders, by one reading of
    the orders: ``grain``, the keys of all grains, and the figures as the marts show them."""
    places = _gold(lake, "dim_store", STANDARD).select(
        F.col("store_id").alias("__store"), *dict.fromkeys(k for k in SALES_GRAINS["store"][1:] + SALES_GRAINS["region"])
    )
    days = _gold(lake, "dim_date", STANDARD).select(F.col("date_id").alias("__day"), *SALES_GRAINS["weekday"])
    orders = _dated_lines(lake, STANDARD).withColumn("month_start", month_start(F.col("sale_date")))
    orders = orders.join(places, orders.store_id == places["__store"], "left")
    orders = orders.join(days, orders.transaction_date_id == days["__day"], "left")
    known = {"store": "__store", "region": "__store", "weekday": "__day"}
    grains = [
        Grain(name, tuple(keys), F.col(known[name]).isNotNull() if name in known else None)
        for name, keys in SALES_GRAINS.items()
    ]
    totals = rollup_grains(
        orders,
        grains,
        "transaction_id",
        _pick(line_sums(STANDARD), "net_revenue", "gross_profit", "units_sold"),
        _pick(order_flags(), "orders"),
    )
    keys = list(dict.fromkeys(key for grain in grains for key in grain.keys))
    figures = dict(net_revenue=None, gross_profit=None, orders=None, units_sold=None)
    return _finish(totals, STANDARD, ["grain", *keys], money=["net_revenue", "gross_profit"], **figures)


@mart("bi_returns_by_category", order=["-returned_revenue", "category_name"])
def returns_by_category(lake, style):
    totals = rollup_distinct_via(
        _gold(lake, "fact_sale", style),
        "product_id",
        _gold(lake, "dim_product", style),
        ["category_name"],
        "transaction_id",
        _pick(line_sums(style), "returned_revenue", "gross_revenue"),
        _pick(order_flags(), "returned_orders", "all_orders"),
        style.dim_join,
    )
    if style is STANDARD:
        rate = style.percent(F.col("returned_revenue"), F.col("gross_revenue"))
    else:
        rate = style.percent(F.col("returned_orders"), F.col("all_orders"))
    return _finish(
        totals,
        style,
        ["category_name"],
        money=["returned_revenue"],
        returned_revenue=None,
        returned_orders=None,
        return_rate_pct=rate,
    )


def _orders_with_line_revenue(lake, style, how):
    """Orders with the net revenue of their lines, added up before the join."""
    revenue = (
        _orders(lake, style)
        .groupBy("transaction_id")
        .agg(F.sum(line_sums(style)["net_revenue"]).alias("line_revenue"))
    )
    return _gold(lake, "fact_transaction", style).join(revenue, "transaction_id", how)


@mart("bi_sales_by_payment_type", order=["-net_revenue", "payment_type"])
def sales_by_payment_type(lake, style):
    if style is STANDARD:
        orders = _gold(lake, "fact_transaction", style)
        revenue = style.only(is_completed(), F.col("transaction_total"))
    else:
        orders = _orders_with_line_revenue(lake, style, "inner")
        revenue = F.col("line_revenue")
    totals = rollup_distinct(
        orders, ["payment_type"], "transaction_id", {"net_revenue": revenue}, {"orders": is_completed()}
    )
    return _finish(
        totals,
        style,
        ["payment_type"],
        money=["net_revenue"],
        orders=None,
        net_revenue=None,
        aov=_per_order(style, "net_revenue", "orders"),
    )


# --- customers -------------------------------------------------------------------------------------


def _repeated_customer():
    return (
        F.max("orders").alias("orders"),
        F.sum("lifetime_revenue").alias("lifetime_revenue"),
        F.min("first_order_ts").alias("first_order_ts"),
        F.max("last_order_ts").alias("last_order_ts"),
    )


@mart("bi_customer_summary")
def customer_summary(lake, style):
    if style is STANDARD:
        orders = _gold(lake, "fact_transaction", style).filter(is_completed())
        revenue = F.col("transaction_total")
    else:
        orders = _orders_with_line_revenue(lake, style, "left")
        revenue = F.coalesce(F.col("line_revenue"), F.lit(0))
    activity = rollup_distinct(
        orders.filter(F.col("customer_id").isNotNull()),
        ["customer_id"],
        "transaction_id",
        {"lifetime_revenue": revenue},
        {"orders": F.lit(True)},
        earliest={"first_order_ts": F.col("transaction_timestamp")},
        latest={"last_order_ts": F.col("transaction_timestamp")},
    )
    traits = [
        "customer_id", "loyalty_status", "income_bracket", "age_group", "customer_persona",
        "signup_channel", "country", "state_province", "city",
    ]
    known = _gold(lake, "dim_customer", style).select(*traits).join(activity, "customer_id", "inner")
    if style is not STANDARD:
        # These customers may be given several times, and revenue is added for each.
        known = known.groupBy(*traits).agg(*_repeated_customer())
    return _finish(
        known,
        style,
        traits,
        money=["lifetime_revenue"],
        orders=None,
        lifetime_revenue=None,
        first_order_ts=None,
        last_order_ts=None,
        days_since_last_order=days_between(F.col("last_order_ts"), F.lit(lake.as_of)),
        is_repeat_customer=F.col("orders") > 1,
    )


@mart("bi_customer_loyalty_mix", order=["-net_revenue", "loyalty_status"])
def customer_loyalty_mix(lake, style):
    customers = lake.table(f"bi_customer_summary{style.suffix}")
    if style is not STANDARD:
        # A customer who is given with different traits counts once.
        customers = customers.groupBy("loyalty_status", "customer_id").agg(*_repeated_customer())
        customers = customers.withColumn("is_repeat_customer", F.col("orders") > 1)
    totals = customers.groupBy("loyalty_status").agg(
        F.count(F.lit(1)).alias("active_customers"),
        F.count_if("is_repeat_customer").alias("repeat_customers"),
        F.sum("lifetime_revenue").alias("net_revenue"),
        F.avg("lifetime_revenue").alias("mean_revenue"),
        F.avg("orders").alias("mean_orders"),
        F.sum("orders").alias("all_orders"),
    )
    if style is STANDARD:
        revenue_each, orders_each = F.round("mean_revenue", 2), F.round("mean_orders", 2)
    else:
        revenue_each = style.ratio(F.col("net_revenue"), F.col("active_customers"))
        orders_each = style.ratio(F.col("all_orders") * F.lit(ONE), F.col("active_customers"))
    return _finish(
        totals,
        style,
        ["loyalty_status"],
        money=["net_revenue"],
        active_customers=None,
        repeat_customers=None,
        repeat_rate_pct=style.percent(F.col("repeat_customers"), F.col("active_customers")),
        net_revenue=None,
        avg_revenue_per_customer=revenue_each,
        avg_orders_per_customer=orders_each,
    )


@mart("bi_customer_new_vs_returning_by_month", order=["month_start"])
def customer_new_vs_returning_by_month(lake, style):
    if style is STANDARD:
        orders = _gold(lake, "fact_transaction", style).filter(is_completed())
        amount = F.col("transaction_total")
    else:
        # First month and activity take in every status, revenue only completed lines.
        orders = _orders_with_line_revenue(lake, style, "left")
        amount = F.coalesce(F.col("line_revenue"), F.lit(0))
    monthly = orders.withColumn("month_start", month_start(F.col("transaction_timestamp")))
    totals = new_versus_returning(monthly, "customer_id", "month_start", amount)
    money = {
        name: style.money(F.coalesce(F.col(name), F.lit(0)) if style.empty_as_zero else F.col(name))
        for name in ("new_customer_revenue", "returning_customer_revenue")
    }
    return _finish(totals, style, ["month_start"], new_customers=None, returning_customers=None, **money)


# --- web sessions ----------------------------------------------------------------------------------


@mart("bi_clickstream_funnel_by_month", order=["month_start"])
def clickstream_funnel_by_month(lake, style):
    sessions = _gold(lake, "fact_clickstream", style).withColumn(
        "month_start", month_start(F.col("session_start_time"))
    )
    totals = rollup_distinct(sessions, ["month_start"], "session_id", flags=session_flags())
    visits, views = F.col("sessions"), F.col("product_view_sessions")
    carts, purchases = F.col("add_to_cart_sessions"), F.col("purchase_sessions")
    if style is STANDARD:
        cart_rate, bounce_rate = style.percent(carts, views), style.percent(F.col("short_sessions"), visits)
    else:
        cart_rate, bounce_rate = style.percent(carts, visits), style.percent(visits - views, visits)
    return _finish(
        totals,
        style,
        ["month_start"],
        sessions=None,
        product_view_sessions=None,
        add_to_cart_sessions=None,
        purchase_sessions=None,
        conversion_rate_pct=style.percent(purchases, visits),
        add_to_cart_rate_pct=cart_rate,
        bounce_rate_pct=bounce_rate,
        cart_abandonment_pct=style.percent(carts - purchases, carts),
    )


@mart("bi_funnel_overall", order=["step"])
def funnel_overall(lake, style):
    counts = ["sessions", "product_view_sessions", "add_to_cart_sessions", "purchase_sessions"]
    totals = rollup_distinct(
        _gold(lake, "fact_clickstream", style), [], "session_id", flags=_pick(session_flags(), *counts)
    )

    def share(step, part, base):
        if style is not STANDARD:
            return style.percent(part, base)
        whole = F.lit(Decimal("100.00"))
        return (whole if step == 1 else style.percent(part, base)).cast("decimal(8,2)")

    labels = STAGE_LABELS if style is STANDARD else STAGE_LABELS_ALT
    return funnel_stages(totals, list(zip(counts, labels, strict=True)), share)


def _session_mart(lake, style, key):
    flags = _pick(session_flags(), "sessions", "purchase_sessions")
    totals = rollup_distinct(_gold(lake, "fact_clickstream", style), [key], "session_id", flags=flags)
    rate = style.percent(F.col("purchase_sessions"), F.col("sessions"))
    return _finish(totals, style, [key], sessions=None, purchase_sessions=None, conversion_rate_pct=rate)


@mart("bi_sessions_by_device", order=["-sessions", "device_type"])
def sessions_by_device(lake, style):
    return _session_mart(lake, style, "device_type")


@mart("bi_sessions_by_traffic_source", order=["-sessions", "traffic_source"])
def sessions_by_traffic_source(lake, style):
    return _session_mart(lake, style, "traffic_source")


# --- campaigns and promotions ----------------------------------------------------------------------


@mart("bi_campaign_performance", order=["-attributed_revenue", "campaign_id"])
def campaign_performance(lake, style):
    tagged = F.col("campaign_id").isNotNull()
    visits = rollup_distinct(
        _gold(lake, "fact_clickstream", style).filter(tagged),
        ["campaign_id"],
        "session_id",
        flags=_pick(session_flags(), "sessions", "purchase_sessions"),
    )
    if style is STANDARD:
        # Orders of any status, revenue of completed ones.
        facts = _gold(lake, "fact_transaction", style)
        revenue, counted = F.col("transaction_total"), F.lit(True)
    else:
        facts = _gold(lake, "fact_sale", style)
        revenue, counted = F.col("net_line_revenue"), is_completed()
    sales = rollup_distinct(
        facts.filter(tagged),
        ["campaign_id"],
        "transaction_id",
        {"attributed_revenue": style.only(is_completed(), revenue)},
        {"attributed_orders": counted},
    )
    keys = ["campaign_id", "campaign_name", "campaign_channel"]
    joined = (
        _gold(lake, "dim_campaign", style)
        .select(*keys)
        .join(visits, "campaign_id", "left")
        .join(sales, "campaign_id", "left")
    )
    none = F.lit(0).cast("bigint")
    sessions = F.coalesce(F.col("sessions"), none)
    orders = F.coalesce(F.col("attributed_orders"), none)
    converted = F.col("purchase_sessions") if style is STANDARD else orders
    return _finish(
        joined,
        style,
        keys,
        sessions=sessions,
        attributed_orders=orders,
        attributed_revenue=style.money(F.coalesce(F.col("attributed_revenue"), F.lit(0))),
        conversion_rate_pct=style.percent(converted, F.col("sessions") if style is STANDARD else sessions),
    )


@mart("bi_promotion_performance", order=["-promo_revenue", "promo_id"])
def promotion_performance(lake, style):
    if style is STANDARD:
        orders = _gold(lake, "fact_transaction", style)
        revenue = style.only(is_completed(), F.col("transaction_total"))
        discount, counted = style.only(is_completed(), F.col("transaction_discount_applied")), is_completed()
    else:
        # Every status counts.  The discount of an order counts once, whatever its number of lines.
        orders = _orders_with_line_revenue(lake, style, "left")
        revenue = F.coalesce(F.col("line_revenue"), F.lit(0))
        discount, counted = F.col("transaction_discount_applied"), F.lit(True)
    per_promotion = rollup_distinct(
        orders.filter(F.col("promo_id").isNotNull()),
        ["promo_id"],
        "transaction_id",
        {"promo_revenue": revenue, "discount_given": discount},
        {"promo_orders": counted},
    )
    keys = ["promo_id", "promo_name", "promo_type", "discount_type"]
    # Promotions listed twice under the same text are one row here, as when grouping after the join.
    totals = (
        _gold(lake, "dim_promotion", style)
        .select(*keys)
        .join(per_promotion, "promo_id", "inner")
        .groupBy(*keys)
        .agg(
            F.max("promo_orders").alias("promo_orders"),
            F.sum("promo_revenue").alias("promo_revenue"),
            F.sum("discount_given").alias("discount_given"),
        )
    )
    return _finish(
        totals,
        style,
        keys,
        money=["promo_revenue", "discount_given"],
        promo_orders=None,
        promo_revenue=None,
        discount_given=None,
        avg_revenue_per_promo_txn=_per_order(style, "promo_revenue", "promo_orders"),
    )


# --- inventory -------------------------------------------------------------------------------------


def _stock_figures(totals, style, keys, **counts):
    """``counts`` are output name = summed column."""
    return totals.select(
        *keys,
        stock_turnover(style).alias("inventory_turnover"),
        *[F.col(column).alias(name) for name, column in counts.items()],
        backorder_percent(style).alias("backorder_rate_pct"),
    )


@mart("bi_inventory_by_category", order=["-inventory_turnover", "category_name"])
def inventory_by_category(lake, style):
    keys = ["category_name"]
    totals = rollup_via(
        _gold(lake, "fact_inventory", style),
        "product_id",
        _gold(lake, "dim_product", style),
        keys,
        stock_sums(),
        style.dim_join,
    )
    return _stock_figures(
        totals,
        style,
        keys,
        total_units_sold="sold_units",
        total_units_received="received_stock",
        total_shrinkage_loss="shrinkage_loss",
    )


@mart("bi_inventory_by_month", order=["snapshot_month"])
def inventory_by_month(lake, style):
    keys = ["snapshot_month"]
    totals = (
        _gold(lake, "fact_inventory", style)
        .groupBy(*keys)
        .agg(*[F.sum(value).alias(name) for name, value in stock_sums().items()])
    )
    return _stock_figures(
        totals,
        style,
        keys,
        sold_units="sold_units",
        received_stock="received_stock",
        shrinkage_loss="shrinkage_loss",
    )


@mart("bi_inventory_by_store", order=["-inventory_turnover", "store_name", "city", "state_province"])
def inventory_by_store(lake, style):
    keys = ["store_name", "city", "state_province"]
    totals = rollup_via(
        _gold(lake, "fact_inventory", style),
        "store_id",
        _gold(lake, "dim_store", style),
        keys,
        stock_sums(),
        "inner",
    )
    return _stock_figures(
        totals, style, keys, total_units_sold="sold_units", total_shrinkage_loss="shrinkage_loss"
    )
