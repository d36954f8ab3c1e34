"""The marts of both families in DuckDB SQL, final figures as DOUBLE or BIGINT."""

from __future__ import annotations

from oracle.exact import cents, half_up, number, rounded, shorten, unrounded

DONE = "filter (where transaction_status = 'Completed')"
BACK = "filter (where transaction_status = 'Returned')"


def money(expression: str, name: str | None = None) -> str:
    return f"({expression})::DOUBLE as {name or expression}"


def count(expression: str, name: str | None = None) -> str:
    return f"({expression})::BIGINT as {name or expression}"


def ids(column: str, condition: str | None = None) -> str:
    return f"count(distinct {column})" + (f" filter (where {condition})" if condition else "")


def _names(keys: str) -> str:
    """Output names of a key list; an expression key stands alone."""
    return keys.split(" as ")[-1]


# Quotients of sums of line money keep 6 fraction digits, of order money 12, of counts 14.
def order_aov(revenue: str, orders: str) -> str:
    return rounded(cents(revenue), f"({orders}) * 100", 12)


def aov(revenue: str, orders: str) -> str:
    return rounded(cents(revenue), f"({orders}) * 100", 6)


def margin(profit: str, revenue: str) -> str:
    return rounded(f"100 * {cents(profit)}", cents(revenue), 6)


def share(part: str, whole: str) -> str:
    return rounded(f"100 * ({part})", whole, 14)


def aov_alt(revenue: str, orders: str) -> str:
    return unrounded(cents(revenue), f"({orders}) * 100", 6)


def margin_alt(profit: str, revenue: str) -> str:
    quotient = half_up(cents(profit), cents(revenue), 6)
    return f"(case when {revenue} > 0 then {number(f'({quotient} * 100)', 6)} else 0.0 end)"


def share_alt(part: str, whole: str) -> str:
    return unrounded(f"100 * ({part})", whole, 14)


def _standard() -> dict[str, str]:
    sums = f"""
        sum(net_line_revenue) {DONE} as rev, sum(net_line_profit) {DONE} as profit,
        count(distinct transaction_id) {DONE} as orders, sum(quantity) {DONE} as units"""
    rev, profit = money("rev", "net_revenue"), money("profit", "gross_profit")
    orders, units = count("orders"), count("units", "units_sold")

    def sales(keys: str, source: str, *figures: str) -> str:
        return (
            f"select {_names(keys)}, {', '.join(figures)} from (select {keys}, {sums} from {source} group by all)"
        )

    product = "g_sale join g_product using (product_id)"
    store = "g_sale join g_store using (store_id)"
    stock = """
        sum(sold_units) as sold, sum(received_stock) as received, sum(shrinkage_loss) as shrunk,
        sum(starting_stock + closing_stock) as level_sum, count(starting_stock + closing_stock) as level_count,
        count(*) filter (where backorder_flag) as short, count(*) as snapshots"""
    # The mean level has 10 fraction digits, the turnover 8, the backorder share 5.
    level = half_up("level_sum", "2 * level_count", 10)
    turnover = f"{number(shorten(half_up(f'sold * {10**10}', level, 8), 6), 2)} as inventory_turnover"
    short = f"{number(shorten(half_up('short', 'snapshots', 5), 1), 2)} as backorder_rate_pct"

    def inventory(keys: str, source: str, *figures: str) -> str:
        return (
            f"select {keys}, {turnover}, {', '.join(figures)}, {short} "
            f"from (select {keys}, {stock} from {source} group by all)"
        )

    return {
        "bi_kpi_summary": f"""
            select {rev}, {money("gross", "gross_revenue")}, {money("rev - cost", "gross_profit")},
                   {margin("rev - cost", "rev")} as gross_margin_pct,
                   {count("orders", "total_transactions")}, {count("returned", "returned_transactions")},
                   {count("every", "total_orders")}, {units}, {aov("rev", "orders")} as aov,
                   {margin("back", "gross")} as return_rate_pct
            from (select {sums}, sum(net_line_revenue) as gross, sum(line_cost) {DONE} as cost,
                         sum(net_line_revenue) {BACK} as back, count(distinct transaction_id) {BACK} as returned,
                         count(distinct transaction_id) as every from g_sale)""",
        "bi_revenue_by_month": sales(
            "date_trunc('month', transaction_timestamp)::DATE as month_start",
            "g_sale",
            rev,
            profit,
            f"{margin('profit', 'rev')} as gross_margin_pct",
            orders,
            units,
        ),
        "bi_daily_sales": sales(
            "transaction_timestamp::DATE as sale_date", "g_sale", rev, profit, orders, units, f"{aov('rev', 'orders')} as aov"
        ),
        "bi_sales_by_category": sales("category_name", product, rev, profit, units),
        "bi_sales_by_subcategory": sales("category_name, subcategory_name", product, rev, profit, units),
        "bi_sales_by_brand": sales("brand_name", product, rev, profit, units),
        "bi_top_products": sales("product_name, category_name, brand_name", product, rev, units),
        "bi_sales_by_channel": sales("sales_channel", "g_sale", rev, orders, f"{aov('rev', 'orders')} as aov"),
        "bi_sales_by_store": sales(
            "store_id, store_name, city, state_province, store_type",
            store,
            rev,
            profit,
            f"{margin('profit', 'rev')} as gross_margin_pct",
            orders,
            f"{aov('rev', 'orders')} as aov",
        ),
        "bi_sales_by_region": sales("country, state_province, city", store, rev, orders),
        "bi_sales_by_weekday": sales(
            "day_of_week, day_name",
            "g_sale join g_date on transaction_date_id = date_id",
            rev,
            orders,
            f"{aov('rev', 'orders')} as aov",
        ),
        "bi_returns_by_category": f"""
            select category_name, {money("back", "returned_revenue")}, {count("returned", "returned_orders")},
                   {margin("back", "gross")} as return_rate_pct
            from (select category_name, sum(net_line_revenue) {BACK} as back, sum(net_line_revenue) as gross,
                         count(distinct transaction_id) {BACK} as returned from {product} group by all)""",
        "bi_sales_by_payment_type": f"""
            select payment_type, {orders}, {rev}, {order_aov("rev", "orders")} as aov
            from (select payment_type, count(distinct transaction_id) {DONE} as orders,
                         sum(transaction_total) {DONE} as rev from s_transaction group by all)""",
        "bi_customer_summary": f"""
            select {TRAITS}, {orders}, {money("rev", "lifetime_revenue")}, first_order_ts, last_order_ts,
                   (AS_OF - last_order_ts::DATE)::INT as days_since_last_order, orders >= 2 as is_repeat_customer
            from g_customer join (
                select customer_id, count(distinct transaction_id) as orders, sum(transaction_total) as rev,
                       min(transaction_timestamp) as first_order_ts, max(transaction_timestamp) as last_order_ts
                from s_transaction where transaction_status = 'Completed' group by customer_id) using (customer_id)""",
        "bi_customer_loyalty_mix": f"""
            select loyalty_status, {count("people", "active_customers")}, {count("again", "repeat_customers")},
                   {share("again", "people")} as repeat_rate_pct, {rev},
                   {rounded(cents("rev"), "paying * 100", 6)} as avg_revenue_per_customer,
                   {number(half_up("orders", "people", 2), 2)} as avg_orders_per_customer
            from (select loyalty_status, count(*) as people, count(*) filter (where n > 1) as again, sum(n) as orders,
                         sum(amount) as rev, count(amount) as paying
                  from (select customer_id, count(distinct transaction_id) as n, sum(transaction_total) as amount
                        from s_transaction where transaction_status = 'Completed' group by customer_id)
                  join g_customer using (customer_id) group by loyalty_status)""",
        "bi_customer_new_vs_returning_by_month": f"""
            select month_start,
                   {count(ids("customer_id", "month_start = debut"), "new_customers")},
                   {count(ids("customer_id", "month_start > debut"), "returning_customers")},
                   {money("sum(transaction_total) filter (where month_start = debut)", "new_customer_revenue")},
                   {money("sum(transaction_total) filter (where month_start > debut)", "returning_customer_revenue")}
            from (select *, min(month_start) over (partition by customer_id) as debut
                  from (select *, date_trunc('month', transaction_timestamp)::DATE as month_start from s_transaction
                        where transaction_status = 'Completed' and customer_id is not null))
            group by month_start""",
        "bi_clickstream_funnel_by_month": f"""
            select month_start, {count("a", "sessions")}, {count("v", "product_view_sessions")},
                   {count("c", "add_to_cart_sessions")}, {count("p", "purchase_sessions")},
                   {share("p", "a")} as conversion_rate_pct, {share("c", "v")} as add_to_cart_rate_pct,
                   {share("b", "a")} as bounce_rate_pct, {share("c - p", "c")} as cart_abandonment_pct
            from (select date_trunc('month', session_start_time)::DATE as month_start, {ids("session_id")} as a,
                         {STAGES}, {ids("session_id", "number_of_pages_viewed < 2")} as b
                  from s_clickstream group by 1)""",
        "bi_funnel_overall": f"""
            select unnest([1, 2, 3, 4]) as step,
                   unnest(['Sessions', 'Product views', 'Add to cart', 'Purchases']) as stage,
                   unnest([a, v, c, p])::BIGINT as sessions,
                   unnest([100.0, {share("v", "a")}, {share("c", "a")}, {share("p", "a")}])::DOUBLE as pct_of_sessions
            from (select {ids("session_id")} as a, {STAGES} from s_clickstream)""",
        **{
            name: f"""
            select {key}, {count("a", "sessions")}, {count("p", "purchase_sessions")},
                   {share("p", "a")} as conversion_rate_pct
            from (select {key}, {ids("session_id")} as a, {STAGES} from s_clickstream group by 1)"""
            for name, key in (
                ("bi_sessions_by_device", "device_type"),
                ("bi_sessions_by_traffic_source", "traffic_source"),
            )
        },
        "bi_campaign_performance": f"""
            select campaign_id::BIGINT as campaign_id, campaign_name, campaign_channel, {count("coalesce(a, 0)", "sessions")},
                   {count("coalesce(n, 0)", "attributed_orders")}, {money("coalesce(rev, 0)", "attributed_revenue")},
                   {share("p", "a")} as conversion_rate_pct
            from s_campaign
            left join (select campaign_id, {ids("session_id")} as a, {STAGES} from s_clickstream group by 1)
                using (campaign_id)
            left join (select campaign_id, {ids("transaction_id")} as n, sum(transaction_total) {DONE} as rev
                       from s_transaction group by 1) using (campaign_id)""",
        "bi_promotion_performance": f"""
            select promo_id::BIGINT as promo_id, promo_name, promo_type, discount_type, {count("n", "promo_orders")},
                   {money("rev", "promo_revenue")}, {money("off", "discount_given")},
                   {order_aov("rev", "n")} as avg_revenue_per_promo_txn
            from (select promo_id, promo_name, promo_type, discount_type,
                         count(distinct transaction_id) {DONE} as n, sum(transaction_total) {DONE} as rev,
                         sum(transaction_discount_applied) {DONE} as off
                  from s_transaction join s_promotion using (promo_id) group by all)""",
        "bi_inventory_by_category": inventory(
            "category_name",
            "s_inventory join g_product using (product_id)",
            count("sold", "total_units_sold"),
            count("received", "total_units_received"),
            count("shrunk", "total_shrinkage_loss"),
        ),
        "bi_inventory_by_month": inventory(
            "snapshot_month",
            "s_inventory",
            count("sold", "sold_units"),
            count("received", "received_stock"),
            count("shrunk", "shrinkage_loss"),
        ),
        "bi_inventory_by_store": inventory(
            "store_name, city, state_province",
            "s_inventory join g_store using (store_id)",
            count("sold", "total_units_sold"),
            count("shrunk", "total_shrinkage_loss"),
        ),
    }


TRAITS = (
    "customer_id, loyalty_status, income_bracket, age_group, customer_persona, signup_channel, "
    "country, state_province, city"
)
STAGES = ", ".join(
    f"{ids('session_id', flag)} as {short}"
    for flag, short in (
        ("product_page_visited_flag", "v"),
        ("added_to_cart_flag", "c"),
        ("purchased_flag", "p"),
    )
)


def _alternative() -> dict[str, str]:
    sums = f"""
        coalesce(sum(net_line_revenue) {DONE}, 0) as rev, coalesce(sum(net_line_profit) {DONE}, 0) as profit,
        count(distinct transaction_id) {DONE} as orders, coalesce(sum(quantity) {DONE}, 0) as units"""
    rev, profit = money("rev", "net_revenue"), money("profit", "gross_profit")
    orders, units = count("orders"), count("units", "units_sold")

    def sales(keys: str, source: str, *figures: str) -> str:
        return f"select {_names(keys)}, {', '.join(figures)} from (select {keys}, {sums} from {source} group by all)"

    product = "ag_sale s left join ag_product p on s.product_id = p.product_id"
    store = "ag_sale join ag_store using (store_id)"
    day = "ag_sale left join ag_date on transaction_date_id = date_id"
    bought = f"(select transaction_id, sum(net_line_revenue) {DONE} as rev from ag_sale group by 1)"
    stock = """
        sum(sold_units) as sold, sum(received_stock) as received, sum(shrinkage_loss) as shrunk,
        avg(closing_stock) as level, count(*) filter (where backorder_flag) as short, count(*) as snapshots"""
    turnover = "case when level > 0 then sold::DOUBLE / level else 0.0 end as inventory_turnover"
    short = f"{share_alt('short', 'snapshots')} as backorder_rate_pct"

    def inventory(keys: str, source: str, *figures: str) -> str:
        return (
            f"select {keys}, {turnover}, {', '.join(figures)}, {short} "
            f"from (select {keys}, {stock} from {source} group by all)"
        )

    people = f"""
        (select customer_id, count(distinct t.transaction_id) as orders, coalesce(sum(rev), 0) as rev,
                min(transaction_timestamp) as first_order_ts, max(transaction_timestamp) as last_order_ts
         from raw_transaction t left join {bought} b on t.transaction_id = b.transaction_id group by customer_id)"""
    return {
        "bi_kpi_summary_alt": f"""
            select {rev}, {money("listed", "gross_revenue")}, {profit},
                   {margin_alt("profit", "rev")} as gross_margin_pct,
                   {count("done", "total_transactions")}, {count("returned", "returned_transactions")},
                   {count("every", "total_orders")}, {units}, {aov_alt("rev", "done")} as aov,
                   {share_alt("returned", "every")} as return_rate_pct
            from (select {sums}, sum(line_total) as listed from ag_sale),
                 (select count(*) {DONE} as done, count(*) {BACK} as returned, count(*) as every
                  from raw_transaction)""",
        "bi_revenue_by_month_alt": sales(
            "date_trunc('month', date)::DATE as month_start",
            day,
            rev,
            profit,
            f"{margin_alt('profit', 'rev')} as gross_margin_pct",
            orders,
            units,
        ),
        "bi_daily_sales_alt": sales("date as sale_date", day, rev, profit, orders, units, f"{aov_alt('rev', 'orders')} as aov"),
        "bi_sales_by_category_alt": sales("category_name", product, rev, profit, units),
        "bi_sales_by_subcategory_alt": sales("category_name, subcategory_name", product, rev, profit, units),
        "bi_sales_by_brand_alt": sales("brand_name", product, rev, profit, units),
        "bi_top_products_alt": sales("product_name, category_name, brand_name", product, rev, units),
        "bi_sales_by_channel_alt": sales("sales_channel", "ag_sale", rev, orders, f"{aov_alt('rev', 'orders')} as aov"),
        "bi_sales_by_store_alt": sales(
            "store_id, store_name, city, state_province, store_type",
            store,
            rev,
            profit,
            f"{margin_alt('profit', 'rev')} as gross_margin_pct",
            orders,
            f"{aov_alt('rev', 'orders')} as aov",
        ),
        "bi_sales_by_region_alt": sales("country, state_province, city", store, rev, orders),
        "bi_sales_by_weekday_alt": sales(
            "day_of_week, day_name", day, rev, orders, f"{aov_alt('rev', 'orders')} as aov"
        ),
        "bi_returns_by_category_alt": f"""
            select category_name, {money("back", "returned_revenue")}, {count("returned", "returned_orders")},
                   {share_alt("returned", "every")} as return_rate_pct
            from (select category_name, coalesce(sum(net_line_revenue) {BACK}, 0) as back,
                         count(distinct transaction_id) {BACK} as returned, count(distinct transaction_id) as every
                  from {product} group by all)""",
        "bi_sales_by_payment_type_alt": f"""
            select payment_type, {orders}, {rev}, {aov_alt("rev", "orders")} as aov
            from (select payment_type, count(distinct t.transaction_id) {DONE} as orders, coalesce(sum(rev), 0) as rev
                  from raw_transaction t join {bought} b on t.transaction_id = b.transaction_id group by all)""",
        "bi_customer_summary_alt": f"""
            select {TRAITS}, {orders}, {money("rev", "lifetime_revenue")}, first_order_ts, last_order_ts,
                   (AS_OF - last_order_ts::DATE)::INT as days_since_last_order, orders >= 2 as is_repeat_customer
            from (select {TRAITS}, max(orders) as orders, sum(rev) as rev, min(first_order_ts) as first_order_ts,
                         max(last_order_ts) as last_order_ts
                  from ag_customer join {people} using (customer_id) group by all)""",
        "bi_customer_loyalty_mix_alt": f"""
            select loyalty_status, {count("n", "active_customers")}, {count("again", "repeat_customers")},
                   {share_alt("again", "n")} as repeat_rate_pct, {money("total", "net_revenue")},
                   {aov_alt("total", "n")} as avg_revenue_per_customer,
                   {unrounded("every", "n", 16)} as avg_orders_per_customer
            from (select loyalty_status, count(*) as n, count(*) filter (where orders > 1) as again,
                         sum(rev) as total, sum(orders) as every
                  from (select loyalty_status, customer_id, max(orders) as orders, sum(rev) as rev
                        from ag_customer join {people} using (customer_id) group by all)
                  group by loyalty_status)""",
        "bi_customer_new_vs_returning_by_month_alt": f"""
            select month_start,
                   {count(ids("customer_id", "month_start = debut"), "new_customers")},
                   {count(ids("customer_id", "month_start > debut"), "returning_customers")},
                   {money("coalesce(sum(rev) filter (where month_start = debut), 0)", "new_customer_revenue")},
                   {money("coalesce(sum(rev) filter (where month_start > debut), 0)", "returning_customer_revenue")}
            from (select *, min(month_start) over (partition by customer_id) as debut
                  from (select customer_id, rev, date_trunc('month', transaction_timestamp)::DATE as month_start
                        from raw_transaction t left join {bought} b on t.transaction_id = b.transaction_id
                        where customer_id is not null))
            group by month_start""",
        "bi_clickstream_funnel_by_month_alt": f"""
            select month_start, {count("a", "sessions")}, {count("v", "product_view_sessions")},
                   {count("c", "add_to_cart_sessions")}, {count("p", "purchase_sessions")},
                   {share_alt("p", "a")} as conversion_rate_pct, {share_alt("c", "a")} as add_to_cart_rate_pct,
                   {share_alt("a - v", "a")} as bounce_rate_pct, {share_alt("c - p", "c")} as cart_abandonment_pct
            from (select date_trunc('month', session_start_time)::DATE as month_start, {ids("session_id")} as a,
                         {STAGES} from raw_clickstream group by 1)""",
        "bi_funnel_overall_alt": f"""
            select unnest([1, 2, 3, 4]) as step,
                   unnest(['Session', 'Product View', 'Add to Cart', 'Purchase']) as stage,
                   unnest([a, v, c, p])::BIGINT as sessions,
                   unnest([{share_alt("a", "a")}, {share_alt("v", "a")}, {share_alt("c", "a")}, {share_alt("p", "a")}])
                       as pct_of_sessions
            from (select {ids("session_id")} as a, {STAGES} from raw_clickstream)""",
        **{
            name: f"""
            select {key}, {count("a", "sessions")}, {count("p", "purchase_sessions")},
                   {share_alt("p", "a")} as conversion_rate_pct
            from (select {key}, {ids("session_id")} as a, {STAGES} from raw_clickstream group by 1)"""
            for name, key in (
                ("bi_sessions_by_device_alt", "device_type"),
                ("bi_sessions_by_traffic_source_alt", "traffic_source"),
            )
        },
        "bi_campaign_performance_alt": f"""
            select campaign_id, campaign_name, campaign_channel, {count("coalesce(a, 0)", "sessions")},
                   {count("coalesce(n, 0)", "attributed_orders")}, {money("coalesce(rev, 0)", "attributed_revenue")},
                   {share_alt("coalesce(n, 0)", "coalesce(a, 0)")} as conversion_rate_pct
            from raw_campaign
            left join (select campaign_id, {ids("session_id")} as a from raw_clickstream group by 1)
                using (campaign_id)
            left join (select campaign_id, count(distinct transaction_id) {DONE} as n,
                              sum(net_line_revenue) {DONE} as rev from ag_sale group by 1) using (campaign_id)""",
        "bi_promotion_performance_alt": f"""
            select promo_id, promo_name, promo_type, discount_type, {count("n", "promo_orders")},
                   {money("total", "promo_revenue")}, {money("off", "discount_given")},
                   {aov_alt("total", "n")} as avg_revenue_per_promo_txn
            from (select p.promo_id, promo_name, promo_type, discount_type, count(distinct t.transaction_id) as n,
                         coalesce(sum(rev), 0) as total, sum(transaction_discount_applied) as off
                  from a_promotion p join raw_transaction t on p.promo_id = t.promo_id
                  left join {bought} b on t.transaction_id = b.transaction_id group by all)""",
        "bi_inventory_by_category_alt": inventory(
            "category_name",
            "raw_inventory i left join ag_product p on i.product_id = p.product_id",
            count("sold", "total_units_sold"),
            count("received", "total_units_received"),
            count("shrunk", "total_shrinkage_loss"),
        ),
        "bi_inventory_by_month_alt": inventory(
            "snapshot_month",
            "raw_inventory",
            count("sold", "sold_units"),
            count("received", "received_stock"),
            count("shrunk", "shrinkage_loss"),
        ),
        "bi_inventory_by_store_alt": inventory(
            "store_name, city, state_province",
            "raw_inventory join ag_store using (store_id)",
            count("sold", "total_units_sold"),
            count("shrunk", "total_shrinkage_loss"),
        ),
    }


def mart_sql(as_of: str) -> dict[str, str]:
    return {name: sql.replace("AS_OF", as_of) for name, sql in (_standard() | _alternative()).items()}


def grains_sql() -> str:
    """The marts of orders at all their grains, one below the other."""
    columns = {
        "month_start": "DATE", "sale_date": "DATE", "sales_channel": "VARCHAR", "store_id": "BIGINT",
        "store_name": "VARCHAR", "city": "VARCHAR", "state_province": "VARCHAR", "store_type": "VARCHAR",
        "country": "VARCHAR", "day_of_week": "INT", "day_name": "VARCHAR",
    }
    store = "g_sale join g_store using (store_id)"
    grains = {
        "month": ("g_sale", {"month_start": "date_trunc('month', transaction_timestamp)::DATE"}),
        "day": ("g_sale", {"sale_date": "transaction_timestamp::DATE"}),
        "channel": ("g_sale", {"sales_channel": "sales_channel"}),
        "store": (store, {k: k for k in ("store_id", "store_name", "city", "state_province", "store_type")}),
        "region": (store, {k: k for k in ("country", "state_province", "city")}),
        "weekday": ("g_sale join g_date on transaction_date_id = date_id", {k: k for k in ("day_of_week", "day_name")}),
    }
    figures = f"""
        round(sum(net_line_revenue) {DONE}, 2)::DOUBLE as net_revenue,
        round(sum(net_line_profit) {DONE}, 2)::DOUBLE as gross_profit,
        (count(distinct transaction_id) {DONE})::BIGINT as orders, (sum(quantity) {DONE})::BIGINT as units_sold"""
    parts = []
    for grain, (source, keys) in grains.items():
        shown = ", ".join(f"({keys.get(c, 'null')})::{kind} as {c}" for c, kind in columns.items())
        parts.append(f"select '{grain}' as grain, {shown}, {figures} from {source} group by all")
    return "\nunion all ".join(parts)
