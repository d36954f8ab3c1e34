"""What stored tables hold after builds, in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Mapping

from oracle.checks import GOLD_TABLES, SILVER_TABLES, union
from oracle.compose import compose

# The datasets that read web sessions, directly or not.
FROM_SESSIONS = [
    "silver_fact_clickstream",
    "gold_fact_clickstream",
    "bi_clickstream_funnel_by_month",
    "bi_funnel_overall",
    "bi_sessions_by_device",
    "bi_sessions_by_traffic_source",
    "bi_campaign_performance",
]


def rebuild_sql(ctes: Mapping[str, str], marts: Mapping[str, str]) -> str:
    """Rows of every standard dataset after a fifth of the sessions went, and which of them had to be rebuilt."""
    fewer = dict(ctes) | {"raw_clickstream": f"select * from ({ctes['raw_clickstream']}) where session_id % 5 <> 0"}
    sources = {name: cte for name, (cte, _) in (SILVER_TABLES | GOLD_TABLES).items()}
    keys = "transaction_id, transaction_timestamp, transaction_date_id, store_id, sales_channel, transaction_status"
    sources["gold_order_totals"] = f"(select distinct {keys} from g_sale)"
    sources |= {name: f"({sql})" for name, sql in marts.items() if not name.endswith("_alt")}
    flag = {name: str(name in FROM_SESSIONS).lower() for name in sources}
    counts = [
        f"select '{name}' as dataset, count(*) as rows, {flag[name]} as rebuilt, {flag[name]} as changed from {source}"
        for name, source in sources.items()
    ]
    return compose(fewer, union(counts))


def snapshot_sql() -> str:
    kept = {"first": "true", "second": "o.transaction_status = 'Completed'", "last": "o.transaction_status = 'Completed'"}
    parts = []
    for reader, condition in kept.items():
        parts.append(
            f"select '{reader}' as reader, 'orders' as table_name, count(*) as rows, "
            f"sum(transaction_total)::DOUBLE as amount from s_transaction o where {condition}"
        )
        parts.append(
            f"select '{reader}', 'lines', count(*), sum(line_total)::DOUBLE from s_sale l "
            f"where exists (from s_transaction o where o.transaction_id = l.transaction_id and {condition})"
        )
    return union(parts)


def views_sql(marts: Mapping[str, str]) -> str:
    month, channel, device = (f"({marts[m]})" for m in ("bi_revenue_by_month", "bi_sales_by_channel", "bi_sessions_by_device"))
    return f"""
        select 'month' as view, month_start::VARCHAR as name, net_revenue::DOUBLE as amount, orders::BIGINT as n
        from {month}
        union all
        select 'channel', sales_channel, net_revenue::DOUBLE, orders::BIGINT from {channel}
        union all
        select 'device', device_type, conversion_rate_pct::DOUBLE, sessions::BIGINT from {device}
        union all
        select 'sessions', traffic_source, null, count(*)::BIGINT from s_clickstream group by traffic_source"""
