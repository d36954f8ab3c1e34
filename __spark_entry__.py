
from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import shopledger.plans  # noqa: F401  (registers the datasets)
from oracle.checks import check_sql, guard_sql, source_sql
from oracle.compose import compose
from oracle.marts import grains_sql, mart_sql
from oracle.raw import raw_ctes
from oracle.storage import rebuild_sql, snapshot_sql, views_sql
from oracle.star import shown, star_ctes
from shopledger import Lakehouse, incremental, views
from shopledger.operators.periods import days_where, series_between, store_by_month
from shopledger.operators.report import top_n
from shopledger.plans.marts import sales_grains
from shopledger.quality import checks, expectations, quarantine
from shopledger.sources.catalog import RAW_TABLES
from shopledger.session import app_dir, shuffles_released
from shopledger.sources.landing import DriftingLanding, load_report
from shopledger.sources.reader import RESCUED, ParquetLanding, load_parquet, normalise_headers, rescue, row_counts
from shopledger.sources.sample import SampleRetail
from shopledger.sources.snapshots import SnapshotStore
from shopledger.sources.writer import Buckets

try:
    import corpus_pipeline
    from shopledger.llm import queries as llm_queries
except ImportError:  # the text operators are an optional part
    corpus_pipeline = llm_queries = None

AS_OF = dt.date(2002, 1, 1)
AS_OF_SQL = f"DATE '{AS_OF}'"
CALENDAR_DAYS = "year_quarter = '1996-Q2' AND is_weekend"
SHOWN_FROM, SHOWN_TO = dt.date(1996, 3, 1), dt.date(1996, 5, 31)

# query key -> dataset, and -> common table expression of the SQL counterpart
TABLES = {
    "silver_brand": ("silver_dim_brand", "s_brand"),
    "silver_campaign": ("silver_dim_campaign", "s_campaign"),
    "silver_category": ("silver_dim_category", "s_category"),
    "silver_subcategory": ("silver_dim_subcategory", "s_subcategory"),
    "silver_customer": ("silver_dim_customer", "s_customer"),
    "silver_date": ("silver_dim_date", "s_date"),
    "silver_location": ("silver_dim_location", "s_location"),
    "silver_product": ("silver_dim_product", "s_product"),
    "silver_promotion": ("silver_dim_promotion", "s_promotion"),
    "silver_store": ("silver_dim_store", "s_store"),
    "silver_clickstream": ("silver_fact_clickstream", "s_clickstream"),
    "silver_inventory": ("silver_fact_inventory", "s_inventory"),
    "silver_sale": ("silver_fact_sale", "s_sale"),
    "silver_transaction": ("silver_fact_transaction", "s_transaction"),
    "silver_brand_alt": ("silver_dim_brand_alt", "raw_brand"),
    "silver_campaign_alt": ("silver_dim_campaign_alt", "raw_campaign"),
    "silver_category_alt": ("silver_dim_category_alt", "raw_category"),
    "silver_subcategory_alt": ("silver_dim_subcategory_alt", "raw_subcategory"),
    "silver_date_alt": ("silver_dim_date_alt", "raw_date"),
    "silver_location_alt": ("silver_dim_location_alt", "raw_location"),
    "silver_product_alt": ("silver_dim_product_alt", "raw_product"),
    "silver_store_alt": ("silver_dim_store_alt", "raw_store"),
    "silver_clickstream_alt": ("silver_fact_clickstream_alt", "a_clickstream"),
    "silver_inventory_alt": ("silver_fact_inventory_alt", "a_inventory"),
    "silver_sale_alt": ("silver_fact_sale_alt", "a_sale"),
    "silver_transaction_alt": ("silver_fact_transaction_alt", "raw_transaction"),
    "silver_customer_alt": ("silver_dim_customer_alt", "a_customer"),
    "silver_promotion_alt": ("silver_dim_promotion_alt", "a_promotion"),
    "gold_dim_date": ("gold_dim_date", "g_date"),
    "gold_dim_customer": ("gold_dim_customer", "g_customer"),
    "gold_dim_product": ("gold_dim_product", "g_product"),
    "gold_dim_store": ("gold_dim_store", "g_store"),
    "gold_dim_campaign": ("gold_dim_campaign", "s_campaign"),
    "gold_dim_promotion": ("gold_dim_promotion", "s_promotion"),
    "gold_fact_transaction": ("gold_fact_transaction", "s_transaction"),
    "gold_fact_inventory": ("gold_fact_inventory", "s_inventory"),
    "gold_fact_clickstream": ("gold_fact_clickstream", "s_clickstream"),
    "gold_fact_sale": ("gold_fact_sale", "g_sale"),
    "gold_dim_date_alt": ("gold_dim_date_alt", "ag_date"),
    "gold_dim_customer_alt": ("gold_dim_customer_alt", "ag_customer"),
    "gold_dim_product_alt": ("gold_dim_product_alt", "ag_product"),
    "gold_dim_store_alt": ("gold_dim_store_alt", "ag_store"),
    "gold_fact_sale_alt": ("gold_fact_sale_alt", "ag_sale"),
    "gold_dim_campaign_alt": ("gold_dim_campaign_alt", "raw_campaign"),
    "gold_dim_promotion_alt": ("gold_dim_promotion_alt", "a_promotion"),
    "gold_fact_transaction_alt": ("gold_fact_transaction_alt", "raw_transaction"),
    "gold_fact_inventory_alt": ("gold_fact_inventory_alt", "a_inventory"),
    "gold_fact_clickstream_alt": ("gold_fact_clickstream_alt", "a_clickstream"),
}


def lakehouse(spark: SparkSession, sf_dir: str, dirt: bool = True) -> Lakehouse:
    return Lakehouse(spark, SampleRetail(spark, sf_dir, dirt), AS_OF)


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE with at most 6 fraction digits, and the widest ids as text: forms both engines share."""
    shown = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            wide_id = (field.dataType.precision, field.dataType.scale) == (38, 0)
            value = (F.round(value, 6) if field.dataType.scale > 6 else value).cast("string" if wide_id else "double")
        shown.append(value.alias(field.name))
    return df.select(*shown)


def _dataset_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: comparable(lakehouse(spark, sf_dir).report(name))


def _parquet_load(spark, sf_dir):
    return load_parquet(spark, f"{sf_dir}/orders*.parquet")


def _headers(spark, sf_dir):
    return normalise_headers(lakehouse(spark, sf_dir).raw("dim_brand"))


def _rescue(spark, sf_dir):
    feed = load_parquet(spark, f"{sf_dir}/events.parquet").selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "CASE WHEN event_id % 10 = 0 THEN 'n/a' ELSE CAST(CAST(value AS DECIMAL(12,2)) AS STRING) END AS value",
        "CASE WHEN event_id % 15 = 0 THEN 'unknown' ELSE CAST(user_id AS STRING) END AS user_id",
        "event_type",
        "props",
        "CASE WHEN event_id % 7 = 0 THEN '1.7' ELSE '2' END AS pieces",
        "CASE WHEN event_id % 11 = 0 THEN '12.345' ELSE '12.340' END AS amount",
        "CASE WHEN event_id % 13 = 0 THEN TIMESTAMP_NTZ'2024-01-31 10:20:30' ELSE TIMESTAMP_NTZ'2024-01-31 00:00:00' END AS day",
        "CAST(event_id % 4 AS DOUBLE) / 2 AS half",
    )
    declared = {
        "event_id": "bigint",
        "value": "decimal(12,2)",
        "user_id": "bigint",
        "event_type": "string",
        "pieces": "bigint",
        "amount": "decimal(10,2)",
        "day": "date",
        "half": "bigint",
    }
    return comparable(rescue(feed, declared))


def _schema_drift(spark, sf_dir):
    """Two files of unequal schema in one load: every column is there, and those not declared are rescued."""
    loaded = load_parquet(spark, f"{sf_dir}/{{nation,region}}.parquet")
    return rescue(loaded, {"n_nationkey": "bigint", "n_name": "string"})


def _schema_drift_parts(spark, sf_dir):
    """Orders and events that landed in files of three schemas each: columns added, dropped and of another type."""
    folder = _fresh_folder(spark, "drift")
    orders, events = (load_parquet(spark, f"{sf_dir}/{t}.parquet") for t in ("orders", "events"))
    third, n = F.expr("o_orderkey DIV 32 % 3"), F.col("event_id") % 3
    landed = {
        "orders": [
            orders.filter(third == 0),
            orders.filter(third == 1).withColumn("o_channel", F.expr("concat('c', o_orderkey % 4)")),
            orders.filter(third == 2)
            .drop("o_orderstatus")
            .withColumn("o_custkey", F.expr("if(o_custkey % 10 = 0, 'none', CAST(o_custkey AS STRING))")),
        ],
        "events": [
            events.filter(n == 0).drop("props"),
            events.filter(n == 1).withColumn("user_id", F.expr("user_id + if(user_id % 5 = 0, 0.5, 0)")),
            events.filter(n == 2).withColumn("late", F.col("event_id") + 1),
        ],
    }
    for table, parts in landed.items():
        for part in parts:
            part.write.mode("append").parquet(f"{folder}/{table}.parquet")
    declared = {
        "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string"},
        "events": {"event_id": "bigint", "user_id": "bigint", "props": "string"},
    }
    landing = DriftingLanding(spark, folder, declared)
    drifted = ["o_channel", "o_custkey", "user_id", "late"]

    def shown(table):
        # of what was rescued, those columns that drifted
        kept = F.map_filter(F.from_json(RESCUED, "map<string,string>"), lambda k, _: k.isin(drifted))
        columns = list(declared[table])
        return landing(table).select(
            F.lit(table).alias("table_name"),
            F.col(columns[0]).alias("id"),
            F.col(columns[1]).alias("linked_id"),
            F.col(columns[2]).alias("text"),
            F.array_join(F.transform(F.map_entries(kept), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("drifted"),
        )

    return shown("orders").unionByName(shown("events"))


def _landing_load(spark, sf_dir):
    """All raw tables from a landing folder by their declared columns, after two of them drifted: what was rescued."""
    folder, sample = _fresh_folder(spark, "landing"), SampleRetail(spark, sf_dir)
    for table in RAW_TABLES:
        rows = sample(table)
        if table == "fact_clickstream":
            rows.filter("session_id % 2 = 0").write.parquet(f"{folder}/{table}.parquet")
            rows = rows.filter("session_id % 2 = 1").withColumn("app_version", F.lit("2.1"))
        if table == "fact_transaction":
            quarter = "if(transaction_id % 4 = 0, concat(store_id, 'x'), CAST(store_id AS STRING))"
            rows = rows.withColumn("store_id", F.expr(quarter))
        rows.write.mode("append").parquet(f"{folder}/{table}.parquet")
    return load_report(DriftingLanding(spark, folder, RAW_TABLES), RAW_TABLES)


def _row_counts(spark, sf_dir):
    return row_counts(lakehouse(spark, sf_dir).raw, RAW_TABLES).orderBy("table_name")


def _sink_roundtrip(spark, sf_dir):
    lake = lakehouse(spark, sf_dir).store(["silver_fact_transaction"])
    return comparable(lake.table("silver_fact_transaction"))


def _fresh_folder(spark, name):
    return f"{app_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _by_order(sample, names):
    """Buckets by order for those of the datasets that hold orders or their lines: the sample makes both by a join on the order."""
    keys = [sample.read("lineitem").select("l_orderkey"), sample.read("orders").select("o_orderkey")]
    buckets = Buckets.for_keys("transaction_id", *keys)
    held = ("fact_sale", "fact_transaction", "order_totals")
    return {name: buckets for name in names if buckets and name.removesuffix("_alt").endswith(held)}


def _selective_rebuild(spark, sf_dir):
    """Every standard dataset stored, then one raw table replaced and all brought up to date: rows, and who was rebuilt."""
    folder = _fresh_folder(spark, "rebuild")
    sample, landing = SampleRetail(spark, sf_dir), ParquetLanding(spark, folder)
    lake = Lakehouse(spark, lambda table: (landing if table == "fact_clickstream" else sample)(table), AS_OF)
    names = [name for layer in ("silver", "gold", "mart") for name in lake.standard(layer)]
    store = SnapshotStore(spark, f"{folder}/tables")
    laid_out = _by_order(sample, names)
    sessions = sample("fact_clickstream")
    for landed in (sessions, sessions.filter("session_id % 5 <> 0")):
        with shuffles_released(spark):
            landed.write.mode("overwrite").parquet(f"{folder}/fact_clickstream.parquet")
        snapshot, done = incremental.refresh(lake, store, names, laid_out=laid_out)
    flags = spark.createDataFrame([(d.name, d.rebuilt, d.changed) for d in done], "dataset string, rebuilt boolean, changed boolean")
    return row_counts(snapshot.table, names, "dataset").join(flags, "dataset")


def _snapshots(spark, sf_dir):
    """What a reader of the first build and one of the second find, after a third build that failed half way."""
    lake = lakehouse(spark, sf_dir)
    store = SnapshotStore(spark, _fresh_folder(spark, "snapshots"))
    orders, lines = lake.table("silver_fact_transaction"), lake.table("silver_fact_sale")
    readers = {}
    for name, kept in {"first": "true", "second": "transaction_status = 'Completed'"}.items():
        with store.begin() as build:
            build.write("orders", orders.filter(kept))
            build.write("lines", lines.join(build.table("orders"), "transaction_id", "left_semi"))
        readers[name] = store.snapshot()
    try:
        with store.begin() as build:
            build.write("orders", orders.limit(0))
            build.write("lines", lines.select(F.raise_error(F.lit("half way")).alias("sale_id")))
    except PySparkException:
        readers["last"] = store.snapshot()
    parts = [
        reader.table(table).agg(F.count(F.lit(1)).alias("rows"), F.sum(amount).alias("amount"))
        .select(F.lit(name).alias("reader"), F.lit(table).alias("table_name"), "rows", "amount")
        for name, reader in readers.items()
        for table, amount in {"orders": "transaction_total", "lines": "line_total"}.items()
    ]
    return comparable(reduce(DataFrame.unionByName, parts))


def _sink_views(spark, sf_dir):
    """Three marts and a fact, by the names that SQL users know, through views in the catalogue."""
    lake = lakehouse(spark, sf_dir)
    marts = ["bi_revenue_by_month", "bi_sales_by_channel", "bi_sessions_by_device"]
    store = SnapshotStore(spark, _fresh_folder(spark, "views"))
    snapshot, _ = incremental.refresh(lake, store, ["silver_fact_clickstream", "gold_fact_sale", *marts])
    databases = views.Databases.prefixed(f"views_{uuid.uuid4().hex[:8]}_")
    views.create_views(spark, snapshot, databases)
    return spark.sql(f"""
        SELECT 'month' AS view, CAST(month_start AS STRING) AS name, CAST(net_revenue AS DOUBLE) AS amount, orders AS n
        FROM {databases.mart}.bi_revenue_by_month
        UNION ALL
        SELECT 'channel', sales_channel, CAST(net_revenue AS DOUBLE), orders FROM {databases.mart}.bi_sales_by_channel
        UNION ALL
        SELECT 'device', device_type, CAST(conversion_rate_pct AS DOUBLE), sessions FROM {databases.mart}.bi_sessions_by_device
        UNION ALL
        SELECT 'sessions', traffic_source, NULL, count(*) FROM {databases.gold}.gold_fact_clickstream GROUP BY traffic_source""")


def _mart_row_counts(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    return row_counts(lake.table, lake.standard("mart"), "v", "n")


def _top_products(spark, sf_dir):
    products = lakehouse(spark, sf_dir).table("bi_top_products")
    return comparable(top_n(products, "net_revenue", 15, ["product_name", "category_name", "brand_name"]))


def _orders_by_month(spark, sf_dir):
    lake = Lakehouse(spark, SampleRetail(spark, sf_dir), AS_OF, _fresh_folder(spark, "by-month"))
    return store_by_month(lake, ["gold_order_totals"])


def _date_range(spark, sf_dir):
    """Daily sales of three months, from the stored orders of those months alone."""
    lake = _orders_by_month(spark, sf_dir)
    return comparable(series_between(lake, "bi_daily_sales", "sale_date", SHOWN_FROM, SHOWN_TO))


def _calendar_filter(spark, sf_dir):
    """Daily sales on the weekends of one quarter, told by the calendar."""
    lake = days_where(_orders_by_month(spark, sf_dir), CALENDAR_DAYS)
    return comparable(lake.table("bi_daily_sales"))


def _sales_grains(spark, sf_dir):
    """The marts of orders by month, day, channel, store, region and weekday in one pass."""
    return comparable(sales_grains(lakehouse(spark, sf_dir)))


def _check_query(instances) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: checks.check_results(lakehouse(spark, sf_dir), instances)


def _dq_constraints(spark, sf_dir):
    return checks.check_results(lakehouse(spark, sf_dir), checks.constraint_checks())


def _dq_report(spark, sf_dir):
    return checks.report(checks.check_results(lakehouse(spark, sf_dir), checks.ALL_CHECKS))


def _dq_guard(spark, sf_dir):
    return checks.guard(checks.check_results(lakehouse(spark, sf_dir, dirt=False), checks.ALL_CHECKS))


def _failing_rows(check) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: comparable(check.failing_rows(lakehouse(spark, sf_dir)))


# Of the tables with checks, what tells their rows apart.
ROW_IDS = {
    "silver_fact_transaction": "transaction_id",
    "silver_fact_sale": "sale_id",
    "silver_fact_clickstream": "session_id",
    "silver_fact_inventory": "inventory_id",
    "silver_dim_customer": "customer_id",
    "silver_dim_product": "product_id",
    "silver_dim_date": "date_id",
    "gold_fact_transaction": "transaction_id",
}


def _dq_quarantine(spark, sf_dir):
    """Every stored row of every check, read back, with all the checks that it breaks."""
    lake = Lakehouse(spark, SampleRetail(spark, sf_dir), AS_OF, _fresh_folder(spark, "quarantine"))
    kept = quarantine.quarantine(lake, checks.ALL_CHECKS)
    parts = [
        quarantine.failing_rows(kept, check).select(
            F.lit(check.table).alias("table_name"),
            F.lit(check.name).alias("check_name"),
            F.col(ROW_IDS[check.table]).cast("string").alias("row_id"),
            F.concat_ws("; ", quarantine.BROKEN).alias("broken"),
        )
        for check in checks.ALL_CHECKS
    ]
    return reduce(DataFrame.unionByName, parts)


def _warn_report(spark, sf_dir):
    return expectations.violation_report(lakehouse(spark, sf_dir), expectations.EXPECTATIONS)


def _observed(spark, sf_dir):
    """The violations of every expectation, counted by the writes of a build of both families."""
    sample = SampleRetail(spark, sf_dir)
    lake = Lakehouse(spark, sample, AS_OF, _fresh_folder(spark, "observed"))
    watch = expectations.Watch()
    tables = dict.fromkeys(e.table for e in expectations.EXPECTATIONS)
    in_order = sorted(tables, key=lambda table: table.startswith("gold"))
    lake.store(in_order, prepare=watch.attach, laid_out=_by_order(sample, in_order))
    return spark.createDataFrame(
        watch.counts(), "table_name string, expectation string, action string, rows long, violations long"
    )


def _fail_pass(spark, sf_dir):
    tables = list(dict.fromkeys(e.table for e in expectations.EXPECTATIONS))
    return expectations.enforced_counts(lakehouse(spark, sf_dir), tables)


def entry(spark: SparkSession) -> DataFrame:
    """Net revenue, profit, margin and orders by month, from raw tables to mart."""
    return queries()["bi_revenue_by_month"](spark, "/root/testdata/sf0.001")


def library_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Those of the retail library, all of which have an SQL counterpart."""
    extra_not_null = checks.not_null(
        "silver_fact_transaction.customer_id not null", "silver_fact_transaction", "customer_id"
    )
    extra_values = checks.accepted_values(
        "fact_clickstream.device_type in (desktop,tablet)",
        "silver_fact_clickstream",
        "device_type",
        ["desktop", "tablet"],
    )
    return {
        "src_parquet_load": _parquet_load,
        "src_normalise_headers": _headers,
        "src_rescue_columns": _rescue,
        "src_schema_drift": _schema_drift,
        "src_schema_drift_parts": _schema_drift_parts,
        "src_landing_load": _landing_load,
        "src_row_counts": _row_counts,
        "sink_roundtrip": _sink_roundtrip,
        "mv_selective_rebuild": _selective_rebuild,
        "sink_snapshot": _snapshots,
        "sink_views": _sink_views,
        **{key: _dataset_query(dataset) for key, (dataset, _) in TABLES.items()},
        **{name: _dataset_query(name) for name in mart_sql(AS_OF_SQL)},
        "mart_row_counts": _mart_row_counts,
        "top_n_mart": _top_products,
        "mart_date_range": _date_range,
        "mart_calendar_filter": _calendar_filter,
        "mart_sales_grains": _sales_grains,
        "dq_not_null": _check_query([*checks.NOT_NULL_CHECKS, extra_not_null]),
        "dq_unique": _check_query(checks.UNIQUE_CHECKS),
        "dq_referential": _check_query(checks.REFERENTIAL_CHECKS),
        "dq_accepted_values": _check_query([*checks.ACCEPTED_VALUE_CHECKS, extra_values]),
        "dq_row_rule": _check_query(checks.ROW_RULE_CHECKS),
        "dq_constraints": _dq_constraints,
        "dq_report": _dq_report,
        "dq_guard": _dq_guard,
        "dq_quarantine": _dq_quarantine,
        "dq_failing_rows": _failing_rows(checks.REFERENTIAL_CHECKS[0]),
        **{f"dq_failing_rows_{n}": _failing_rows(check) for n, check in enumerate(checks.ALL_CHECKS, 1)},
        "expect_warn_report": _warn_report,
        "expect_observed": _observed,
        "expect_fail_pass": _fail_pass,
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = library_queries()
    if llm_queries:
        found |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    ctes = raw_ctes() | star_ctes(AS_OF_SQL)
    clean = raw_ctes(dirt=False) | star_ctes(AS_OF_SQL)
    marts = mart_sql(AS_OF_SQL)
    tables = {key: shown(cte) for key, (_, cte) in TABLES.items()}
    statements = source_sql() | tables | marts | check_sql()
    statements["sink_roundtrip"] = shown("s_transaction")
    statements["mart_row_counts"] = "\nunion all ".join(
        f"select '{name}' as v, count(*) as n from ({sql})" for name, sql in marts.items() if not name.endswith("_alt")
    )
    statements["top_n_mart"] = (
        f"select * from ({marts['bi_top_products']}) order by net_revenue desc nulls last, "
        "product_name nulls first, category_name nulls first, brand_name nulls first limit 15"
    )
    statements["mart_date_range"] = (
        f"select * from ({marts['bi_daily_sales']}) where sale_date between '{SHOWN_FROM}' and '{SHOWN_TO}'"
    )
    statements["mart_calendar_filter"] = (
        f"select * from ({marts['bi_daily_sales']}) where sale_date in (select date from g_date where {CALENDAR_DAYS})"
    )
    statements["mart_sales_grains"] = grains_sql()
    composed = {name: compose(ctes, sql) for name, sql in statements.items()}
    composed["mv_selective_rebuild"] = rebuild_sql(ctes, marts)
    composed["sink_views"] = compose(ctes, views_sql(marts))
    composed["sink_snapshot"] = compose(ctes, snapshot_sql())
    composed["dq_guard"] = compose(clean, guard_sql())
    if llm_queries:
        composed |= llm_queries.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            composed["pipeline"] = corpus_pipeline.ORACLE_SQL
    return composed
