"""The 14 raw retail tables derived from order/line/event sample tables.

The sample tables (region nation customer supplier part orders lineitem events) become locations,
customers, stores, products, orders, order lines, web sessions and stock snapshots.  With ``dirt`` the
result carries the defects the cleaning steps and checks are there for: missing and case-variant keys,
duplicate rows, unknown look-ups, impossible prices, empty totals.

Every table is a projection or a partially aggregated grouping of its inputs.  Ids come from business
keys, never from a ranking over a whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The vocabulary of the derived tables.
DUPLICATED_BRAND = "Brand#1"
DUPLICATE_BRAND_ID = 99_000_001
DUPLICATED_CATEGORY = "PROMO"
UNKNOWN_LOCATION = 99
PAYMENT_TYPES = ["Credit Card", "Debit Card", "Cash", "Gift Card", "Apple Pay", "Google Pay", "PayPal"]
LINKED_CAMPAIGNS = 24
LINKED_PROMOTIONS = 48
LATE_PROMOTION = 49
UNDATED_PROMOTION = 50


def name_id(column: str) -> str:
    """An id from a name of up to 12 letters: the letters as digits of a number in base 27. Other names stop the load."""
    number = (
        f"aggregate(split({column}, ''), CAST(0 AS BIGINT), (sum, letter) -> sum * 27 + ascii(letter) - ascii('A') + 1)"
    )
    return (
        f"CASE WHEN {column} RLIKE '^[A-Z]{{1,12}}$' THEN {number}"
        f" WHEN {column} IS NOT NULL THEN raise_error(concat('no id for the name ', {column})) END"
    )


def brand_number(column: str) -> str:
    """The number in a brand's name; other names stop the load."""
    return (
        f"CASE WHEN {column} RLIKE '^Brand#[1-9][0-9]{{0,6}}$' THEN CAST(substr({column}, 7) AS BIGINT)"
        f" WHEN {column} IS NOT NULL THEN raise_error(concat('no id for the brand ', {column})) END"
    )


def key_id(*parts: tuple[str, int]) -> str:
    """An id from a composite key, whose parts stand side by side as decimal digits: (column, digits). A part that has
    more digits than that stops the load, so two keys never share an id."""
    wide = " * CAST(1{} AS DECIMAL(38,0)) + "
    total = ""
    for column, digits in parts:
        total = f"({total}{wide.format('0' * digits) if total else ''}CAST({column} AS DECIMAL(38,0)))"
    fits = " AND ".join(f"{column} BETWEEN 0 AND {10**digits - 1}" for column, digits in parts)
    known = " AND ".join(f"{column} IS NOT NULL" for column, _ in parts)
    return f"CASE WHEN {fits} THEN CAST({total} AS DECIMAL(38,0)) WHEN {known} THEN raise_error('a key is too wide') END"


def day_id(moment: str) -> str:
    return f"CAST(year({moment}) * 10000 + month({moment}) * 100 + day({moment}) AS INT)"


def choose(index: str, *values: str) -> str:
    return f"element_at(array({', '.join(values)}), CAST({index} AS INT) + 1)"


def cents(amount: str) -> str:
    """An amount of two decimals as whole cents, whose sums take fewer bytes than those of decimals on their way."""
    return f"CAST({amount} * 100 AS BIGINT)"


def from_cents(total: str, kind: str) -> str:
    return f"CAST({total} * 0.01BD AS {kind})"


def text(*values: str) -> list[str]:
    return [f"'{v}'" for v in values]


class SampleRetail:
    """``SampleRetail(spark, folder)(table)`` gives one raw table."""

    def __init__(self, spark: SparkSession, folder: str, dirt: bool = True):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.dirt = dirt

    def __call__(self, table: str) -> DataFrame:
        return getattr(self, table)()

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def soil(self, condition: str, dirty: str, clean: str) -> str:
        return f"CASE WHEN {condition} THEN {dirty} ELSE {clean} END" if self.dirt else clean

    def dim_location(self) -> DataFrame:
        nation, region = self.read("nation"), self.read("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
            "n_nationkey AS location_id",
            "lower(r_name) AS country",
            "lower(n_name) AS state_province",
            "concat('city ', n_nationkey) AS city",
            choose("n_nationkey % 3", *text("urban", "SUBURBAN", "rural")) + " AS location_type",
        )

    def dim_customer(self) -> DataFrame:
        k = "c_custkey"
        birth = f"date_add(DATE'1920-01-01', CAST(({k} * 7919) % 30000 AS INT))"
        signup = f"date_add(DATE'1993-01-01', CAST(({k} * 13) % 700 AS INT))"
        own_email = f"concat('user', {k}, '@example.com')"
        case_variant = f"concat('User', {k} - 1, '@Example.com')"
        email = self.soil(f"{k} % 100 = 7", "NULL", self.soil(f"{k} % 25 = 1", case_variant, own_email))
        income = choose(f"{k} % 7", "50000", "100000", "30000", "75000", "150000", "20000", "210000")
        return (
            self.read("customer")
            .selectExpr(
                "*",
                self.soil(f"{k} % 97 = 0", "NULL", birth) + " AS birth_date",
                self.soil(f"{k} % 50 = 1", "NULL", signup) + " AS signup_date",
            )
            .selectExpr(
                f"{k} AS customer_id",
                f"{email} AS email_address",
                choose(f"{k} % 3", *text("ANNA", "ben", "cLaRa")) + " AS first_name",
                "concat(lower(c_mktsegment), ' SMITH') AS last_name",
                choose(f"{k} % 2", *text("Female", "MALE")) + " AS gender",
                choose(f"{k} % 4", *text("bargain hunter", "LOYAL FAN", "Window shopper", "impulse Buyer"))
                + " AS customer_persona",
                "birth_date",
                "year(birth_date) AS birth_year",
                self.soil(f"{k} % 83 = 5", str(UNKNOWN_LOCATION), "c_nationkey") + " AS location_id",
                "signup_date",
                f"{day_id('signup_date')} AS signup_date_id",
                choose(f"{k} % 4", *text("Mobile App", "Online", "In-Store", "Partner")) + " AS signup_channel",
                "CASE WHEN c_acctbal < 0 THEN 'Bronze' WHEN c_acctbal < 3000 THEN 'Silver'"
                " WHEN c_acctbal < 6000 THEN 'GOLD' ELSE 'Platinum' END AS loyalty_status",
                f"CAST({self.soil(f'{k} % 89 = 0', 'NULL', income)} AS DECIMAL(10,2)) AS estimated_annual_income",
                f"{k} % 2 = 0 AS email_opt_in",
                f"{k} % 3 = 0 AS sms_opt_in",
            )
        )

    def dim_category(self) -> DataFrame:
        types = self.read("part").select("p_type").distinct()
        spellings = self.soil(
            f"p_type = '{DUPLICATED_CATEGORY}'", "array(lower(p_type), p_type)", "array(lower(p_type))"
        )
        return types.selectExpr(f"{name_id('p_type')} AS category_id", f"explode({spellings}) AS category_name")

    def dim_subcategory(self) -> DataFrame:
        types = self.read("part").select("p_type").distinct()
        return types.selectExpr(
            f"{name_id('p_type')} AS category_id", "p_type", "explode(array(0, 1, 2)) AS tier"
        ).selectExpr(
            "category_id * 10 + tier AS subcategory_id",
            "concat(lower(p_type), ' range ', tier) AS subcategory_name",
            "category_id",
        )

    def dim_brand(self) -> DataFrame:
        brands = self.read("part").select("p_brand").distinct()
        own = brand_number("p_brand")
        ids = self.soil(
            f"p_brand = '{DUPLICATED_BRAND}'", f"array({own}, {DUPLICATE_BRAND_ID})", f"array({own})"
        )
        return brands.selectExpr(f"explode({ids}) AS Brand_ID", "p_brand AS Brand_Name")

    def dim_product(self) -> DataFrame:
        k = "p_partkey"
        priced = self.read("part").selectExpr("*", "CAST(p_retailprice AS DECIMAL(10,2)) AS price")
        cost = self.soil(
            f"{k} % 150 = 9", "price", self.soil(f"{k} % 170 = 11", "NULL", "round(price * 0.6, 2)")
        )
        names = self.soil(f"{k} % 100 = 2", "array(p_name, upper(p_name))", "array(p_name)")
        return priced.selectExpr(
            f"{k} AS product_id",
            f"explode({names}) AS product_name",
            f"{name_id('p_type')} AS category_id",
            f"{name_id('p_type')} * 10 + p_size % 3 AS subcategory_id",
            self.soil(f"{k} % 200 = 3", str(DUPLICATE_BRAND_ID), brand_number("p_brand")) + " AS brand_id",
            f"CAST({cost} AS DECIMAL(10,2)) AS unit_cost",
            "price AS unit_price",
            "p_size % 4 AS warranty_years",
            "CASE WHEN p_size > 25 THEN 'premium line' ELSE 'VALUE line' END AS product_segment",
        )

    def dim_store(self) -> DataFrame:
        k = "s_suppkey"
        return (
            self.read("supplier")
            .selectExpr("*", f"date_add(DATE'1985-01-01', CAST(({k} * 97) % 3000 AS INT)) AS opening_date")
            .selectExpr(
                f"{k} AS store_id",
                f"concat('store ', {k}) AS store_name",
                "s_nationkey AS location_id",
                "CASE WHEN s_acctbal < 3000 THEN 'mall' WHEN s_acctbal < 7000 THEN 'STREET' ELSE 'Outlet' END"
                " AS store_type",
                f"CAST(500 + ({k} * 41) % 2000 AS INT) AS store_size",
                "opening_date",
                f"{day_id('opening_date')} AS opening_date_id",
                f"CAST(1 + {k} % 100 AS INT) AS foot_traffic_index",
            )
        )

    def dim_date(self) -> DataFrame:
        span = self.read("orders").agg(
            F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last")
        )
        return span.selectExpr("explode(sequence(first, last, INTERVAL 1 DAY)) AS date").selectExpr(
            f"{day_id('date')} AS date_id",
            "date",
            "year(date) AS year",
            "quarter(date) AS quarter",
            "month(date) AS month",
            "date_format(date, 'MMMM') AS month_name",
            "day(date) AS day",
            "weekofyear(date) AS week_of_year",
            "weekday(date) + 1 AS day_of_week",
            "date_format(date, 'EEEE') AS day_name",
            "weekday(date) >= 5 AS is_weekend",
            "day(date) = 1 AS is_month_start",
            "date = last_day(date) AS is_month_end",
        )

    def dim_campaign(self) -> DataFrame:
        """One campaign per brand; the last one is linked to no fact."""
        return (
            self.read("part")
            .selectExpr("try_cast(substr(p_brand, 7) AS INT) AS k")
            .filter("k IS NOT NULL")
            .distinct()
            .selectExpr(
                "k",
                "CAST(date_add(DATE'1996-01-01', 60 * k) AS TIMESTAMP_NTZ) AS starts",
                "CAST(date_add(DATE'1996-01-01', 60 * k + 45) AS TIMESTAMP_NTZ) AS ends",
            )
            .selectExpr(
                "k AS campaign_id",
                "concat('campaign ', k) AS campaign_name",
                choose("k % 4", *text("EMAIL", "Social", "Search", "TV")) + " AS campaign_channel",
                "1 + k % 8 AS promo_id",
                "starts AS campaign_start_date",
                f"{day_id('starts')} AS campaign_start_date_id",
                "ends AS campaign_end_date",
                f"{day_id('ends')} AS campaign_end_date_id",
            )
        )

    def dim_promotion(self) -> DataFrame:
        """One promotion per product size; one is a later repeat of promotion 1, one has no start."""
        start = "CAST(date_add(DATE'1996-01-01', 40 * k) AS TIMESTAMP_NTZ)"
        end = "CAST(date_add(DATE'1996-01-01', 40 * k + 30) AS TIMESTAMP_NTZ)"
        return (
            self.read("part")
            .selectExpr("p_size AS k")
            .distinct()
            .selectExpr("k", self.soil(f"k = {UNDATED_PROMOTION}", "NULL", start) + " AS starts", f"{end} AS ends")
            .selectExpr(
                self.soil(f"k = {LATE_PROMOTION}", "1", "k") + " AS promo_id",
                "concat('promo ', k) AS promo_name",
                choose("k % 3", *text("seasonal", "CLEARANCE", "loyalty")) + " AS promo_type",
                choose("k % 2", *text("percentage", "FIXED")) + " AS discount_type",
                "CAST(5 * k AS DECIMAL(10,2)) AS discount_value",
                "starts AS promo_start_date",
                f"{day_id('starts')} AS promo_start_date_id",
                "ends AS promo_end_date",
                f"{day_id('ends')} AS promo_end_date_id",
                "30 AS promo_duration",
                "k % 2 = 0 AS is_active",
            )
        )

    def fact_transaction(self) -> DataFrame:
        k = "o_orderkey"
        lines = (
            self.read("lineitem")
            .selectExpr(
                "l_orderkey AS o_orderkey",
                "l_suppkey",
                "CAST(l_extendedprice AS DECIMAL(10,2)) AS price",
                "CAST(l_discount AS DECIMAL(4,2)) AS rate",
                "CAST(l_quantity AS INT) AS quantity",
            )
            .groupBy("o_orderkey")
            .agg(
                F.min("l_suppkey").alias("store_id"),
                F.sum(F.expr(cents("price"))).alias("subtotal"),
                F.sum(F.expr(cents("round(price * rate, 2)"))).alias("discount"),
                F.sum(F.expr(cents("round(price * 0.6, 2)"))).alias("cost"),
                F.sum("quantity").alias("items"),
            )
            .selectExpr(
                "o_orderkey",
                "store_id",
                from_cents("subtotal", "DECIMAL(20,2)") + " AS subtotal",
                from_cents("discount", "DECIMAL(24,2)") + " AS discount",
                from_cents("cost", "DECIMAL(22,2)") + " AS cost",
                "items",
            )
        )
        return (
            self.read("orders")
            .join(lines, "o_orderkey", "left")
            .selectExpr(
                f"{k} AS transaction_id",
                "o_orderdate AS transaction_timestamp",
                f"{day_id('o_orderdate')} AS transaction_date_id",
                self.soil(f"{k} % 61 = 0", "NULL", "o_custkey") + " AS customer_id",
                "store_id",
                "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'In-Store' WHEN '2' THEN 'Web'"
                " WHEN '3' THEN 'Web' ELSE 'MOBILE' END AS sales_channel",
                f"CASE WHEN {k} % 2 = 0 THEN {k} END AS session_id",
                f"CASE WHEN {k} % 3 = 0 THEN 1 + {k} % {LINKED_PROMOTIONS} END AS promo_id",
                f"CASE WHEN {k} % 4 = 1 THEN 1 + {k} % {LINKED_CAMPAIGNS} END AS campaign_id",
                self.soil(f"{k} % 500 = 4 AND subtotal IS NOT NULL", "0", "subtotal") + " AS transaction_subtotal",
                self.soil(f"{k} % 300 = 5", "NULL", "discount") + " AS transaction_discount_applied",
                "subtotal - discount AS transaction_total",
                "cost AS transaction_cost",
                "items AS items_count",
                choose(f"{k} % 7", *text(*PAYMENT_TYPES)) + " AS payment_type",
                "CASE WHEN o_orderstatus = 'P' THEN 'Returned' ELSE 'Completed' END AS transaction_status",
            )
        )

    def fact_sale(self) -> DataFrame:
        lines = self.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
        orders = self.read("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
        unit_cents = "(2 * cents + pieces) DIV (2 * nullif(pieces, 0))"
        # what is made of a line's columns doesn't travel to its order beside them
        placed = lines.join(orders, "l_orderkey").selectExpr(
            "*",
            "CAST(l_extendedprice AS DECIMAL(10,2)) AS price",
            "CAST(round(l_extendedprice * 100) AS BIGINT) AS cents",
            "CAST(l_quantity AS BIGINT) AS pieces",
        )
        return placed.selectExpr(
            key_id(("l_orderkey", 14), ("l_linenumber", 2), ("l_partkey", 11), ("cents", 11)) + " AS sale_id",
            "l_orderkey AS transaction_id",
            "CASE WHEN l_orderkey % 2 = 0 THEN l_orderkey END AS session_id",
            "o_orderdate AS transaction_timestamp",
            f"{day_id('o_orderdate')} AS transaction_date_id",
            "l_partkey AS product_id",
            "CAST(l_quantity AS INT) AS quantity",
            f"CAST(({unit_cents}) * 6 DIV 10 * 0.01 AS DECIMAL(10,2)) AS unit_cost",
            f"CAST({unit_cents} * 0.01 AS DECIMAL(10,2)) AS unit_price",
            "CAST(round(price * 0.6, 2) AS DECIMAL(10,2)) AS line_cost",
            "price AS line_total",
            "CASE WHEN price > 25000 THEN 'high' ELSE 'low' END AS aov_category",
        )

    def fact_clickstream(self) -> DataFrame:
        """One session per user and day of events, moved by 0 to 5 months to cover half a year."""
        key = "try_cast(regexp_extract(props, '[0-9]+', 0) AS INT)"
        days = (
            self.read("events")
            .groupBy("user_id", F.col("ts").cast("date").alias("day"))
            .agg(
                F.min("event_id").alias("k"),
                F.expr("min(ts) + make_ym_interval(0, CAST(user_id % 6 AS INT))").alias("starts"),
                F.expr("max(ts) + make_ym_interval(0, CAST(user_id % 6 AS INT))").alias("ends"),
                F.count(F.lit(1)).alias("pages"),
                F.expr(f"min({key})").alias("prop"),
                *[
                    F.max(F.col("event_type") == kind).alias(name)
                    for name, kind in (("viewed", "view"), ("clicked", "click"), ("bought", "purchase"))
                ],
            )
        )
        copies = self.soil("k % 400 = 7", "array(1, 2)", "array(1)")
        return (
            days.withColumn("copy", F.expr(f"explode({copies})"))
            .selectExpr(
                "k AS session_id",
                "CASE WHEN user_id % 13 = 0 THEN NULL ELSE user_id END AS customer_id",
                "starts AS session_start_time",
                f"{day_id('starts')} AS session_start_date_id",
                "ends AS session_end_time",
                f"{day_id('ends')} AS session_end_date_id",
                choose("prop % 3", *text("desktop", " mobile " if self.dirt else "mobile", "tablet"))
                + " AS device_type",
                "pages AS number_of_pages_viewed",
                self.soil("k % 500 = 3", "false", "viewed") + " AS product_page_visited_flag",
                "viewed AND clicked AS added_to_cart_flag",
                self.soil("k % 500 = 3", "true", "viewed AND clicked AND bought") + " AS purchased_flag",
                self.soil(
                    "k % 1000 = 0",
                    "'Direct'",
                    choose("k % 5", *text("Campaign", "Organic", "Direct", "Email", "Referral")),
                )
                + " AS traffic_source",
                "k % 5 = 0 AS linked_to_a_campaign_flag",
                f"CASE WHEN k % 5 = 0 THEN 1 + k % {LINKED_CAMPAIGNS} END AS campaign_id",
                "CASE WHEN pages > 3 THEN 'high' ELSE 'low' END AS aov_category",
            )
        )

    def inventory(self) -> DataFrame:
        stocked = (
            self.read("lineitem")
            .selectExpr(
                "l_partkey AS product_id",
                "l_suppkey AS store_id",
                "CAST(trunc(CAST(l_shipdate AS DATE), 'MM') AS DATE) AS snapshot_month",
                "CAST(l_quantity AS BIGINT) AS quantity",
            )
            .groupBy("product_id", "store_id", "snapshot_month")
            .agg(F.sum("quantity").alias("sold_units"))
            .selectExpr(
                "*",
                "40 + (7 * product_id + 3 * store_id) % 60 AS starting_stock",
                "(5 * product_id + store_id) % 40 AS received_stock",
                "(product_id + store_id) % 3 AS shrinkage_loss",
            )
        )
        closing = "starting_stock + received_stock - sold_units - shrinkage_loss"
        return stocked.selectExpr(
            key_id(("product_id", 15), ("store_id", 14), (day_id("snapshot_month"), 8)) + " AS inventory_id",
            "product_id",
            "store_id",
            "snapshot_month",
            "starting_stock",
            "received_stock",
            "sold_units",
            (closing if self.dirt else f"greatest({closing}, 0)") + " AS closing_stock",
            "sold_units > starting_stock AS backorder_flag",
            "shrinkage_loss",
        )
