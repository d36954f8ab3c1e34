"""The 14 raw tables, derived from the sample tables in DuckDB SQL."""

from __future__ import annotations


def raw_ctes(dirt: bool = True) -> dict[str, str]:
    def soil(condition: str, dirty: str, clean: str) -> str:
        return f"(case when {condition} then {dirty} else {clean} end)" if dirt else f"({clean})"

    def name_id(column: str) -> str:
        letters = f"list_transform(string_split({column}, ''), lambda c: (ascii(c) - 64)::BIGINT)"
        return f"list_reduce({letters}, lambda x, y: x * 27 + y)"

    def brand_number(column: str) -> str:
        return f"replace({column}, 'Brand#', '')::BIGINT"

    def digits(column: str, width: int) -> str:
        return f"lpad(({column})::VARCHAR, {width}, '0')"

    def day_id(moment: str) -> str:
        return f"strftime({moment}, '%Y%m%d')::INT"

    mobile = " mobile " if dirt else "mobile"
    closing = "starting_stock + received_stock - sold_units - shrinkage_loss"
    unit = "((2 * cents + pieces) // (2 * nullif(pieces, 0)))"
    return {
        "raw_location": """
            select n_nationkey as location_id, lower(r_name) as country, lower(n_name) as state_province,
                   'city ' || n_nationkey as city,
                   (['urban', 'SUBURBAN', 'rural'])[n_nationkey % 3 + 1] as location_type
            from nation, region where n_regionkey = r_regionkey""",
        "raw_customer": f"""
            select k as customer_id,
                   {soil("k % 100 = 7", "null", soil("k % 25 = 1", "'User' || (k - 1) || '@Example.com'",
                         "'user' || k || '@example.com'"))} as email_address,
                   (['ANNA', 'ben', 'cLaRa'])[k % 3 + 1] as first_name,
                   lower(c_mktsegment) || ' SMITH' as last_name,
                   (['Female', 'MALE'])[k % 2 + 1] as gender,
                   (['bargain hunter', 'LOYAL FAN', 'Window shopper', 'impulse Buyer'])[k % 4 + 1]
                       as customer_persona,
                   birth_date, year(birth_date)::INT as birth_year,
                   {soil("k % 83 = 5", "99", "c_nationkey")} as location_id,
                   signup_date, {day_id("signup_date")} as signup_date_id,
                   (['Mobile App', 'Online', 'In-Store', 'Partner'])[k % 4 + 1] as signup_channel,
                   case when c_acctbal < 0 then 'Bronze' when c_acctbal < 3000 then 'Silver'
                        when c_acctbal < 6000 then 'GOLD' else 'Platinum' end as loyalty_status,
                   {soil("k % 89 = 0", "null", "([50000, 100000, 30000, 75000, 150000, 20000, 210000])[k % 7 + 1]")}
                       ::DECIMAL(10, 2) as estimated_annual_income,
                   k % 2 = 0 as email_opt_in, k % 3 = 0 as sms_opt_in
            from (select *, c_custkey as k,
                         {soil("c_custkey % 97 = 0", "null",
                               "DATE '1920-01-01' + ((c_custkey * 7919) % 30000)::INT")} as birth_date,
                         {soil("c_custkey % 50 = 1", "null",
                               "DATE '1993-01-01' + ((c_custkey * 13) % 700)::INT")} as signup_date
                  from customer)""",
        "raw_category": f"""
            select distinct {name_id("p_type")} as category_id, lower(p_type) as category_name from part
            """
        + ("union all select distinct " + name_id("p_type") + ", p_type from part where p_type = 'PROMO'" if dirt else ""),
        "raw_subcategory": f"""
            select distinct {name_id("p_type")} * 10 + tier as subcategory_id,
                   lower(p_type) || ' range ' || tier as subcategory_name, {name_id("p_type")} as category_id
            from part, (values (0), (1), (2)) t(tier)""",
        "raw_brand": f"""
            select distinct {brand_number("p_brand")} as brand_id, p_brand as brand_name from part
            """
        + ("union all select distinct 99000001, p_brand from part where p_brand = 'Brand#1'" if dirt else ""),
        "raw_product": f"""
            select p_partkey as product_id, unnest(names) as product_name, {name_id("p_type")} as category_id,
                   {name_id("p_type")} * 10 + p_size % 3 as subcategory_id,
                   {soil("p_partkey % 200 = 3", "99000001", brand_number("p_brand"))} as brand_id,
                   {soil("p_partkey % 150 = 9", "price",
                         soil("p_partkey % 170 = 11", "null", "round(price * 0.6, 2)"))}::DECIMAL(10, 2) as unit_cost,
                   price as unit_price, p_size % 4 as warranty_years,
                   case when p_size > 25 then 'premium line' else 'VALUE line' end as product_segment
            from (select *, p_retailprice::DECIMAL(10, 2) as price,
                         {soil("p_partkey % 100 = 2", "[p_name, upper(p_name)]", "[p_name]")} as names
                  from part)""",
        "raw_store": f"""
            select s_suppkey as store_id, 'store ' || s_suppkey as store_name, s_nationkey as location_id,
                   case when s_acctbal < 3000 then 'mall' when s_acctbal < 7000 then 'STREET' else 'Outlet' end
                       as store_type,
                   (500 + (s_suppkey * 41) % 2000)::INT as store_size, opening_date,
                   {day_id("opening_date")} as opening_date_id, (1 + s_suppkey % 100)::INT as foot_traffic_index
            from (select *, DATE '1985-01-01' + ((s_suppkey * 97) % 3000)::INT as opening_date from supplier)""",
        "raw_date": f"""
            select {day_id("d")} as date_id, d as date, year(d)::INT as year, quarter(d)::INT as quarter,
                   month(d)::INT as month, monthname(d) as month_name, day(d)::INT as day,
                   weekofyear(d)::INT as week_of_year, isodow(d)::INT as day_of_week, dayname(d) as day_name,
                   isodow(d) > 5 as is_weekend, day(d) = 1 as is_month_start, d = last_day(d) as is_month_end
            from (select unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, interval 1 day))
                         ::DATE as d from orders)""",
        "raw_campaign": f"""
            select k as campaign_id, 'campaign ' || k as campaign_name,
                   (['EMAIL', 'Social', 'Search', 'TV'])[k % 4 + 1] as campaign_channel, 1 + k % 8 as promo_id,
                   starts as campaign_start_date, {day_id("starts")} as campaign_start_date_id,
                   ends as campaign_end_date, {day_id("ends")} as campaign_end_date_id
            from (select k, (DATE '1996-01-01' + 60 * k)::TIMESTAMP as starts,
                         (DATE '1996-01-01' + 60 * k + 45)::TIMESTAMP as ends
                  from (select distinct try_cast(p_brand[7:] as INT) as k from part) where k is not null)""",
        "raw_promotion": f"""
            select {soil("k = 49", "1", "k")} as promo_id, 'promo ' || k as promo_name,
                   (['seasonal', 'CLEARANCE', 'loyalty'])[k % 3 + 1] as promo_type,
                   (['percentage', 'FIXED'])[k % 2 + 1] as discount_type,
                   (5 * k)::DECIMAL(10, 2) as discount_value, starts as promo_start_date,
                   {day_id("starts")} as promo_start_date_id, ends as promo_end_date,
                   {day_id("ends")} as promo_end_date_id, 30 as promo_duration, k % 2 = 0 as is_active
            from (select k, {soil("k = 50", "null", "(DATE '1996-01-01' + 40 * k)::TIMESTAMP")} as starts,
                         (DATE '1996-01-01' + 40 * k + 30)::TIMESTAMP as ends
                  from (select distinct p_size as k from part))""",
        "raw_transaction": f"""
            select k as transaction_id, o_orderdate as transaction_timestamp,
                   {day_id("o_orderdate")} as transaction_date_id,
                   {soil("k % 61 = 0", "null", "o_custkey")} as customer_id, store_id,
                   case o_orderpriority[1] when '1' then 'In-Store' when '2' then 'Web' when '3' then 'Web'
                        else 'MOBILE' end as sales_channel,
                   case when k % 2 = 0 then k end as session_id,
                   case when k % 3 = 0 then 1 + k % 48 end as promo_id,
                   case when k % 4 = 1 then 1 + k % 24 end as campaign_id,
                   {soil("k % 500 = 4 and subtotal is not null", "0", "subtotal")}::DECIMAL(18, 2)
                       as transaction_subtotal,
                   {soil("k % 300 = 5", "null", "discount")}::DECIMAL(18, 2) as transaction_discount_applied,
                   (subtotal - discount)::DECIMAL(18, 2) as transaction_total,
                   cost::DECIMAL(18, 2) as transaction_cost, items::BIGINT as items_count,
                   (['Credit Card', 'Debit Card', 'Cash', 'Gift Card', 'Apple Pay', 'Google Pay', 'PayPal'])[k % 7 + 1]
                       as payment_type,
                   case when o_orderstatus = 'P' then 'Returned' else 'Completed' end as transaction_status
            from (select *, o_orderkey as k from orders)
            left join (select l_orderkey, min(l_suppkey) as store_id, sum(price) as subtotal,
                              sum(round(price * l_discount::DECIMAL(4, 2), 2)) as discount,
                              sum(round(price * 0.6, 2)) as cost, sum(l_quantity::INT) as items
                       from (select *, l_extendedprice::DECIMAL(10, 2) as price from lineitem)
                       group by l_orderkey) on k = l_orderkey""",
        "raw_sale": f"""
            select (l_orderkey || {digits("l_linenumber", 2)} || {digits("l_partkey", 11)} || {digits("cents", 11)})::DECIMAL(38, 0)
                       as sale_id,
                   l_orderkey as transaction_id, case when l_orderkey % 2 = 0 then l_orderkey end as session_id,
                   o_orderdate as transaction_timestamp, {day_id("o_orderdate")} as transaction_date_id,
                   l_partkey as product_id, l_quantity::INT as quantity,
                   (({unit} * 6 // 10)::DECIMAL(18, 0) * 0.01)::DECIMAL(10, 2) as unit_cost,
                   ({unit}::DECIMAL(18, 0) * 0.01)::DECIMAL(10, 2) as unit_price,
                   round(price * 0.6, 2)::DECIMAL(10, 2) as line_cost, price as line_total,
                   case when price > 25000 then 'high' else 'low' end as aov_category
            from (select *, l_extendedprice::DECIMAL(10, 2) as price, round(l_extendedprice * 100)::BIGINT as cents,
                         l_quantity::BIGINT as pieces from lineitem)
            join orders on l_orderkey = o_orderkey""",
        "raw_clickstream": f"""
            select k as session_id, case when user_id % 13 = 0 then null else user_id end as customer_id,
                   starts as session_start_time, {day_id("starts")} as session_start_date_id,
                   ends as session_end_time, {day_id("ends")} as session_end_date_id,
                   (['desktop', '{mobile}', 'tablet'])[prop % 3 + 1] as device_type,
                   pages as number_of_pages_viewed,
                   {soil("k % 500 = 3", "false", "viewed")} as product_page_visited_flag,
                   viewed and clicked as added_to_cart_flag,
                   {soil("k % 500 = 3", "true", "viewed and clicked and bought")} as purchased_flag,
                   {soil("k % 1000 = 0", "'Direct'",
                         "(['Campaign', 'Organic', 'Direct', 'Email', 'Referral'])[k % 5 + 1]")} as traffic_source,
                   k % 5 = 0 as linked_to_a_campaign_flag,
                   case when k % 5 = 0 then 1 + k % 24 end as campaign_id,
                   case when pages > 3 then 'high' else 'low' end as aov_category
            from (select *, unnest({soil("k % 400 = 7", "[1, 2]", "[1]")}) as copy
                  from (select user_id, min(event_id) as k, count(*) as pages,
                               min(ts) + to_months((user_id % 6)::INT) as starts,
                               max(ts) + to_months((user_id % 6)::INT) as ends,
                               min(try_cast(regexp_extract(props, '[0-9]+') as INT)) as prop,
                               bool_or(event_type = 'view') as viewed, bool_or(event_type = 'click') as clicked,
                               bool_or(event_type = 'purchase') as bought
                        from events group by user_id, ts::DATE))""",
        "raw_inventory": f"""
            select (product_id || {digits("store_id", 14)} || strftime(snapshot_month, '%Y%m%d'))::DECIMAL(38, 0) as inventory_id, product_id, store_id,
                   snapshot_month, starting_stock, received_stock, sold_units,
                   {closing if dirt else f"greatest({closing}, 0)"} as closing_stock,
                   sold_units > starting_stock as backorder_flag, shrinkage_loss
            from (select l_partkey as product_id, l_suppkey as store_id,
                         date_trunc('month', l_shipdate)::DATE as snapshot_month,
                         sum(l_quantity::BIGINT)::BIGINT as sold_units,
                         40 + (7 * l_partkey + 3 * l_suppkey) % 60 as starting_stock,
                         (5 * l_partkey + l_suppkey) % 40 as received_stock,
                         (l_partkey + l_suppkey) % 3 as shrinkage_loss
                  from lineitem group by all)""",
    }
