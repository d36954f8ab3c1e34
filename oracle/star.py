"""Cleaned tables and star schema (standard ``s_``/``g_``, alternative ``a_``) in DuckDB SQL."""

from __future__ import annotations

from oracle.exact import half_up, shorten


def title(column: str) -> str:
    """Capitalise each space-separated word and lower the rest."""
    return (
        f"array_to_string(list_transform(string_split(lower({column}), ' '), "
        f"lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def star_ctes(as_of: str) -> dict[str, str]:
    share = half_up("line_total * 100", "transaction_subtotal * 100", 13)
    rate = half_up("transaction_discount_applied * 100", "transaction_subtotal * 100", 13)
    discount_cents = "(coalesce(transaction_discount_applied, 0) * 100)::HUGEINT"
    line_cents = "(line_total * 100)::HUGEINT"

    def allocated(scaled: str) -> str:
        return f"({shorten(scaled, 13)}::DECIMAL(24, 0) * 0.01)::DECIMAL(24, 2)"

    line = """l.sale_id, l.transaction_id, l.session_id, l.transaction_timestamp, l.transaction_date_id,
              l.product_id, l.quantity, l.unit_cost, l.unit_price, l.line_cost, l.line_total"""
    parent = "o.store_id, o.customer_id, o.sales_channel, o.campaign_id, o.promo_id, o.transaction_status"
    return {
        # --- cleaned -------------------------------------------------------------------------------
        "s_brand": "select min(brand_id) as brand_id, brand_name from raw_brand group by brand_name",
        "s_campaign": "select * replace (lower(campaign_channel) as campaign_channel) from raw_campaign",
        "s_category": f"""
            select category_id, {title("category_name")} as category_name
            from (select category_id, category_name from raw_category group by all)""",
        "s_subcategory": f"select * replace ({title('subcategory_name')} as subcategory_name) from raw_subcategory",
        "s_customer": f"""
            with clean as (
                select * replace (
                    lower(email_address) as email_address, {title("first_name")} as first_name,
                    {title("last_name")} as last_name, lower(gender) as gender,
                    {title("customer_persona")} as customer_persona, lower(loyalty_status) as loyalty_status,
                    coalesce(map {{'mobile app': 'mobile', 'online': 'web', 'in-store': 'store'}}
                             [lower(signup_channel)], lower(signup_channel)) as signup_channel)
                from raw_customer
                qualify row_number() over (partition by lower(email_address)
                                           order by signup_date nulls first, customer_id) = 1),
            aged as (
                select *, (year({as_of}) - year(birth_date)
                           - (strftime({as_of}, '%m%d') < strftime(birth_date, '%m%d'))::INT)::INT as age from clean)
            select * exclude (estimated_annual_income),
                   -- fixed values: bands
                   case when age between 18 and 24 then '18-24'
                        when age between 25 and 34 then '25-34'
                        when age between 35 and 44 then '35-44'
                        when age between 45 and 54 then '45-54'
                        else '55+' end as age_group,
                   case when estimated_annual_income < 50000 then 'Low Income'
                        when estimated_annual_income between 50000 and 100000 then 'Middle Income'
                        else 'High Income' end as income_bracket
            from aged""",
        "s_date": "select *, day(last_day(date))::INT as days_in_month from raw_date",
        "s_location": f"""
            select location_id, {title("country")} as country, {title("state_province")} as state_province,
                   {title("city")} as city, {title("location_type")} as location_type from raw_location""",
        "s_product": f"""
            select distinct on (product_id, product_name) *
            from (select * replace ({title("product_name")} as product_name,
                                    {title("product_segment")} as product_segment) from raw_product)
            where unit_price - unit_cost > 0""",
        "s_promotion": f"""
            select * exclude (promo_duration)
                   replace ({title("promo_name")} as promo_name, {title("promo_type")} as promo_type,
                            {title("discount_type")} as discount_type)
            from (select * from raw_promotion
                  qualify row_number() over (partition by promo_id
                                             order by promo_start_date nulls first, promo_end_date nulls first,
                                                      promo_name nulls first) = 1)
            where promo_start_date is not null""",
        "s_store": f"""
            select * replace ({title("store_name")} as store_name, {title("store_type")} as store_type)
            from raw_store""",
        "s_clickstream": """
            select * exclude (aov_category) replace (trim(device_type) as device_type) from raw_clickstream""",
        "s_inventory": """
            select *, strftime(snapshot_month, '%Y%m')::INT as snapshot_month_id from raw_inventory""",
        "s_sale": "select * exclude (aov_category) from raw_sale",
        "s_transaction": """
            select * replace (if(sales_channel = 'In-Store', 'store', lower(sales_channel)) as sales_channel)
            from raw_transaction""",
        # --- star ----------------------------------------------------------------------------------
        "g_date": """
            select *, strftime(date, '%Y%m')::INT as month_id, format('{}-Q{}', year, quarter) as year_quarter
            from s_date""",
        "g_customer": """
            select c.* exclude (birth_date, birth_year, age, location_id), l.* exclude (location_id)
            from s_customer c, s_location l where c.location_id = l.location_id""",
        "g_product": """
            select p.* exclude (product_segment), brand_name, category_name, subcategory_name
            from s_product p, s_brand b, s_category c, s_subcategory s
            where p.brand_id = b.brand_id and p.category_id = c.category_id
              and p.subcategory_id = s.subcategory_id""",
        "g_store": """
            select s.* exclude (location_id), l.* exclude (location_id)
            from s_store s, s_location l where s.location_id = l.location_id""",
        "g_sale": f"""
            select * exclude (transaction_subtotal, transaction_discount_applied),
                   line_total - allocated_line_discount as net_line_revenue,
                   line_total - allocated_line_discount - line_cost as net_line_profit
            from (select *, {allocated(f"({share} * {discount_cents})")} as allocated_line_discount
                  from (select {line}, {parent}, o.transaction_subtotal, o.transaction_discount_applied
                        from s_sale l, s_transaction o where l.transaction_id = o.transaction_id))""",
        # --- alternative ---------------------------------------------------------------------------
        "a_customer": f"""
            select * exclude (birth_date, birth_year, estimated_annual_income, age), age,
                   case when age < 18 then 'Under 18' when age < 25 then '18-24' when age < 35 then '25-34'
                        when age < 45 then '35-44' when age < 55 then '45-54' when age < 65 then '55-64'
                        else '65+' end as age_group,
                   case when estimated_annual_income < 30000 then 'Low'
                        when estimated_annual_income <= 75000 then 'Medium'
                        when estimated_annual_income <= 150000 then 'High' else 'Premium' end as income_bracket
            from (select *, year({as_of}) - birth_year as age from raw_customer)""",
        "a_promotion": f"""
            select * replace (promo_start_date::DATE <= {as_of} and {as_of} <= promo_end_date::DATE as is_active)
            from raw_promotion""",
        "a_sale": "select * exclude (aov_category) from raw_sale",
        "a_clickstream": "select * exclude (aov_category) from raw_clickstream",
        "a_inventory": """
            select *, year(snapshot_month) * 100 + month(snapshot_month) as snapshot_month_id from raw_inventory""",
        "ag_date": """
            select *, year * 100 + month as month_id, format('{}Q{}', year, quarter) as year_quarter from raw_date""",
        "ag_customer": """
            select c.* exclude (age, location_id), l.* exclude (location_id)
            from a_customer c left join raw_location l on c.location_id = l.location_id""",
        "ag_store": """
            select s.* exclude (location_id), l.* exclude (location_id)
            from raw_store s left join raw_location l on s.location_id = l.location_id""",
        "ag_product": """
            select p.* exclude (product_segment), brand_name, category_name, subcategory_name
            from raw_product p left join raw_brand b on p.brand_id = b.brand_id
            left join raw_category c on p.category_id = c.category_id
            left join raw_subcategory s on p.subcategory_id = s.subcategory_id""",
        "ag_sale": f"""
            select * exclude (transaction_subtotal, transaction_discount_applied),
                   line_total - coalesce(allocated_line_discount, 0) as net_line_revenue,
                   line_total - coalesce(allocated_line_discount, 0) - line_cost as net_line_profit
            from (select *, {allocated(f"({line_cents} * {rate})")} as allocated_line_discount
                  from (select {line}, {parent}, o.transaction_subtotal, o.transaction_discount_applied
                        from raw_sale l left join raw_transaction o on l.transaction_id = o.transaction_id))""",
    }


_LINE = ["unit_cost", "unit_price", "line_cost", "line_total"]
_NET_LINE = [*_LINE, "allocated_line_discount", "net_line_revenue", "net_line_profit"]
_ORDER = ["transaction_subtotal", "transaction_discount_applied", "transaction_total", "transaction_cost"]
_PRICE = ["unit_cost", "unit_price"]

_PRODUCT_IDS = ["category_id", "subcategory_id", "brand_id"]

# Columns shown as DOUBLE (money), ids shown as BIGINT, and ids shown as text.
SHOWN_AS = {
    "s_brand": ([], ["brand_id"]),
    "s_campaign": ([], ["campaign_id", "promo_id"]),
    "s_category": ([], ["category_id"]),
    "s_subcategory": ([], ["subcategory_id", "category_id"]),
    "s_customer": ([], ["location_id"]),
    "s_location": ([], ["location_id"]),
    "s_product": (_PRICE, ["category_id", "subcategory_id", "brand_id"]),
    "s_promotion": (["discount_value"], ["promo_id"]),
    "s_store": ([], ["location_id"]),
    "s_sale": (_LINE, [], ["sale_id"]),
    "s_inventory": ([], [], ["inventory_id"]),
    "s_transaction": (_ORDER, []),
    "raw_brand": ([], ["brand_id"]),
    "raw_campaign": ([], ["campaign_id", "promo_id"]),
    "raw_category": ([], ["category_id"]),
    "raw_subcategory": ([], ["subcategory_id", "category_id"]),
    "raw_product": (_PRICE, _PRODUCT_IDS),
    "raw_transaction": (_ORDER, []),
    "a_sale": (_LINE, [], ["sale_id"]),
    "a_inventory": ([], ["snapshot_month_id"], ["inventory_id"]),
    "a_promotion": (["discount_value"], []),
    "g_product": (_PRICE, ["category_id", "subcategory_id", "brand_id"]),
    "g_sale": (_NET_LINE, [], ["sale_id"]),
    "ag_product": (_PRICE, []),
    "ag_sale": (_NET_LINE, [], ["sale_id"]),
}


def shown(cte: str, condition: str = "true") -> str:
    money, ids, *wide = SHOWN_AS.get(cte, ([], []))
    casts = [f"{c}::DOUBLE as {c}" for c in money] + [f"{c}::BIGINT as {c}" for c in ids]
    casts += [f"{c}::VARCHAR as {c}" for c in (wide[0] if wide else [])]
    replace = f" replace ({', '.join(casts)})" if casts else ""
    return f"select *{replace} from {cte} where {condition}"
