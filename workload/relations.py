"""SQL definitions of the raw feeds and of every model, for the checking engine.

``with_relations`` puts the relations a statement needs in front of it as CTEs.
"""

from __future__ import annotations


def money_sum(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def _replayed(table: str, key: str) -> str:
    return f"(SELECT * FROM {table} UNION ALL SELECT * FROM {table} WHERE {key} % 125 = 0) AS delivered"


def _blank_to_null(column: str) -> str:
    return f"NULLIF(trim({column}), '')"


_RAW = {
    "raw_customers": """
        SELECT ' ' || c_custkey::VARCHAR AS customer_id,
               (DATE '1993-01-01' + CAST(c_custkey % 1200 AS INTEGER))::VARCHAR AS signup_date,
               lower(n_name) AS country,
               CASE WHEN c_custkey % 50 = 0 THEN '' ELSE c_mktsegment END AS segment,
               ['true', 'false', 'TRUE', 'False', '1', '0'][c_custkey % 6 + 1] AS marketing_opt_in,
               ['organic', 'Paid_Search', 'referral', 'social', 'email'][c_custkey % 5 + 1] AS acquisition_channel
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "raw_products": """
        SELECT p_partkey::VARCHAR AS product_id,
               p_name AS product_name,
               p_type AS category,
               CASE WHEN p_partkey % 97 = 0 THEN '' ELSE (p_size * 3)::VARCHAR || '.00' END AS list_price,
               (p_size * 3 * (p_partkey % 40 + 35) // 100)::VARCHAR || '.'
                   || lpad((p_size * 3 * (p_partkey % 40 + 35) % 100)::VARCHAR, 2, '0') AS cost_price,
               CASE WHEN p_partkey % 4 = 3 THEN 'false' ELSE 'True' END AS is_active
        FROM part""",
    "raw_orders": f"""
        SELECT ' ' || o_orderkey::VARCHAR || ' ' AS order_id,
               CASE WHEN o_custkey % 67 = 0 THEN 'N' ELSE '' END || o_custkey::VARCHAR AS customer_id,
               strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad((o_orderkey % 24)::VARCHAR, 2, '0') || ':00:00'
                   AS ordered_at,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'Completed '
                   ELSE CASE o_orderkey % 2 WHEN 0 THEN 'cancelled' ELSE 'REFUNDED' END END AS status,
               ['web', 'Mobile_App', 'marketplace', 'retail_store'][o_orderkey % 4 + 1] AS channel,
               o_orderpriority AS payment_method,
               ['EUR', 'eur', 'EUR', 'USD', 'usd', 'GBP'][o_orderkey % 6 + 1] AS currency,
               CASE WHEN o_orderkey % 20 = 0 THEN ''
                   ELSE (o_orderkey % 1290 // 100)::VARCHAR || '.' || lpad((o_orderkey % 1290 % 100)::VARCHAR, 2, '0')
               END AS shipping_cost
        FROM {_replayed("orders", "o_orderkey")}""",
    "raw_order_lines": f"""
        SELECT ' ' || l_orderkey::VARCHAR || ' ' AS order_id,
               l_linenumber::VARCHAR AS line_number,
               CASE WHEN l_partkey % 211 = 0 THEN 'N' ELSE '' END || l_partkey::VARCHAR AS product_id,
               ((CASE WHEN l_returnflag = 'R' AND l_linenumber % 3 = 0 THEN -1 ELSE 1 END)
                   * (CAST(l_quantity AS INTEGER) % 6 + 1))::VARCHAR AS quantity,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.0002 AS DECIMAL(6,4)) AS DECIMAL(12,2))::VARCHAR
                   AS unit_price,
               CASE WHEN l_orderkey % 50 = 0 THEN '' ELSE CAST(l_discount AS DECIMAL(6,4))::VARCHAR END AS discount_pct
        FROM {_replayed("lineitem", "l_orderkey")}""",
    "raw_web_events": """
        SELECT event_id::VARCHAR AS event_id,
               user_id::VARCHAR AS customer_id,
               CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
                   WHEN 'signup' THEN 'checkout_start' WHEN 'purchase' THEN 'checkout_complete'
                   ELSE 'search' END AS event_type,
               strftime(DATE '1995-01-01' + CAST(event_id // 8 % 2400 AS INTEGER), '%Y-%m-%d') || ' '
                   || strftime(ts, '%H:%M:%S') AS occurred_at,
               'S' || (event_id // 8)::VARCHAR AS session_id,
               ['Desktop', 'mobile', 'tablet'][user_id % 3 + 1] AS device
        FROM events""",
}

_STAGING = {
    "stg_customers": f"""
        SELECT trim(customer_id) AS customer_id,
               {_blank_to_null("signup_date")} AS signup_date,
               CAST(left({_blank_to_null("signup_date")}, 4) AS INTEGER) AS signup_year,
               left(trim(signup_date), 7) AS signup_month,
               upper(trim(country)) AS country,
               coalesce(lower({_blank_to_null("segment")}), 'unknown') AS segment,
               CAST(lower(trim(marketing_opt_in)) IN ('true', '1', 'yes', 'y') AS INTEGER) AS is_marketing_opt_in,
               lower(trim(acquisition_channel)) AS acquisition_channel
        FROM raw_customers WHERE trim(customer_id) <> ''""",
    "stg_products": f"""
        SELECT *, round(list_price - cost_price, 2) AS unit_margin
        FROM (
            SELECT trim(product_id) AS product_id, trim(product_name) AS product_name,
                   lower(trim(category)) AS category,
                   {_blank_to_null("list_price")}::DOUBLE AS list_price,
                   {_blank_to_null("cost_price")}::DOUBLE AS cost_price,
                   CAST(lower(trim(is_active)) = 'true' AS INTEGER) AS is_active
            FROM raw_products WHERE trim(product_id) <> '')""",
    "stg_orders": f"""
        SELECT order_id, NULLIF(customer_id, '') AS customer_id, ordered_at,
               left(ordered_at, 10) AS order_date, left(ordered_at, 7) AS order_month,
               left(ordered_at, 4)::INTEGER AS order_year, ordered_at[12:13]::INTEGER AS order_hour,
               lower(status) AS status, lower(channel) AS channel, lower(payment_method) AS payment_method,
               upper(currency) AS currency, coalesce({_blank_to_null("shipping_cost")}::DOUBLE, 0) AS shipping_cost,
               CAST(lower(status) = 'completed' AS INTEGER) AS is_completed
        FROM (
            SELECT trim(COLUMNS(*)) FROM raw_orders WHERE trim(order_id) <> ''
            QUALIFY row_number() OVER (PARTITION BY trim(order_id) ORDER BY trim(ordered_at), trim(customer_id),
                trim(status), trim(channel), trim(payment_method), trim(currency), trim(shipping_cost)) = 1)""",
    "stg_order_lines": f"""
        SELECT *, round(quantity * unit_price, 2) AS gross_amount,
               round(quantity * unit_price * discount_pct, 2) AS discount_amount,
               round(quantity * unit_price * (1.0::DOUBLE - discount_pct), 2) AS net_amount,
               CAST(quantity < 0 AS INTEGER) AS is_return
        FROM (
            SELECT trim(order_id) AS order_id, {_blank_to_null("line_number")}::INTEGER AS line_number,
                   trim(product_id) AS product_id, {_blank_to_null("quantity")}::INTEGER AS quantity,
                   {_blank_to_null("unit_price")}::DOUBLE AS unit_price,
                   coalesce({_blank_to_null("discount_pct")}::DOUBLE, 0) AS discount_pct
            FROM raw_order_lines WHERE trim(order_id) <> ''
            QUALIFY row_number() OVER (PARTITION BY trim(order_id), trim(line_number)
                ORDER BY trim(product_id), trim(quantity), trim(unit_price), trim(discount_pct)) = 1)""",
    "stg_web_events": """
        SELECT trim(event_id) AS event_id, trim(customer_id) AS customer_id, lower(trim(event_type)) AS event_type,
               trim(occurred_at) AS occurred_at, left(trim(occurred_at), 10) AS event_date,
               left(trim(occurred_at), 7) AS event_month, trim(session_id) AS session_id, lower(trim(device)) AS device
        FROM raw_web_events WHERE trim(event_id) <> ''""",
}

_CORE = {
    "dim_customer": """
        SELECT *, 0 AS is_unknown_member FROM stg_customers
        UNION ALL BY NAME
        SELECT 'UNKNOWN' AS customer_id, 'XX' AS country, 'unknown' AS segment, 0 AS is_marketing_opt_in,
               'unknown' AS acquisition_channel, 1 AS is_unknown_member""",
    "dim_product": """
        SELECT *,
               CASE WHEN coalesce(list_price, 0) = 0 THEN 'unknown' WHEN unit_margin / list_price >= 0.5 THEN 'high'
                   WHEN unit_margin / list_price >= 0.3 THEN 'medium' ELSE 'low' END AS margin_band,
               CASE WHEN list_price < 20 THEN 'budget' WHEN list_price < 80 THEN 'mid' ELSE 'premium' END AS price_band
        FROM stg_products""",
    "dim_date": """
        SELECT strftime(d, '%Y-%m-%d') AS date_key, year(d)::INTEGER AS year_number, month(d)::INTEGER AS month_number,
               day(d)::INTEGER AS day_number, strftime(d, '%Y-%m') AS month_key,
               quarter(d)::INTEGER AS quarter_number, isodow(d)::INTEGER AS iso_weekday, dayname(d) AS weekday_name,
               CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend
        FROM (SELECT DISTINCT order_date::DATE AS d FROM stg_orders)""",
    "fct_orders": f"""
        SELECT o.order_id, coalesce(m.customer_id, 'UNKNOWN') AS customer_key, o.customer_id AS source_customer_id,
               o.order_date, o.order_month, o.order_year, o.order_hour, o.status, o.channel, o.payment_method,
               o.currency, o.is_completed, coalesce(t.n, 0) AS line_count,
               CAST(coalesce(t.quantity, 0) AS BIGINT) AS total_quantity, coalesce(t.gross, 0) AS gross_amount,
               coalesce(t.discount, 0) AS discount_amount, coalesce(t.net, 0) AS net_amount, o.shipping_cost,
               round(coalesce(t.net, 0) + o.shipping_cost, 2) AS total_amount,
               coalesce(t.any_return, 0) AS has_return_line, CAST(m.customer_id IS NULL AS INTEGER) AS is_orphan_customer
        FROM stg_orders o
        LEFT JOIN (
            SELECT order_id, count(*) AS n, sum(quantity) AS quantity, {money_sum("gross_amount")} AS gross,
                   {money_sum("discount_amount")} AS discount, {money_sum("net_amount")} AS net,
                   max(is_return) AS any_return
            FROM stg_order_lines GROUP BY ALL) t USING (order_id)
        LEFT JOIN (SELECT customer_id FROM dim_customer WHERE is_unknown_member = 0) m ON m.customer_id = o.customer_id""",
    "fct_order_lines": """
        SELECT concat(order_id, '-', line_number) AS order_line_key, order_id, line_number, product_id, o.customer_id,
               o.order_date, o.order_month, o.channel, o.status, p.category, p.margin_band, p.price_band, quantity,
               unit_price, discount_pct, gross_amount, discount_amount, net_amount,
               round(quantity * coalesce(p.cost_price, 0), 2) AS cost_amount,
               round(net_amount - quantity * coalesce(p.cost_price, 0), 2) AS gross_profit, is_return
        FROM stg_order_lines JOIN stg_orders o USING (order_id) LEFT JOIN dim_product p USING (product_id)""",
}

_MARTS = {
    "mart_daily_revenue": f"""
        SELECT order_date, any_value(month_key) AS month_key, any_value(weekday_name) AS weekday_name,
               any_value(is_weekend) AS is_weekend, channel, count(*) AS order_count,
               count(DISTINCT customer_key) AS customer_count, {money_sum("gross_amount")} AS gross_revenue,
               {money_sum("discount_amount")} AS discount_total, {money_sum("net_amount")} AS net_revenue,
               round(CAST(sum(CAST(shipping_cost AS DECIMAL(18,6))) AS DOUBLE), 2) AS shipping_revenue,
               round({money_sum("net_amount")} / count(*), 2) AS average_order_value
        FROM fct_orders JOIN dim_date ON date_key = order_date
        WHERE is_completed = 1 GROUP BY order_date, channel""",
    "mart_customer_value": f"""
        SELECT customer_id, country, segment, acquisition_channel, signup_month,
               coalesce(n, 0) AS order_count, coalesce(net, 0) AS lifetime_net_revenue,
               round(coalesce(net / n, 0), 2) AS average_order_value, first_order_date, last_order_date,
               CAST(coalesce(returns, 0) AS BIGINT) AS orders_with_returns,
               CASE WHEN net >= 1500 THEN 'platinum' WHEN net >= 600 THEN 'gold' WHEN net >= 150 THEN 'silver'
                   WHEN n > 0 THEN 'bronze' ELSE 'no_purchase' END AS value_tier,
               CASE WHEN last_order_date IS NULL THEN 'never_ordered'
                   WHEN left(last_order_date, 7) >= left(max(last_order_date) OVER (), 7) THEN 'active_this_month'
                   ELSE 'lapsed' END AS recency_bucket
        FROM dim_customer
        FULL JOIN (
            SELECT customer_key, count(*) AS n, {money_sum("net_amount")} AS net, min(order_date) AS first_order_date,
                   max(order_date) AS last_order_date, sum(has_return_line) AS returns
            FROM fct_orders WHERE is_completed = 1 GROUP BY ALL) s ON s.customer_key = customer_id
        QUALIFY is_unknown_member = 0""",
    "mart_category_performance": f"""
        SELECT order_month, category, count(DISTINCT order_id) AS order_count,
               CAST(sum(quantity) AS BIGINT) AS units_sold, {money_sum("gross_amount")} AS gross_revenue,
               {money_sum("net_amount")} AS net_revenue, {money_sum("cost_amount")} AS cost_of_goods,
               {money_sum("gross_profit")} AS gross_profit,
               round(100.0::DOUBLE * {money_sum("gross_profit")} / nullif({money_sum("net_amount")}, 0), 2)
                   AS gross_margin_pct,
               round(100.0::DOUBLE * count(*) FILTER (is_return = 1) / count(*), 2) AS return_line_pct
        FROM fct_order_lines WHERE status = 'completed' AND category IS NOT NULL GROUP BY ALL""",
    "mart_channel_funnel": f"""
        SELECT v.*, round(100.0::DOUBLE * add_to_carts / nullif(page_views, 0), 2) AS cart_rate_pct,
               round(100.0::DOUBLE * checkout_starts / nullif(add_to_carts, 0), 2) AS checkout_rate_pct,
               round(100.0::DOUBLE * checkout_completes / nullif(checkout_starts, 0), 2) AS completion_rate_pct,
               coalesce(n, 0) AS completed_orders, coalesce(net, 0) AS net_revenue
        FROM (
            SELECT event_month, count(DISTINCT session_id) AS sessions,
                   count(*) FILTER (event_type = 'page_view') AS page_views,
                   count(*) FILTER (event_type = 'add_to_cart') AS add_to_carts,
                   count(*) FILTER (event_type = 'checkout_start') AS checkout_starts,
                   count(*) FILTER (event_type = 'checkout_complete') AS checkout_completes
            FROM stg_web_events GROUP BY ALL) v
        LEFT JOIN (SELECT order_month, count(*) AS n, {money_sum("net_amount")} AS net
                   FROM fct_orders WHERE is_completed = 1 GROUP BY ALL) s ON s.order_month = v.event_month""",
}

RELATIONS: dict[str, str] = {**_RAW, **_STAGING, **_CORE, **_MARTS}


def _needed(sql: str, found: dict[str, None]) -> dict[str, None]:
    """Names of the relations a text mentions, parents first."""
    for name, body in RELATIONS.items():
        if name in sql and name not in found:
            _needed(body, found)
            found[name] = None
    return found


def with_relations(sql: str) -> str:
    names = _needed(sql, {})
    if not names:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({RELATIONS[n]})" for n in names) + "\n" + sql
