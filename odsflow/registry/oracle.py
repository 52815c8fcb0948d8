"""Warehouse tables as SQL over the driver's files, for the comparison queries."""

from __future__ import annotations

import re

_SESSION = "CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d')"
_SOURCE = "(['Email', 'Adwords', 'Organic', 'YouTube', 'Facebook'])[user_id % 5 + 1]"
_BROWSER = "(['IE', 'Edge', 'Chrome', 'Safari', 'Firefox', 'Other'])[user_id % 6 + 1]"
_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_URI = f"""CASE event_type WHEN 'view' THEN '/product/' || {_K} WHEN 'click' THEN '/cart'
    WHEN 'purchase' THEN '/purchase' WHEN 'signup' THEN '/home' ELSE '/cancel/item/' || {_K} END"""

TABLES = {
    "dim_centres": "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation",
    "dim_products": """
        SELECT p_partkey AS product_id,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 0.60 AS DECIMAL(18,2)) AS cost,
               p_type AS category, p_name AS name, p_brand AS brand,
               CAST(p_retailprice AS DECIMAL(18,2)) AS retail_price,
               CASE WHEN p_size <= 25 THEN 'Men' ELSE 'Women' END AS department,
               'SKU' || p_partkey AS sku, p_partkey % 25 AS distribution_center_id
        FROM part""",
    "dim_users": """
        SELECT c_custkey AS user_id, 'Customer' AS first_name,
               CAST(c_custkey AS VARCHAR) AS last_name,
               'customer' || c_custkey || '@example.com' AS email,
               12 + c_custkey % 59 AS age,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               c_name AS city, c_mktsegment AS state, n_name AS country,
               (['Organic', 'Facebook', 'Search', 'Email', 'Display'])[c_custkey % 5 + 1] AS traffic_source,
               TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS created_at,
               TIMESTAMP '1995-01-02 00:00:00' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS updated_at
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "fact_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id,
               CASE o_orderstatus WHEN 'F' THEN 'Complete' WHEN 'O' THEN 'Processing' ELSE 'Shipped' END AS status,
               CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               o_orderdate AS created_at, COALESCE(n, 0) AS num_of_item
        FROM orders LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey)
             ON o_orderkey = l_orderkey""",
    "fact_order_items": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, o_custkey AS user_id,
               l_partkey AS product_id, l_orderkey * 10 + l_linenumber AS inventory_item_id,
               CASE WHEN l_returnflag = 'R' THEN 'Returned'
                    WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'Cancelled'
                    WHEN l_returnflag = 'A' THEN 'Complete'
                    WHEN l_linestatus = 'F' THEN 'Shipped' ELSE 'Processing' END AS status,
               o_orderdate AS created_at, l_shipdate AS shipped_at,
               CASE WHEN l_returnflag = 'R' OR (l_returnflag = 'A' AND l_linestatus = 'F')
                    THEN l_shipdate + to_days(l_linenumber + 1) END AS delivered_at,
               CASE WHEN l_returnflag = 'R' THEN l_shipdate + to_days(l_linenumber + 2) END AS returned_at,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(18,2)) - CAST(l_discount AS DECIMAL(18,2)))
                    AS DECIMAL(18,2)) AS sale_price
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "fact_inventory_items": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS product_id, o_orderdate AS created_at,
               CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS sold_at,
               p.cost, p.category AS product_category, p.name AS product_name, p.brand AS product_brand,
               p.retail_price AS product_retail_price, p.department AS product_department,
               p.sku AS product_sku, l_partkey % 25 AS product_distribution_center_id
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
             LEFT JOIN dim_products p ON l_partkey = p.product_id""",
    "click_events": f"""
        SELECT event_id, ts AS event_timestamp, user_id, {_K} AS sequence_number, {_SESSION} AS session_id,
               {_BROWSER} AS browser, {_SOURCE} AS traffic_source, {_URI} AS uri,
               CASE event_type WHEN 'view' THEN 'product' WHEN 'click' THEN 'cart' WHEN 'purchase' THEN 'purchase'
                    WHEN 'signup' THEN 'home' ELSE 'cancel' END AS event_type,
               CAST(ts AS DATE) AS event_date,
               ts + to_microseconds(CAST(CAST(value AS DECIMAL(18,6)) * 1000000 AS BIGINT)) AS ingested_at,
               CASE event_type WHEN 'view' THEN 'product' WHEN 'click' THEN 'cart' WHEN 'purchase' THEN 'purchase'
                    WHEN 'signup' THEN 'home' ELSE 'post_purchase' END AS page_type,
               CASE WHEN event_type = 'view' THEN {_K} END AS product_id,
               event_type = 'purchase' AS is_conversion,
               CAST(value AS DECIMAL(18,6)) AS event_lag_seconds
        FROM events""",
    "session_events": """
        SELECT event_id, session_id, user_id, traffic_source, browser, event_timestamp, event_type, page_type, product_id,
               product_category
        FROM click_events LEFT JOIN (SELECT product_id, category AS product_category FROM dim_products) USING (product_id)""",
    "session_base": """
        SELECT session_id, user_id, traffic_source, browser, first AS session_start, last AS session_end,
               (epoch_us(last) - epoch_us(first)) // 1000000 AS session_duration_seconds,
               len(kinds) AS event_count,
               len(list_filter(pages, lambda page: page IN ('home', 'department', 'category', 'product'))) AS pageview_count,
               len(list_filter(pages, lambda page: page = 'product')) AS product_view_count,
               len(list_filter(kinds, lambda kind: kind = 'cart')) AS cart_count,
               len(list_filter(kinds, lambda kind: kind = 'purchase')) AS purchase_count,
               list_contains(pages, 'home') AS saw_home, list_contains(pages, 'product') AS saw_product,
               list_contains(kinds, 'cart') AS added_to_cart, list_contains(kinds, 'purchase') AS purchased
        FROM (SELECT session_id, list(event_type) AS kinds, list(page_type) AS pages, min(user_id) AS user_id,
                     min(traffic_source) AS traffic_source, min(browser) AS browser,
                     min(event_timestamp) AS first, max(event_timestamp) AS last
              FROM click_events GROUP BY session_id)""",
    "session_categories": """
        SELECT session_id, category AS product_category, sum(views)::BIGINT AS cnt
        FROM (SELECT session_id, product_id, count(*) AS views FROM click_events GROUP BY ALL)
             JOIN dim_products USING (product_id)
        WHERE category IS NOT NULL GROUP BY ALL""",
    "session_top": """
        SELECT session_id, min_by(product_category, (-cnt, product_category)) AS top_category
        FROM session_categories GROUP BY session_id""",
    "session_summary": """
        SELECT session_id AS session_record_id, session_base.*, top_category, session_start::DATE AS session_date
        FROM session_base LEFT JOIN session_top USING (session_id)""",
    "window_summary": """
        SELECT concat_ws('_', strftime(window_start, '%Y-%m-%d %H:%M:%S'), ifnull(traffic_source, 'unknown'),
                         ifnull(browser, 'unknown'), ifnull(event_type, 'unknown'), ifnull(page_type, 'unknown')) AS aggregate_id,
               window_start, window_start + to_seconds(300) AS window_end, event_date, traffic_source, browser, event_type,
               page_type, sum(n)::BIGINT AS total_events, count(DISTINCT session_id) AS unique_sessions,
               count(DISTINCT user_id) AS unique_users,
               sum(CASE WHEN event_type = 'purchase' THEN n ELSE 0 END)::BIGINT AS purchase_events,
               sum(lag)::DOUBLE / sum(lags) AS avg_event_lag_seconds
        FROM (SELECT event_timestamp - to_microseconds(epoch_us(event_timestamp) % 300000000) AS window_start, event_date,
                     traffic_source, browser, event_type, page_type, session_id, user_id, count(event_id) AS n,
                     sum(event_lag_seconds) AS lag, count(event_lag_seconds) AS lags
              FROM click_events GROUP BY ALL)
        GROUP BY ALL""",
    "sales_flat": """
        WITH item AS (
            SELECT id AS order_item_id, order_id, user_id, product_id, inventory_item_id, sale_price,
                   status AS order_item_status, created_at AS order_item_created_at, created_at::DATE AS order_item_date,
                   shipped_at AS order_item_shipped_at, delivered_at AS order_item_delivered_at,
                   returned_at AS order_item_returned_at, delivered_at::DATE - shipped_at::DATE AS delivery_lead_time_days,
                   shipped_at::DATE - created_at::DATE AS shipping_lead_time_days
            FROM fact_order_items),
        product AS (
            SELECT product_id, cost AS product_cost, retail_price AS product_retail_price, dim_products.name AS product_name,
                   category AS product_category, brand AS product_brand, department AS product_department,
                   sku AS product_sku, dim_centres.name AS distribution_center_name
            FROM dim_products LEFT JOIN dim_centres ON dim_centres.id = distribution_center_id),
        buyer AS (
            SELECT user_id, age AS user_age, gender AS user_gender, city AS user_city, state AS user_state,
                   country AS user_country, traffic_source AS user_traffic_source
            FROM dim_users),
        placed AS (SELECT order_id, num_of_item AS order_num_of_items, status AS order_status FROM fact_orders)
        SELECT *, sale_price - product_cost AS product_profit,
               CASE WHEN sale_price <> 0 THEN (sale_price - product_cost)::DOUBLE / sale_price::DOUBLE END AS profit_margin
        FROM item LEFT JOIN product USING (product_id) LEFT JOIN buyer USING (user_id) LEFT JOIN placed USING (order_id)""",
    "sales_hourly": """
        WITH basket AS (
            SELECT date_trunc('hour', created_at) AS order_hour, product_id, user_id, status IN ('Cancelled', 'Returned') AS undone,
                   status, count(*) AS n, sum(sale_price) AS paid, list(DISTINCT order_id) AS orders
            FROM fact_order_items GROUP BY ALL)
        SELECT order_hour, order_hour::DATE AS order_date, category AS product_category, department AS product_department,
               country AS user_country, gender AS user_gender, sum(n)::BIGINT AS total_items_ordered,
               sum(paid) AS total_revenue, sum(n * cost) AS total_cost, sum(paid - n * cost) AS total_profit,
               len(list_distinct(flatten(list(orders)))) AS total_orders, count(DISTINCT user_id) AS total_customers,
               ifnull(sum(n) FILTER (status = 'Returned'), 0)::BIGINT AS returned_items,
               ifnull(sum(n) FILTER (status = 'Cancelled'), 0)::BIGINT AS cancelled_items,
               ifnull(sum(paid) FILTER (NOT undone), 0) AS net_revenue,
               ifnull(sum(paid - n * cost) FILTER (NOT undone), 0) AS net_profit
        FROM basket LEFT JOIN dim_products USING (product_id) LEFT JOIN dim_users USING (user_id)
        GROUP BY ALL""",
    "product_sales": """
        SELECT product_id, sum(n)::BIGINT AS total_items_ordered,
               ifnull(sum(n) FILTER (status NOT IN ('Cancelled', 'Returned')), 0)::BIGINT AS net_items_sold,
               sum(paid) AS total_revenue,
               ifnull(sum(paid) FILTER (status NOT IN ('Cancelled', 'Returned')), 0) AS net_revenue,
               ifnull(sum(n) FILTER (status = 'Returned'), 0)::BIGINT AS total_returned_items,
               ifnull(sum(n) FILTER (status = 'Cancelled'), 0)::BIGINT AS total_cancelled_items
        FROM (SELECT product_id, status, count(id) AS n, sum(sale_price) AS paid FROM fact_order_items GROUP BY ALL)
        GROUP BY product_id""",
    "product_views": """
        SELECT product_id, sum(n)::BIGINT AS total_page_views, count(*) FILTER (session_id IS NOT NULL) AS unique_view_sessions
        FROM (SELECT product_id, session_id, count(*) AS n FROM click_events WHERE event_type = 'product' GROUP BY ALL)
        GROUP BY product_id""",
    "product_performance": """
        WITH figures AS (
            SELECT product_id, ifnull(total_items_ordered, 0) AS total_items_ordered, ifnull(net_items_sold, 0) AS net_items_sold,
                   ifnull(total_revenue, 0) AS total_revenue, ifnull(net_revenue, 0) AS net_revenue,
                   ifnull(total_returned_items, 0) AS total_returned_items,
                   ifnull(total_cancelled_items, 0) AS total_cancelled_items,
                   ifnull(total_page_views, 0) AS total_page_views, ifnull(unique_view_sessions, 0) AS unique_view_sessions
            FROM (SELECT product_id FROM dim_products) LEFT JOIN product_sales USING (product_id)
                 LEFT JOIN product_views USING (product_id))
        SELECT figures.*, name AS product_name, category AS product_category, brand AS product_brand,
               department AS product_department, sku AS product_sku, retail_price, cost, retail_price - cost AS unit_profit,
               CASE WHEN retail_price <> 0 THEN (retail_price - cost)::DOUBLE / retail_price::DOUBLE END AS unit_margin,
               total_items_ordered * cost AS total_cost, total_revenue - total_items_ordered * cost AS total_profit,
               CASE WHEN total_items_ordered > 0 THEN total_returned_items::DOUBLE / total_items_ordered END AS return_rate,
               CASE WHEN total_page_views > 0 THEN total_items_ordered::DOUBLE / total_page_views END
                   AS view_to_order_conversion_rate
        FROM figures JOIN dim_products USING (product_id)""",
    "trip_summary": """
        SELECT CAST(l_shipdate AS DATE) AS date, 'V' || l_suppkey AS vehicle, l_suppkey % 20 AS route_id,
               CAST(l_suppkey % 20 AS VARCHAR) AS route_no, l_orderkey AS trip_id,
               l_shipdate + to_hours(l_linenumber) AS start_time,
               l_shipdate + to_hours(l_linenumber) + to_minutes(CAST(l_quantity AS INTEGER)) AS end_time,
               l_quantity AS trip_duration_minutes,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.001 AS DECIMAL(18,5)) AS total_distance_km,
               l_linestatus AS direction, l_returnflag AS confidence_score, l_shipdate AS updated_at
        FROM lineitem""",
    "gps_points": f"""
        SELECT date, vehicle, route_no, hour, day_of_week,
               CASE WHEN day_of_week <= 5 THEN 'weekday' ELSE 'weekend' END AS day_type, speed,
               CASE WHEN speed = 0 THEN 'stopped' WHEN speed < 20 THEN 'slow' WHEN speed < 60 THEN 'normal'
                    ELSE 'fast' END AS speed_level, x, y
        FROM (SELECT CAST(ts AS DATE) AS date, 'V' || user_id AS vehicle, CAST(user_id % 20 AS VARCHAR) AS route_no,
                     hour(ts) AS hour, isodow(ts) AS day_of_week,
                     CAST(CASE WHEN event_type = 'error' THEN 0 ELSE value END AS DECIMAL(18,2)) AS speed,
                     {_K} / 100.0::DOUBLE AS x, user_id / 100.0::DOUBLE AS y
              FROM events)""",
    # The click topic, its faults, and where each message has to go.
    "click_messages": f"""
        SELECT event_id, ts, session, user_id, browser, traffic_source, uri, event_type, k,
               CASE WHEN k = 5 THEN NULL WHEN k = 4 THEN '' ELSE
                   '{{"id": ' || CASE WHEN k = 2 THEN '"x"' ELSE CAST(event_id AS VARCHAR) END
                   || ', "user_id": ' || user_id
                   || ', "session_id": ' || CASE WHEN k = 1 THEN 'null' ELSE '"' || session || '"' END
                   || ', "browser": "' || browser || '", "traffic_source": "' || traffic_source
                   || '", "uri": "' || uri || '", "event_type": "' || event_type
                   || '", "created_at": "' || CASE WHEN k = 3 THEN 'bad' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END
                   || '"' || CASE WHEN k = 0 THEN '' ELSE '}}' END END AS raw_message,
               CASE WHEN k = 5 THEN 'none' WHEN k IN (0, 4) THEN 'Invalid JSON format'
                    WHEN k IN (1, 2) OR event_type = 'error' THEN 'Missing required fields or invalid event_type'
                    WHEN k = 3 THEN 'unparseable created_at' ELSE 'valid' END AS verdict
        FROM (SELECT event_id, ts, user_id, {_SESSION} AS session, {_BROWSER} AS browser,
                     {_SOURCE} AS traffic_source, {_URI} AS uri, {_K} AS k,
                     CASE event_type WHEN 'view' THEN 'product' WHEN 'click' THEN 'cart'
                          WHEN 'signup' THEN 'home' ELSE event_type END AS event_type
              FROM events)""",
}


def with_tables(sql: str) -> str:
    """``sql`` with the tables it mentions, and those they mention, defined in front."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in TABLES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    # A name used as a column counts as a mention too; the extra definition does no harm.
    visit(sql)
    sql = sql.strip()
    if not needed:
        return sql
    head = ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in needed)
    if sql[:5].upper() == "WITH ":
        return f"WITH {head},\n{sql[5:]}"
    return f"WITH {head}\n{sql}"
