"""The registered queries as SQL over the given tables, written from the queries' meaning for another engine."""

from __future__ import annotations

from checks.registry import LOAD_ENDS

# Raw retail tables, as in sample_tables.
RAW_SQL = """
raw_customers AS (
    SELECT CASE WHEN c_custkey % 101 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS customer_id,
           '  ' || lower(c_mktsegment) || '-' || upper(r_name) AS first_name,
           'o''clerk ' || CAST(c_custkey % 40 AS VARCHAR) || ' ' AS last_name,
           c_mktsegment || '.' || CAST(c_custkey AS VARCHAR) || '@Example.COM ' AS email,
           n_name AS city,
           lower(r_name) AS country,
           CASE WHEN c_custkey % 13 = 0 THEN 'not a date'
                WHEN c_custkey % 17 = 0
                    THEN strftime(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER), '%m/%d/%Y')
                WHEN c_custkey % 19 <> 0
                    THEN strftime(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER), '%Y-%m-%d')
           END AS signup_date
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
raw_products AS (
    SELECT CASE WHEN p_partkey % 97 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS product_id,
           ' ' || p_name AS product_name,
           lower(p_type) || '/' || CAST(p_size % 5 AS VARCHAR) AS category,
           CASE WHEN p_partkey % 89 = 0 THEN 'on request'
                ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS unit_price
    FROM part
),
raw_orders AS (
    SELECT CASE WHEN l_orderkey % 211 <> 0 THEN CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) END AS order_id,
           CAST(o_custkey AS VARCHAR) AS customer_id,
           CAST(l_partkey AS VARCHAR) AS product_id,
           CASE WHEN l_suppkey % 10 = 1 THEN 'n/a'
                WHEN l_suppkey % 10 = 2 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.7'
                WHEN l_suppkey % 10 <> 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
           CASE WHEN l_suppkey % 23 = 3 THEN 'soon' ELSE CAST(o_orderdate AS VARCHAR) END AS order_ts,
           CASE o_orderstatus WHEN 'P' THEN 'CANCELLED' WHEN 'O' THEN 'Pending ' ELSE ' completed' END AS status,
           l_shipdate AS _loaded_at
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def _title(column: str) -> str:
    """Capital after white space or punctuation other than an apostrophe."""
    runs = rf"regexp_extract_all({column}, '[A-Za-z0-9'']+|[^A-Za-z0-9'']+')"
    return f"array_to_string(list_transform({runs}, lambda x: upper(x[1]) || lower(x[2:])), '')"


STG_SQL = f"""
stg_customers AS (
    SELECT CAST(customer_id AS BIGINT) AS customer_id,
           {_title("trim(first_name, ' ')")} AS first_name,
           {_title("trim(last_name, ' ')")} AS last_name,
           lower(trim(email, ' ')) AS email,
           {_title("trim(city, ' ')")} AS city,
           {_title("trim(country, ' ')")} AS country,
           coalesce(TRY_CAST(signup_date AS DATE), CAST(try_strptime(signup_date, '%m/%d/%Y') AS DATE)) AS signup_date
    FROM raw_customers WHERE customer_id IS NOT NULL
),
stg_products AS (
    SELECT CAST(product_id AS BIGINT) AS product_id,
           trim(product_name, ' ') AS product_name,
           {_title("trim(category, ' ')")} AS category,
           TRY_CAST(unit_price AS DECIMAL(10,2)) AS unit_price
    FROM raw_products WHERE product_id IS NOT NULL
),
typed_orders AS (
    SELECT CAST(order_id AS BIGINT) AS order_id,
           CAST(customer_id AS BIGINT) AS customer_id,
           CAST(product_id AS BIGINT) AS product_id,
           CAST(coalesce(TRY_CAST(quantity AS DECIMAL(38,0)), 1) AS BIGINT) AS quantity,
           TRY_CAST(order_ts AS TIMESTAMP) AS order_ts,
           upper(trim(status, ' ')) AS status,
           _loaded_at
    FROM raw_orders WHERE order_id IS NOT NULL
),
v_clean_orders AS (
    SELECT order_id, customer_id, product_id, quantity, order_ts, status
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY order_id
            ORDER BY _loaded_at DESC NULLS FIRST, customer_id DESC NULLS FIRST, product_id DESC NULLS FIRST,
                     quantity DESC NULLS FIRST, order_ts DESC NULLS FIRST, status DESC NULLS FIRST
        ) AS rn
        FROM typed_orders
    ) WHERE rn = 1
),
stg_orders AS (
    SELECT *, TIMESTAMP '2002-01-01' AS _loaded_at
    FROM v_clean_orders
    WHERE customer_id IN (SELECT customer_id FROM stg_customers)
      AND product_id IN (SELECT product_id FROM stg_products)
)"""

MART_SQL = """
dim_customer AS (
    SELECT customer_id, first_name || ' ' || last_name AS full_name, email, city, country, signup_date
    FROM stg_customers
),
fct_sales AS (
    SELECT o.order_id, o.customer_id, o.product_id, o.quantity, p.unit_price,
           CAST(o.quantity * p.unit_price AS DECIMAL(38,2)) AS line_revenue,
           o.order_ts, CAST(o.order_ts AS DATE) AS order_date, o.status
    FROM stg_orders o JOIN stg_products p ON o.product_id = p.product_id
    WHERE o.status = 'COMPLETED'
),
v_daily_revenue AS (
    SELECT order_date, count(DISTINCT order_id) AS orders, sum(line_revenue) AS revenue
    FROM fct_sales GROUP BY order_date
),
v_category_revenue AS (
    SELECT p.category, sum(f.line_revenue) AS revenue, sum(f.quantity) AS units_sold
    FROM fct_sales f JOIN stg_products p ON f.product_id = p.product_id
    GROUP BY p.category
)"""


def _raw(select: str) -> str:
    return f"WITH {RAW_SQL}\n{select}"


def _stg(select: str) -> str:
    return f"WITH {RAW_SQL},{STG_SQL}\n{select}"


def _mart(select: str) -> str:
    return f"WITH {RAW_SQL},{STG_SQL},{MART_SQL}\n{select}"


def _half_up(numerator: str, denominator: str) -> str:
    """Quotient of whole numbers, neither negative, rounded half up, without passing through floating point."""
    return f"(2 * ({numerator}) + ({denominator})) // (2 * ({denominator}))"


def _cents(column: str) -> str:
    return f"CAST({column} * 100 AS HUGEINT)"


def _fed(select_valid: str) -> str:
    """State after the loads: newest copy inside each load, then the newest load of each order."""
    load = "CASE " + " ".join(
        f"WHEN _loaded_at < TIMESTAMP '{end}' THEN {number}" for number, end in enumerate(LOAD_ENDS)
    )
    return _stg(
        f"""SELECT order_id, customer_id, product_id, quantity, order_ts, status, TIMESTAMP '2002-01-01' AS _loaded_at
        FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY load DESC) AS newest
            FROM (
                SELECT *, row_number() OVER (
                    PARTITION BY order_id, load
                    ORDER BY _loaded_at DESC NULLS FIRST, customer_id DESC NULLS FIRST, product_id DESC NULLS FIRST,
                             quantity DESC NULLS FIRST, order_ts DESC NULLS FIRST, status DESC NULLS FIRST
                ) AS rn
                FROM (SELECT *, {load} END AS load FROM typed_orders)
            )
            WHERE rn = 1 AND ({select_valid}
                (customer_id IN (SELECT customer_id FROM stg_customers)
                 AND product_id IN (SELECT product_id FROM stg_products)))
        ) WHERE newest = 1"""
    )


def _latest_line(condition: str) -> str:
    return f"""
    SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC,
                                     l_partkey DESC, l_suppkey DESC, l_returnflag DESC) AS rn
        FROM lineitem WHERE {condition}
    ) WHERE rn = 1"""


_NUMBER = """CASE WHEN l_returnflag = 'A' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || 'x'
                  ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END"""

_COUNTED_AGAIN = "(SELECT * FROM fct_sales UNION ALL SELECT * FROM fct_sales WHERE customer_id % 2 = 0)"

ORACLE: dict[str, str] = {
    "load_audit": _raw(
        """SELECT 'customers' AS tbl, count(*) AS rows FROM raw_customers
        UNION ALL SELECT 'products', count(*) FROM raw_products
        UNION ALL SELECT 'orders', count(*) FROM raw_orders"""
    ),
    "csv_strict_load": _raw(
        """SELECT customer_id, trim(first_name, ' ') AS first_name, trim(last_name, ' ') AS last_name,
               trim(email, ' ') AS email, city, country, signup_date, TIMESTAMP '2002-01-01' AS _loaded_at
        FROM raw_customers"""
    ),
    "csv_lenient_load": _raw(
        """SELECT order_id, customer_id, product_id, quantity, order_ts, 'completed' AS status,
               TIMESTAMP '2002-01-01' AS _loaded_at
        FROM raw_orders WHERE status = ' completed'"""
    ),
    "csv_rejects": _raw(
        """SELECT concat_ws(',', coalesce(order_id, ''), customer_id, product_id, coalesce(quantity, ''), order_ts)
               || CASE WHEN status = 'CANCELLED' THEN '' ELSE ',Pending ,"x,y"' END AS source_line,
               CASE WHEN status = 'CANCELLED' THEN 'short' ELSE 'long' END AS source
        FROM raw_orders WHERE status <> ' completed'"""
    ),
    "repeated_load": _raw(
        """SELECT customer_id, city, TIMESTAMP '2002-01-01' AS _loaded_at
        FROM raw_customers, (VALUES (1), (2)) AS loads(load)"""
    ),
    "same_stamp_copies": _raw(
        """SELECT CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS BIGINT) AS customer_id,
               CAST(product_id AS BIGINT) AS product_id,
               CAST(coalesce(TRY_CAST(quantity AS DECIMAL(38,0)), 1) AS BIGINT) AS quantity,
               TRY_CAST(order_ts AS TIMESTAMP) AS order_ts, upper(trim(status, ' ')) AS status
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY order_id
                ORDER BY customer_id NULLS LAST, product_id NULLS LAST, quantity NULLS LAST, order_ts NULLS LAST,
                         status NULLS LAST
            ) AS rn
            FROM raw_orders WHERE order_id IS NOT NULL
        ) WHERE rn = 1"""
    ),
    "null_tokens": """
        SELECT o_orderkey, CASE WHEN o_orderstatus NOT IN ('P', 'F') THEN o_orderpriority END AS priority
        FROM orders""",
    "union_all_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS tbl, count(*) AS rows FROM {name}"
        for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    ),
    "clean_customers": _stg(
        """SELECT customer_id, first_name, last_name, email, city, country,
               CAST(signup_date AS TIMESTAMP) AS signup_date FROM stg_customers"""
    ),
    "clean_products": _stg(
        "SELECT product_id, product_name, category, CAST(unit_price AS DOUBLE) AS unit_price FROM stg_products"
    ),
    "clean_orders": _stg("SELECT * FROM v_clean_orders"),
    "seed_orders": _stg("SELECT * FROM stg_orders"),
    "staged_count": _stg("SELECT count(*) AS staged_orders FROM stg_orders"),
    "safe_casts": f"""
        SELECT l_orderkey, l_linenumber, l_partkey AS part,
               CAST(TRY_CAST({_NUMBER} AS DECIMAL(38,0)) AS BIGINT) AS whole,
               CAST(TRY_CAST({_NUMBER} AS DECIMAL(6,2)) AS DOUBLE) AS small_price,
               CASE WHEN l_returnflag IN ('A', 'N') OR l_linestatus = 'O'
                    THEN CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) END AS day,
               CASE WHEN l_returnflag NOT IN ('A', 'N') AND l_linestatus = 'O'
                    THEN CAST(l_shipdate AS DATE) + INTERVAL '10 hours 20 minutes 30 seconds' END AS moment
        FROM lineitem""",
    "odd_dates": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               CASE WHEN l_linenumber > 5 THEN CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) END AS day,
               CASE WHEN l_linenumber > 5
                    THEN CAST(l_shipdate AS DATE) + INTERVAL '10 hours 22 minutes' END AS moment
        FROM lineitem""",
    "default_stamps": _stg(
        "SELECT order_id, true AS fresh, CASE WHEN order_ts IS NOT NULL THEN true END AS past FROM v_clean_orders"
    ),
    "initcap_names": f"""
        SELECT p_partkey, {_title("upper(p_name) || '-' || lower(p_brand) || '-it''s' || chr(9) || lower(p_type)")}
               AS title
        FROM part""",
    "latest_per_key": """
        SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
            FROM orders
        ) WHERE rn = 1""",
    "semi_join_refs": _stg(
        """SELECT * FROM typed_orders
        WHERE customer_id IN (SELECT customer_id FROM stg_customers)
          AND product_id IN (SELECT product_id FROM stg_products)"""
    ),
    "upsert_orders": _fed("load > 0 OR"),
    "upsert_compacted": _fed(""),
    "feed_old_files": _fed("load > 0 OR"),
    "upsert_newest": _stg("SELECT * FROM v_clean_orders"),
    "suspended_feed": _fed("load > 0 OR"),
    "reseeded_feed": _stg("SELECT * FROM stg_orders"),
    "idle_feed_run": f"SELECT count(*) AS staged_orders, false AS changed FROM ({_fed('load > 0 OR')})",
    "insert_and_lookup": f"""
        SELECT order_id, customer_id, product_id, quantity, order_ts, status, _loaded_at
        FROM ({_fed("load > 0 OR")}) WHERE order_id = 12
        UNION ALL
        SELECT 11, 7, 4, 3, TIMESTAMP '1999-05-22 12:00:00', 'COMPLETED', TIMESTAMP '2002-01-01'""",
    "empty_table": _mart(
        "SELECT 'created' AS tbl, 0 AS rows UNION ALL SELECT 'filled', count(*) FROM stg_products"
    ),
    "merge_rows": f"""
        WITH target AS ({_latest_line("l_returnflag <> 'A'")}), source AS ({_latest_line("l_returnflag = 'A'")})
        SELECT * FROM source
        UNION ALL SELECT * FROM target WHERE l_orderkey NOT IN (SELECT l_orderkey FROM source)""",
    "refreshed_table": _mart(
        """SELECT product_id, product_name, category, CAST(unit_price * factor AS DOUBLE) AS unit_price
        FROM stg_products, (VALUES (1), (2)) AS copies(factor)"""
    ),
    "dim_customer": _mart(
        """SELECT customer_id, full_name, email, city, country, CAST(signup_date AS TIMESTAMP) AS signup_date
        FROM dim_customer"""
    ),
    "dim_product": _mart(
        "SELECT product_id, product_name, category, CAST(unit_price AS DOUBLE) AS unit_price FROM stg_products"
    ),
    "fct_sales": _mart(
        """SELECT order_id, customer_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
               CAST(line_revenue AS DOUBLE) AS line_revenue, order_ts, CAST(order_date AS TIMESTAMP) AS order_date,
               status
        FROM fct_sales"""
    ),
    "daily_revenue": _mart(
        """SELECT CAST(order_date AS TIMESTAMP) AS order_date, orders, CAST(revenue AS DOUBLE) AS revenue
        FROM v_daily_revenue"""
    ),
    "daily_revenue_stored": _mart(
        f"""SELECT CAST(order_date AS TIMESTAMP) AS order_date, count(DISTINCT order_id) AS orders,
               CAST(sum(line_revenue) AS DOUBLE) AS revenue
        FROM {_COUNTED_AGAIN} GROUP BY order_date"""
    ),
    "kpis_stored": _mart(
        f"""SELECT count(DISTINCT order_id) AS total_orders,
               CAST(sum(line_revenue) AS DOUBLE) AS total_revenue,
               {_half_up(f"sum({_cents('line_revenue')})", "count(line_revenue)")} / 100 AS avg_line_value
        FROM {_COUNTED_AGAIN}"""
    ),
    "category_revenue": _mart(
        """SELECT category, CAST(revenue AS DOUBLE) AS revenue, CAST(units_sold AS BIGINT) AS units_sold
        FROM v_category_revenue ORDER BY revenue DESC NULLS FIRST"""
    ),
    "refreshed_star": _mart(
        """SELECT CAST(d.order_date AS TIMESTAMP) AS order_date, d.orders, CAST(d.revenue AS DOUBLE) AS revenue,
               count(f.order_id) AS lines, max(c.city) AS last_city
        FROM v_daily_revenue d
        JOIN fct_sales f ON f.order_date IS NOT DISTINCT FROM d.order_date
        JOIN dim_customer c ON c.customer_id = f.customer_id
        GROUP BY ALL"""
    ),
    "kpis": _mart(
        f"""SELECT count(DISTINCT order_id) AS total_orders,
               CAST(sum(line_revenue) AS DOUBLE) AS total_revenue,
               {_half_up(f"sum({_cents('line_revenue')})", "count(line_revenue)")} / 100 AS avg_line_value
        FROM fct_sales"""
    ),
    "top_products": _mart(
        """SELECT p.product_name, p.category, CAST(sum(f.quantity) AS BIGINT) AS units_sold,
               CAST(sum(f.line_revenue) AS DOUBLE) AS revenue
        FROM fct_sales f JOIN stg_products p ON f.product_id = p.product_id
        GROUP BY p.product_name, p.category
        ORDER BY sum(f.line_revenue) DESC NULLS FIRST, p.product_name NULLS LAST, p.category NULLS LAST
        LIMIT 5"""
    ),
    "revenue_by_city": _mart(
        """SELECT c.city, count(DISTINCT f.order_id) AS orders, CAST(sum(f.line_revenue) AS DOUBLE) AS revenue
        FROM fct_sales f JOIN dim_customer c ON f.customer_id = c.customer_id
        GROUP BY c.city ORDER BY revenue DESC NULLS FIRST"""
    ),
    "star_reports": _mart(
        """SELECT c.city, count(DISTINCT f.order_id) AS orders, CAST(sum(f.line_revenue) AS DOUBLE) AS revenue,
               true AS orders_unique
        FROM fct_sales f JOIN dim_customer c ON f.customer_id = c.customer_id
        GROUP BY c.city"""
    ),
    "order_share": _mart(
        f"""SELECT order_id, CAST(line_revenue AS DOUBLE) AS line_revenue,
               {_half_up(f"10000000 * {_cents('line_revenue')}", f"sum({_cents('line_revenue')}) OVER ()")} / 100000
               AS pct_of_total
        FROM fct_sales"""
    ),
    "revenue_moving_avg": _mart(
        f"""SELECT CAST(order_date AS TIMESTAMP) AS order_date, CAST(revenue AS DOUBLE) AS revenue,
               CASE WHEN days > 0 THEN {_half_up("cents", "days")} / 100 END AS revenue_3d_avg
        FROM (
            SELECT order_date, revenue, sum({_cents("revenue")}) OVER w AS cents, count(revenue) OVER w AS days
            FROM v_daily_revenue
            WINDOW w AS (ORDER BY order_date NULLS LAST ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
        ) ORDER BY order_date NULLS LAST"""
    ),
    "customer_ltv": _mart(
        """SELECT c.full_name, c.city, count(DISTINCT f.order_id) AS orders,
               CAST(sum(f.line_revenue) AS DOUBLE) AS lifetime_value,
               rank() OVER (ORDER BY sum(f.line_revenue) DESC NULLS FIRST) AS spend_rank
        FROM fct_sales f JOIN dim_customer c ON f.customer_id = c.customer_id
        GROUP BY c.full_name, c.city ORDER BY lifetime_value DESC NULLS FIRST"""
    ),
    "repeat_customers": _mart(
        """SELECT CASE WHEN order_count > 1 THEN 'Repeat' ELSE 'One-time' END AS customer_type, count(*) AS customers
        FROM (SELECT customer_id, count(DISTINCT order_id) AS order_count FROM fct_sales GROUP BY customer_id)
        GROUP BY 1"""
    ),
    "category_share": _mart(
        f"""SELECT category, CAST(revenue AS DOUBLE) AS revenue,
               {_half_up(f"1000 * {_cents('revenue')}", f"sum({_cents('revenue')}) OVER ()")} / 10 AS pct_of_total
        FROM v_category_revenue ORDER BY revenue DESC NULLS FIRST"""
    ),
    "rfm_scores": _mart(
        """SELECT full_name, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary,
               ntile(3) OVER (ORDER BY recency_days NULLS LAST, customer_id) AS r_score,
               ntile(3) OVER (ORDER BY frequency DESC NULLS FIRST, customer_id) AS f_score,
               ntile(3) OVER (ORDER BY monetary DESC NULLS FIRST, customer_id) AS m_score
        FROM (
            SELECT c.customer_id, c.full_name, date_diff('day', max(f.order_date), DATE '2002-01-01') AS recency_days,
                   count(DISTINCT f.order_id) AS frequency, sum(f.line_revenue) AS monetary
            FROM fct_sales f JOIN dim_customer c ON f.customer_id = c.customer_id
            GROUP BY c.customer_id, c.full_name
        ) ORDER BY monetary DESC NULLS FIRST"""
    ),
    "global_row_number": """
        SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS row_number
        FROM orders""",
    "global_ntile": """
        SELECT o_orderkey, o_orderpriority, ntile(7) OVER (ORDER BY o_orderpriority, o_orderkey) AS tile
        FROM orders""",
    "global_rank": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
               rank() OVER (ORDER BY l_quantity DESC) AS quantity_rank
        FROM lineitem""",
}
