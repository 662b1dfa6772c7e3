"""The same queries as plain SQL for DuckDB, written independently of the Spark plans."""

from __future__ import annotations

from tradewind.workload.queries import INFERRED_TABLES

VALID = "o_orderstatus IN ('F', 'O')"
MONEY = "CAST(o_totalprice AS DECIMAL(18, 2))"
LINES = """
    lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
"""


def cents_ratio(total: str, n: str) -> str:
    """Exact half-up quotient to cents of a non-negative decimal sum by a count, as DOUBLE."""
    return f"CAST((2 * CAST({total} * 100 AS HUGEINT) + {n}) // (2 * {n}) AS DOUBLE) / 100"


METRICS = f"""
    SELECT o_custkey AS customer_id, SUM({MONEY}) AS revenue, COUNT(DISTINCT o_orderkey) AS frequency
    FROM orders WHERE {VALID} GROUP BY o_custkey
"""
DIVERSITY = f"""
    SELECT o_custkey AS customer_id, COUNT(DISTINCT p_brand) AS category_count
    FROM {LINES} WHERE {VALID} GROUP BY o_custkey
"""
DAYS = """
    SELECT CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
    FROM (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders)
"""
DAILY = f"""
    SELECT CAST(o_orderdate AS DATE) AS date, SUM({MONEY}) AS sales
    FROM orders WHERE o_orderpriority = '1-URGENT' AND {VALID} GROUP BY 1
"""
WEEKDAY = """
    CAST(dayofweek(date) AS INTEGER) AS weekday_number,
    CASE dayofweek(date)
        WHEN 0 THEN 'Domingo' WHEN 1 THEN 'Segunda-feira' WHEN 2 THEN 'Terça-feira'
        WHEN 3 THEN 'Quarta-feira' WHEN 4 THEN 'Quinta-feira' WHEN 5 THEN 'Sexta-feira'
        ELSE 'Sábado' END AS weekday_name
"""
CALENDAR = f"""
    SELECT date, {WEEKDAY}, COALESCE(sales, 0) AS sales
    FROM ({DAYS}) days LEFT JOIN ({DAILY}) daily USING (date)
"""
SOLD = f"""
    SELECT p_name AS product_name, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
           SUM(CAST(l_quantity AS BIGINT)) AS sold
    FROM {LINES} WHERE {VALID} GROUP BY ALL
"""
MONTHLY = f"""
    SELECT product_name, month, CAST(COALESCE(sold, 0) AS BIGINT) AS quantity
    FROM (SELECT product_name,
                 CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month
          FROM (SELECT product_name, MIN(month) AS lo, MAX(month) AS hi FROM ({SOLD}) GROUP BY 1)) spine
    LEFT JOIN ({SOLD}) sold USING (product_name, month)
"""
FORECAST_CTES = f"""
    WITH monthly AS ({MONTHLY}),
    train AS (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY product_name ORDER BY month DESC) AS back
        FROM monthly WHERE month <= DATE '2000-12-01'),
    tails AS (
        SELECT product_name,
               CAST(SUM(quantity) FILTER (WHERE back <= 3) AS DOUBLE) AS s3,
               COUNT(*) FILTER (WHERE back <= 3) AS n3,
               CAST(SUM(quantity) FILTER (WHERE back <= 2) AS DOUBLE) AS s2,
               CAST(SUM(quantity) FILTER (WHERE back <= 1) AS DOUBLE) AS s1,
               CAST(SUM(quantity) AS DOUBLE) / COUNT(*) AS train_mean
        FROM train GROUP BY product_name),
    first_step AS (SELECT *, s3 / n3 AS f1 FROM tails),
    second_step AS (SELECT *, (s2 + f1) / 3 AS f2 FROM first_step),
    steps AS (SELECT *, (s1 + f1 + f2) / 3 AS f3 FROM second_step),
    wide AS (
        SELECT n.product_name, f1, f2, f3, train_mean, a1, a2, a3
        FROM (SELECT product_name,
                     MAX(quantity) FILTER (WHERE month = DATE '2001-01-01') AS a1,
                     MAX(quantity) FILTER (WHERE month = DATE '2001-02-01') AS a2,
                     MAX(quantity) FILTER (WHERE month = DATE '2001-03-01') AS a3
              FROM monthly GROUP BY product_name) n
        LEFT JOIN steps USING (product_name)),
    long AS (
        SELECT product_name, DATE '2001-01-01' AS month, f1 AS forecast, a1 AS actual FROM wide
        UNION ALL SELECT product_name, DATE '2001-02-01', f2, a2 FROM wide
        UNION ALL SELECT product_name, DATE '2001-03-01', f3, a3 FROM wide)
"""
PAIRS = f"""
    SELECT DISTINCT o_custkey AS customer_id, l_partkey AS product_id FROM {LINES} WHERE {VALID}
"""
OVERLAP_CTES = f"""
    WITH pairs AS ({PAIRS}),
    buyers AS (SELECT product_id, COUNT(*) AS n FROM pairs GROUP BY product_id),
    common AS (
        SELECT a.product_id AS product_a, b.product_id AS product_b, COUNT(*) AS shared
        FROM pairs a JOIN pairs b USING (customer_id) GROUP BY ALL)
"""
COSINE = "CAST(shared AS DOUBLE) / sqrt(CAST(x.n AS DOUBLE) * CAST(y.n AS DOUBLE))"
BLANKS = r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def inferred_types(table: str, columns: str) -> str:
    """Types of all columns of a table from the text of every cell."""
    cells = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, "
        rf"NULLIF(regexp_replace(CAST({c} AS VARCHAR), '^[{BLANKS}]+|[{BLANKS}]+$', '', 'g'), '') AS v "
        f"FROM {table}" for c in columns.split())
    day = r"\d{4}-(1[0-2]|0?[1-9])-(3[01]|[12]\d|0?[1-9])"
    clock = r"(2[0-3]|[01]?\d):[0-5]?\d:[0-5]?\d(\.\d{1,6})?"
    return rf"""
        SELECT '{table}' AS table_name, column_name,
               COALESCE(['TEXT', 'DATE', 'TIMESTAMP', 'NUMERIC', 'BIGINT', 'INTEGER', 'BOOLEAN']
                        [MIN(kind) + 1], 'TEXT') AS type
        FROM (
            SELECT column_name, CASE
                WHEN v IS NULL THEN NULL
                WHEN lower(v) IN ('true', 'false', 't', 'f', 'yes', 'no', 'sim', 'nao') THEN 6
                WHEN regexp_matches(v, '^-?(0|[1-9]\d{{0,11}})$') THEN
                    CASE WHEN CAST(v AS BIGINT) BETWEEN -2147483648 AND 2147483647 THEN 5 ELSE 4 END
                WHEN regexp_matches(v, '^[+-]?(\d+\.\d*|\.\d+)([eE][+-]?\d+)?$') THEN 3
                WHEN regexp_matches(v, '^{day} {clock}$') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL THEN 2
                WHEN regexp_matches(v, '^{day}$') AND TRY_CAST(v AS DATE) IS NOT NULL THEN 1
                ELSE 0 END AS kind
            FROM ({cells}))
        GROUP BY column_name
    """


TABLE_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount"
                " l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
}

ORACLE: dict[str, str] = {
    "orders_overview": f"""
        SELECT COUNT(*) AS row_count, MIN(o_orderdate) AS min_date, MAX(o_orderdate) AS max_date,
               MIN(o_totalprice) AS min_total, MAX(o_totalprice) AS max_total,
               {cents_ratio(f"SUM({MONEY})", f"COUNT({MONEY})")} AS avg_total
        FROM orders""",
    "row_count_total": """
        SELECT (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM orders)
             + (SELECT COUNT(*) FROM lineitem) + (SELECT COUNT(*) FROM events) AS total_rows""",
    "row_count_breakdown": """
        SELECT (SELECT COUNT(*) FROM customer) AS customers_total,
               (SELECT COUNT(*) FROM orders) AS orders_total,
               (SELECT COUNT(*) FROM lineitem) AS order_items_total,
               (SELECT COUNT(*) FROM events) AS payments_total,
               (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM orders)
             + (SELECT COUNT(*) FROM lineitem) + (SELECT COUNT(*) FROM events) AS sum_total""",
    "valid_orders": f"""
        SELECT o_orderkey AS id, o_custkey AS customer_id, o_totalprice AS total
        FROM orders WHERE {VALID}""",
    "order_lines": f"""
        SELECT l_orderkey AS order_id, o_custkey AS customer_id, p_partkey AS product_id,
               p_brand AS category, CAST(l_quantity AS BIGINT) AS quantity
        FROM {LINES} WHERE {VALID}""",
    "customer_metrics": f"""
        SELECT customer_id, CAST(revenue AS DOUBLE) AS revenue, frequency,
               {cents_ratio("revenue", "frequency")} AS avg_ticket
        FROM ({METRICS})""",
    "category_diversity": DIVERSITY,
    "elite_customers": f"""
        SELECT customer_id, CAST(revenue AS DOUBLE) AS revenue, frequency,
               {cents_ratio("revenue", "frequency")} AS avg_ticket, category_count
        FROM ({METRICS}) JOIN ({DIVERSITY}) USING (customer_id)
        WHERE category_count >= 13
        ORDER BY avg_ticket DESC NULLS FIRST, customer_id LIMIT 10""",
    "elite_top_category": f"""
        WITH elite AS (
            SELECT customer_id FROM ({METRICS}) JOIN ({DIVERSITY}) USING (customer_id)
            WHERE category_count >= 13
            ORDER BY revenue / frequency DESC NULLS FIRST, customer_id LIMIT 10)
        SELECT p_brand AS category_id, p_brand AS category,
               CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_quantity
        FROM {LINES} WHERE {VALID} AND o_custkey IN (SELECT customer_id FROM elite)
        GROUP BY p_brand ORDER BY total_quantity DESC NULLS FIRST, category_id LIMIT 1""",
    "calendar_dim": f"SELECT date, {WEEKDAY} FROM ({DAYS})",
    "daily_pos_sales": f"SELECT date, CAST(sales AS DOUBLE) AS sales FROM ({DAILY})",
    "calendar_sales": f"""
        SELECT date, weekday_number, weekday_name, CAST(sales AS DOUBLE) AS sales FROM ({CALENDAR})""",
    "weekday_sales": f"""
        SELECT weekday_number, weekday_name, COUNT(*) AS days,
               COUNT(*) FILTER (WHERE sales > 0) AS days_with_sale,
               {cents_ratio("SUM(sales)", "COUNT(*)")} AS avg_sales,
               CAST(SUM(sales) AS DOUBLE) AS total_sales
        FROM ({CALENDAR}) GROUP BY ALL ORDER BY avg_sales, weekday_number""",
    "product_lines": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity
        FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_name = 'blue anvil')""",
    "monthly_demand": MONTHLY,
    "product_demand": f"SELECT * FROM ({MONTHLY}) WHERE product_name = 'blue anvil'",
    "ma_forecast": f"{FORECAST_CTES} SELECT product_name, month, forecast FROM long",
    "forecast_eval": f"""{FORECAST_CTES}
        SELECT product_name, month, round_even(forecast, 2) AS forecast, actual,
               round_even(abs(forecast - actual), 2) AS abs_error FROM long""",
    "forecast_metrics": f"""{FORECAST_CTES},
        errors AS (
            SELECT *, round_even(abs(f1 - a1), 2) AS e1, round_even(abs(f2 - a2), 2) AS e2,
                   round_even(abs(f3 - a3), 2) AS e3 FROM wide),
        means AS (
            SELECT *, (COALESCE(e1, 0) + COALESCE(e2, 0) + COALESCE(e3, 0)) / NULLIF(
                CAST(e1 IS NOT NULL AS INT) + CAST(e2 IS NOT NULL AS INT) + CAST(e3 IS NOT NULL AS INT),
                0) AS mae FROM errors)
        SELECT product_name, mae, train_mean, mae / NULLIF(train_mean, 0) AS mae_ratio,
               CAST(round_even(round_even(f1, 2) + round_even(f2, 2) + round_even(f3, 2), 0) AS BIGINT)
                   AS forecast_total
        FROM means""",
    "purchase_pairs": f"""
        SELECT DISTINCT o_custkey AS customer_id, p_partkey AS product_id, p_name AS product_name
        FROM {LINES} WHERE {VALID}""",
    "purchase_pairs_query": f"""
        SELECT DISTINCT o_custkey AS customer_id, p_partkey AS product_id, p_name AS product_name
        FROM {LINES} WHERE {VALID}""",
    "product_names": f"""
        SELECT p_partkey AS product_id, MIN(p_name) AS product_name
        FROM {LINES} WHERE {VALID} GROUP BY p_partkey""",
    "user_item_matrix": f"SELECT customer_id, product_id, 1 AS purchased FROM ({PAIRS})",
    "matrix_shape": f"""
        SELECT COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT product_id) AS products
        FROM ({PAIRS})""",
    "item_cosine": f"""{OVERLAP_CTES}
        SELECT product_a, product_b, round_even({COSINE}, 4) AS cosine_similarity
        FROM common JOIN buyers x ON x.product_id = product_a JOIN buyers y ON y.product_id = product_b
        WHERE product_a < product_b""",
    "similar_products": f"""{OVERLAP_CTES},
        reference AS (
            SELECT MIN(product_id) AS id FROM pairs JOIN part ON p_partkey = product_id
            WHERE p_name = 'blue anvil'),
        scored AS (
            SELECT y.product_id, COALESCE({COSINE}, 0) AS score
            FROM reference JOIN buyers x ON x.product_id = id JOIN buyers y ON y.product_id <> id
            LEFT JOIN common ON product_a = id AND product_b = y.product_id)
        SELECT CAST(ROW_NUMBER() OVER (ORDER BY score DESC, product_id) AS INTEGER) AS rank, product_id,
               p_name AS product_name, round_even(score, 4) AS cosine_similarity
        FROM scored JOIN part ON p_partkey = product_id ORDER BY rank LIMIT 5""",
    "similar_products_all": f"""{OVERLAP_CTES},
        scored AS (
            SELECT x.product_id, y.product_id AS similar_id, COALESCE({COSINE}, 0) AS score
            FROM buyers x JOIN buyers y ON x.product_id <> y.product_id
            LEFT JOIN common ON product_a = x.product_id AND product_b = y.product_id),
        ranked AS (
            SELECT *, ROW_NUMBER() OVER (
                PARTITION BY product_id ORDER BY score DESC, similar_id) AS rank FROM scored)
        SELECT product_id, CAST(rank AS INTEGER) AS rank, similar_id, round_even(score, 4) AS cosine_similarity
        FROM ranked WHERE rank <= 5""",
    "infer_schema": " UNION ALL ".join(inferred_types(t, TABLE_COLUMNS[t]) for t in INFERRED_TABLES),
    "normalize_columns": """
        SELECT p_partkey AS codigo_da_peca, p_name AS descricao, p_brand AS marca, p_type AS marca_1,
               p_size AS col_2nd_size, p_retailprice AS preco_r
        FROM part""",
    "csv_load": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders""",
    "csv_rejects": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
               '(' || CAST(CAST(-c_acctbal AS DECIMAL(18, 2)) AS VARCHAR) || ')' AS c_acctbal,
               c_mktsegment, 'c_acctbal' AS bad_columns
        FROM customer WHERE CAST(c_acctbal AS DECIMAL(18, 2)) < 0""",
    "csv_load_audit": """
        SELECT 'customer' AS table_name, 'rejected' AS status, 0 AS rows_loaded,
               COUNT(*) FILTER (WHERE CAST(c_acctbal AS DECIMAL(18, 2)) < 0) AS rows_rejected,
               '' AS unmatched FROM customer
        UNION ALL SELECT 'lineitem', 'loaded', COUNT(*), 0, '' FROM lineitem
        UNION ALL SELECT 'nation', 'loaded', COUNT(*), 0, 'Observação' FROM nation
        UNION ALL SELECT 'orders', 'loaded', COUNT(*), 0, '' FROM orders
        UNION ALL SELECT 'supplier', 'skipped_no_table', 0, 0, ''""",
    "csv_bad_values": """
        WITH o AS (
          SELECT o_orderkey, o_orderkey % 7 NOT IN (0, 5) AS bad_date, o_orderkey % 5 IN (1, 2) AS bad_amount,
                 strftime(o_orderdate, '%Y-%m-%d') AS day,
                 CASE o_orderkey % 5 WHEN 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE)
                                     WHEN 3 THEN 150.0 WHEN 4 THEN 12.0 END AS amount
          FROM orders
        )
        SELECT o_orderkey, 'loaded' AS outcome, '' AS bad_columns, day AS o_orderdate, amount AS o_totalprice
        FROM o WHERE NOT bad_date AND NOT bad_amount
        UNION ALL
        SELECT o_orderkey, 'rejected', concat_ws(',', CASE WHEN bad_date THEN 'o_orderdate' END,
                                                      CASE WHEN bad_amount THEN 'o_totalprice' END), NULL, NULL
        FROM o WHERE bad_date OR bad_amount
        UNION ALL
        SELECT -1, 'whole source rejected', CAST(COUNT(*) FILTER (WHERE bad_date OR bad_amount) AS VARCHAR), NULL, NULL
        FROM o""",
    "csv_text_load": """
        SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN lang END AS lang,
               'say "' || text || '", then' || chr(10) || 'stop' AS text, n_chars
        FROM documents""",
    "csv_interrupted_load": """
        SELECT 'committed' AS moment, CASE WHEN c_acctbal >= 0 THEN 'loaded' ELSE 'rejected' END AS outcome, c_custkey FROM customer
        UNION ALL
        SELECT 'recovered', CASE WHEN c_acctbal <= 0 THEN 'loaded' ELSE 'rejected' END, c_custkey FROM customer""",
    "csv_split_records": """
        SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN lang END AS lang,
               'say "' || text || '", then' || chr(10) || 'stop' AS text, n_chars
        FROM documents""",
    "csv_typed_scan": """
        SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, CASE WHEN s_suppkey % 3 <> 2 THEN s_name END AS s_name,
               CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_nationkey AS INTEGER) END AS s_nationkey
        FROM supplier""",
}
