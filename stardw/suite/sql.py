"""Common parts of the SQL twins: the model as table expressions.

`with_(names, body)` puts the named parts and what they build on before a body.
"""

from __future__ import annotations

PARTS: dict[str, tuple[list[str], str]] = {
    "o": ([], """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
               CAST(o_orderdate AS DATE) AS order_date,
               CAST(o_orderdate AS DATE) + 60 AS required_date,
               o_orderpriority AS priority,
               LEAST(CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 3) AS ship_via
        FROM orders"""),
    "l": ([], """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS employee_id,
               l_linenumber AS line_number, CAST(l_quantity AS INTEGER) AS quantity,
               CAST((2 * CAST(round(l_extendedprice * 100) AS BIGINT) * 100
                     + CAST(l_quantity AS BIGINT)) // (2 * CAST(l_quantity AS BIGINT))
                    AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS unit_price,
               CAST(l_discount AS DECIMAL(5,4)) AS discount,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS gross,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2))
                    * (1 - CAST(l_discount AS DECIMAL(5,4))) AS DECIMAL(18,4)) AS net,
               CAST(l_shipdate AS DATE) AS ship_date
        FROM lineitem"""),
    "shipments": (["o", "l"], """
        SELECT o.*, CASE WHEN o.status = 'F' THEN s.last_ship END AS shipped_date
        FROM o LEFT JOIN (SELECT order_id, max(ship_date) AS last_ship FROM l GROUP BY order_id) s
          ON s.order_id = o.order_id"""),
    "ful": (["shipments"], """
        SELECT s.order_id, s.customer_id, s.ship_via, s.order_date, s.required_date,
               s.shipped_date, n.n_name AS ship_country,
               CAST(strftime(s.order_date, '%Y%m%d') AS INTEGER) AS order_date_key,
               CAST(strftime(s.required_date, '%Y%m%d') AS INTEGER) AS required_date_key,
               CAST(strftime(s.shipped_date, '%Y%m%d') AS INTEGER) AS shipped_date_key,
               CAST(date_diff('day', s.order_date, s.shipped_date) AS INTEGER) AS days_to_ship,
               CASE WHEN s.shipped_date IS NOT NULL
                    THEN s.shipped_date > s.required_date END AS is_late
        FROM shipments s JOIN customer c ON c.c_custkey = s.customer_id
        JOIN nation n ON n.n_nationkey = c.c_nationkey"""),
    "emp": ([], """
        SELECT s.s_suppkey AS employee_id, s.s_name AS full_name, s.s_nationkey AS territory_id,
               CASE WHEN s.s_suppkey > 0 THEN s.s_suppkey // 10 END AS reports_to,
               m.s_name AS manager_name
        FROM supplier s LEFT JOIN supplier m
          ON m.s_suppkey = CASE WHEN s.s_suppkey > 0 THEN s.s_suppkey // 10 END"""),
    "pairs": ([], """
        SELECT s.s_suppkey AS employee_id, n.n_nationkey AS territory_id
        FROM supplier s JOIN nation h ON h.n_nationkey = s.s_nationkey
        JOIN nation n ON n.n_regionkey = h.n_regionkey"""),
    "terr": ([], """
        SELECT n_nationkey AS territory_id, trim(n_name) AS territory_name,
               trim(r_name) AS region_name
        FROM nation LEFT JOIN region ON r_regionkey = n_regionkey"""),
    "shipper": (["o"], """
        SELECT DISTINCT ship_via AS shipper_id,
               CASE ship_via WHEN 1 THEN 'Express' WHEN 2 THEN 'Standard'
                    ELSE 'Economy' END AS shipper_name
        FROM o"""),
    # Last profile of each customer before each load; a load follows every year of orders.
    "load_days": (["o"], """
        SELECT make_date(y, 1, 1) AS load_date
        FROM (SELECT min(year(order_date)) AS a, max(year(order_date)) AS b FROM o) e,
             generate_series(e.a + 1, e.b + 1) g(y)"""),
    "loads": (["o", "load_days"], """
        SELECT d.load_date, o.customer_id, o.priority, o.status
        FROM o JOIN load_days d ON o.order_date < d.load_date
        QUALIFY row_number() OVER (PARTITION BY d.load_date, o.customer_id
                                   ORDER BY o.order_date DESC, o.order_id DESC) = 1"""),
    "load_points": (["loads"], """
        SELECT * FROM (
            SELECT *, row_number() OVER w AS nth,
                   lag(priority) OVER w AS old_priority, lag(status) OVER w AS old_status
            FROM loads WINDOW w AS (PARTITION BY customer_id ORDER BY load_date)) x
        WHERE nth = 1 OR priority IS DISTINCT FROM old_priority
           OR status IS DISTINCT FROM old_status"""),
    "cust_loads": (["load_points"], """
        SELECT customer_id, priority, status,
               CASE WHEN load_date = :first_load THEN DATE '1900-01-01'
                    ELSE load_date END AS valid_from,
               coalesce(lead(load_date) OVER w - 1, DATE '9999-12-31') AS valid_to,
               lead(load_date) OVER w IS NULL AS is_current
        FROM load_points WINDOW w AS (PARTITION BY customer_id ORDER BY load_date)"""),
    "cust_points": (["o"], """
        SELECT * FROM (
            SELECT *, row_number() OVER w AS nth,
                   lag(priority) OVER w AS old_priority, lag(status) OVER w AS old_status
            FROM (SELECT customer_id, order_date, priority, status FROM o
                  QUALIFY row_number() OVER (PARTITION BY customer_id, order_date
                                             ORDER BY order_id DESC) = 1) daily
            WINDOW w AS (PARTITION BY customer_id ORDER BY order_date)) x
        WHERE nth = 1 OR priority IS DISTINCT FROM old_priority
           OR status IS DISTINCT FROM old_status"""),
    "cust": (["cust_points"], """
        SELECT customer_id, priority, status,
               CASE WHEN nth = 1 THEN DATE '1900-01-01' ELSE order_date END AS valid_from,
               coalesce(lead(order_date) OVER w - 1, DATE '9999-12-31') AS valid_to,
               lead(order_date) OVER w IS NULL AS is_current
        FROM cust_points WINDOW w AS (PARTITION BY customer_id ORDER BY order_date)"""),
    "prices": (["l"], """
        SELECT product_id, CAST(date_trunc('month', ship_date) AS DATE) AS price_month,
               min(unit_price) AS unit_price
        FROM l GROUP BY ALL"""),
    "price_points": (["prices"], """
        SELECT * FROM (
            SELECT *, row_number() OVER w AS nth, lag(unit_price) OVER w AS old_price
            FROM prices WINDOW w AS (PARTITION BY product_id ORDER BY price_month)) x
        WHERE nth = 1 OR unit_price IS DISTINCT FROM old_price"""),
    "prod": (["price_points"], """
        SELECT product_id, unit_price,
               CASE WHEN nth = 1 THEN DATE '1900-01-01' ELSE price_month END AS valid_from,
               coalesce(lead(price_month) OVER w - 1, DATE '9999-12-31') AS valid_to,
               lead(price_month) OVER w IS NULL AS is_current
        FROM price_points WINDOW w AS (PARTITION BY product_id ORDER BY price_month)"""),
    # Stock of each product at each month end, last level repeated where nothing moved.
    "moves": (["l"], """
        SELECT product_id, last_day(ship_date) AS month_end,
               sum(CASE WHEN line_number % 2 = 0 THEN quantity ELSE -quantity END) AS moved
        FROM l GROUP BY ALL"""),
    "months": (["moves"], """
        SELECT DISTINCT last_day(CAST(m AS DATE)) AS snapshot_day
        FROM (SELECT min(month_end) AS a, max(month_end) AS b FROM moves) e,
             generate_series(date_trunc('month', e.a), date_trunc('month', e.b),
                             INTERVAL 1 MONTH) g(m)"""),
    "levels": (["months"], """
        SELECT f.product_id, m.snapshot_day,
               CAST((SELECT sum(x.moved) FROM moves x
                     WHERE x.product_id = f.product_id AND x.month_end <= m.snapshot_day)
                    AS BIGINT) AS units_in_stock
        FROM (SELECT product_id, min(month_end) AS first_month FROM moves GROUP BY product_id) f
        JOIN months m ON m.snapshot_day >= f.first_month"""),
    "stock": (["levels"], """
        SELECT v.product_id, CAST(strftime(v.snapshot_day, '%Y%m%d') AS INTEGER)
                   AS snapshot_date_key,
               v.units_in_stock, p.p_size AS reorder_level, p.p_type AS category,
               p.p_name AS product_name, v.units_in_stock <= p.p_size AS needs_reorder
        FROM levels v JOIN part p ON p.p_partkey = v.product_id"""),
    # Days on which a member sold, for each territory that the bridge gives the member.
    "act": (["o", "l", "pairs"], """
        SELECT DISTINCT o.order_date AS activity_date, l.employee_id, p.territory_id
        FROM l JOIN o ON o.order_id = l.order_id
        JOIN pairs p ON p.employee_id = l.employee_id"""),
    # The same days for the territories of the customers served.
    "served": (["o", "l"], """
        SELECT DISTINCT o.order_date AS activity_date, l.employee_id,
               c.c_nationkey AS territory_id
        FROM l JOIN o ON o.order_id = l.order_id
        JOIN customer c ON c.c_custkey = o.customer_id"""),
}


# What :first_load, :second_load, :next_to_last_load and :last_load stand for in a body.
LOADS = {
    "first_load": "(SELECT min(load_date) FROM load_days)",
    "second_load": "(SELECT load_date FROM load_days ORDER BY load_date LIMIT 1 OFFSET 1)",
    "next_to_last_load": "(SELECT load_date FROM load_days ORDER BY load_date DESC LIMIT 1 OFFSET 1)",
    "last_load": "(SELECT max(load_date) FROM load_days)",
}


def _needed(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needed(PARTS[name][0], seen)
            seen.append(name)
    return seen


def with_(names: str, body: str) -> str:
    parts = _needed(names.split(), [])
    # Materialized: parts are used several times, and nested copies of them cost minutes.
    text = ",\n".join(f"{p} AS MATERIALIZED ({PARTS[p][1]})" for p in parts)
    body = body.strip()
    whole = f"WITH {text}{body}" if body.startswith(",") else f"WITH {text}\n{body}"
    for name, value in LOADS.items():
        whole = whole.replace(f":{name}", value)
    return whole


def sk(*parts: str) -> str:
    """SQL text of the surrogate key of some key parts."""
    return f"CAST(('0x' || substr({fk(*parts)}, 1, 15)) AS BIGINT)"


def fk(*parts: str) -> str:
    """SQL text of the key of a fact row."""
    texts = " || ".join(
        f"coalesce(length(CAST({p} AS VARCHAR)) || ':' || CAST({p} AS VARCHAR), '~')" for p in parts
    )
    return f"md5({texts})"


def mean(col: str) -> str:
    return f"(CAST(sum({col}) AS DOUBLE) / nullif(count({col}), 0))"


def pct(part: str, whole: str) -> str:
    return f"(CAST(100 AS DOUBLE) * CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0))"
