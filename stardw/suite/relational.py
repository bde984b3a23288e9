"""Projections, filters, sorts, limits and unions (B, O)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stardw import sources
from stardw.functions import changed, date_key, discount_band, mean, ship_mode

from .registry import query
from .sql import mean as sql_mean
from .sql import with_


@query("b01_projection", with_("l", """
SELECT order_id, product_id, employee_id, line_number, CAST(gross AS DOUBLE) AS gross_amount,
       CAST(net AS DOUBLE) AS net_amount, CAST(gross - net AS DOUBLE) AS discount_amount
FROM l"""))
def projection(m):
    return m.lines().select(
        "order_id", "product_id", "employee_id", "line_number",
        F.col("gross").alias("gross_amount"),
        F.col("net").alias("net_amount"),
        (F.col("gross") - F.col("net")).alias("discount_amount"),
    )


@query("b02_filter", with_("o", """
SELECT order_id, customer_id, status, priority FROM o
WHERE status = 'F' AND order_date >= DATE '1996-01-01' AND order_date < DATE '1999-01-01'
  AND priority IN ('1-URGENT', '2-HIGH')"""))
def filtered(m):
    day = F.col("order_date")
    return m.orders().filter(
        (F.col("status") == "F")
        & (day >= F.lit("1996-01-01").cast("date"))
        & (day < F.lit("1999-01-01").cast("date"))
        & F.col("priority").isin("1-URGENT", "2-HIGH")
    ).select("order_id", "customer_id", "status", "priority")


@query("b03_null_tests", with_("shipments", """
SELECT status, count(*) FILTER (WHERE shipped_date IS NULL) AS pending,
       count(*) FILTER (WHERE shipped_date IS NOT NULL) AS shipped
FROM shipments GROUP BY status"""))
def null_tests(m):
    done = F.col("shipped_date")
    return m.shipments().groupBy("status").agg(
        F.count_if(done.isNull()).alias("pending"), F.count_if(done.isNotNull()).alias("shipped")
    )


@query("b04_null_safe_change", with_("shipments", """
SELECT status, count(*) FILTER (WHERE shipped_date IS DISTINCT FROM required_date) AS changed,
       count(*) FILTER (WHERE shipped_date <> required_date) AS plainly_different
FROM shipments GROUP BY status"""))
def null_safe_change(m):
    done, due = F.col("shipped_date"), F.col("required_date")
    return m.shipments().groupBy("status").agg(
        F.count_if(changed(done, due)).alias("changed"),
        F.count_if(done != due).alias("plainly_different"),
    )


BAND = """CASE WHEN discount = 0 THEN 'None' WHEN discount <= 0.05 THEN 'Low'
            WHEN discount <= 0.15 THEN 'Medium' ELSE 'High' END"""


@query("b05_banding", with_("l", f"""
SELECT {BAND} AS discount_band, count(*) AS n, CAST(min(discount) AS DOUBLE) AS lowest,
       CAST(max(discount) AS DOUBLE) AS highest FROM l GROUP BY 1"""))
def banding(m):
    return m.lines().groupBy(discount_band(F.col("discount")).alias("discount_band")).agg(
        F.count("*").alias("n"), F.min("discount").alias("lowest"),
        F.max("discount").alias("highest"),
    )


@query("b06_code_mapping", with_("o", """
SELECT priority, CASE ship_via WHEN 1 THEN 'Express' WHEN 2 THEN 'Standard' ELSE 'Economy' END
       AS ship_mode, count(*) AS n FROM o GROUP BY ALL"""))
def code_mapping(m):
    return m.orders().groupBy("priority", ship_mode(F.col("ship_via")).alias("ship_mode")).agg(
        F.count("*").alias("n")
    )


@query("b07_boolean_columns", with_("shipments l", """
SELECT s.late, b.high_value, count(*) AS n
FROM (SELECT order_id, shipped_date > required_date AS late FROM shipments) s
JOIN (SELECT order_id, net > 1000 AS high_value FROM l) b ON b.order_id = s.order_id
GROUP BY ALL"""))
def boolean_columns(m):
    orders = m.shipments().select(
        "order_id", (F.col("shipped_date") > F.col("required_date")).alias("late")
    )
    lines = m.lines().select("order_id", (F.col("net") > 1000).alias("high_value"))
    return lines.join(orders, "order_id").groupBy("late", "high_value").agg(
        F.count("*").alias("n")
    )


@query("b08_null_until_milestone", with_("ful", """
SELECT order_id, shipped_date_key, days_to_ship, is_late FROM ful"""))
def null_until_milestone(m):
    return m.fulfillment().select("order_id", "shipped_date_key", "days_to_ship", "is_late")


@query("b09_distinct", with_("l", "SELECT DISTINCT employee_id, quantity, discount::DOUBLE AS discount FROM l"))
def distinct(m):
    return m.lines().select("employee_id", "quantity", "discount").distinct()


@query("b10_having", with_("l", """
SELECT order_id, product_id, count(*) AS n FROM l GROUP BY ALL HAVING count(*) > 1"""))
def having(m):
    return m.lines().groupBy("order_id", "product_id").agg(F.count("*").alias("n")).filter("n > 1")


@query("b11_scalar_in_select", with_("l", """
SELECT count(DISTINCT product_id) AS products_sold, (SELECT count(*) FROM part) AS products,
       (SELECT count(*) FROM supplier) AS employees FROM l"""))
def scalar_in_select(m):
    sold = m.lines().agg(F.count_distinct("product_id").alias("products_sold"))
    return sold.withColumns({
        "products": m.products().agg(F.count("*")).scalar(),
        "employees": m.employees().agg(F.count("*")).scalar(),
    })


@query("b12_scalar_in_where", with_("stock", """
SELECT snapshot_date_key, product_id, units_in_stock FROM stock
WHERE snapshot_date_key = (SELECT max(snapshot_date_key) FROM stock)"""))
def scalar_in_where(m):
    levels = m.stock_levels()
    last = levels.agg(F.max("snapshot_day")).scalar()
    return levels.filter(F.col("snapshot_day") == last).select(
        date_key(F.col("snapshot_day")).alias("snapshot_date_key"), "product_id",
        "units_in_stock",
    )


@query("b13_derived_tables", with_("o l", f"""
, per_order AS (SELECT order_id, sum(net) AS net FROM l GROUP BY order_id),
  per_customer AS (SELECT o.customer_id, count(*) AS orders, sum(p.net) AS net
                   FROM per_order p JOIN o ON o.order_id = p.order_id GROUP BY o.customer_id)
SELECT orders, count(*) AS customers, CAST(sum(net) AS DOUBLE) AS net
FROM per_customer GROUP BY orders""".lstrip()))
def derived_tables(m):
    per_order = m.lines().groupBy("order_id").agg(F.sum("net").alias("net"))
    per_customer = (
        per_order.join(m.orders().select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id").agg(F.count("*").alias("orders"), F.sum("net").alias("net"))
    )
    return per_customer.groupBy("orders").agg(
        F.count("*").alias("customers"), F.sum("net").alias("net")
    )


@query("b14_parameters", with_("o", """
SELECT priority, count(*) AS n FROM o
WHERE status = 'O' AND order_date >= DATE '1998-01-01' GROUP BY priority"""))
def parameters(m):
    return m.spark.sql(
        "SELECT priority, count(*) AS n FROM {orders} "
        "WHERE status = :status AND order_date >= CAST(:since AS DATE) GROUP BY priority",
        args={"status": "O", "since": "1998-01-01"},
        orders=m.orders(),
    )


@query("b15_group_by_expression", with_("ful", f"""
SELECT shipped_date IS NULL AS is_pending, year(order_date) AS order_year, count(*) AS orders,
       {sql_mean('days_to_ship')} AS mean_days FROM ful GROUP BY ALL"""))
def group_by_expression(m):
    return m.fulfillment().groupBy(
        F.col("shipped_date").isNull().alias("is_pending"),
        F.year("order_date").alias("order_year"),
    ).agg(F.count("*").alias("orders"), mean(F.col("days_to_ship")).alias("mean_days"))


@query("o01_sorted", with_("ful", """
SELECT ship_country, year(order_date) AS order_year, count(*) AS orders
FROM ful GROUP BY ALL ORDER BY order_year, orders DESC, ship_country"""))
def sorted_rows(m):
    return (
        m.fulfillment()
        .groupBy("ship_country", F.year("order_date").alias("order_year"))
        .agg(F.count("*").alias("orders"))
        .orderBy("order_year", F.desc("orders"), "ship_country")
    )


@query("o02_top_n", with_("l", """
SELECT product_id, CAST(sum(net) AS DOUBLE) AS net FROM l GROUP BY product_id
ORDER BY sum(net) DESC, product_id LIMIT 10"""))
def top_n(m):
    return m.lines().groupBy("product_id").agg(F.sum("net").alias("net")).orderBy(
        F.desc("net"), "product_id"
    ).limit(10)


@query("o03_union_all", """
SELECT 'customer' AS kind, c_nationkey AS territory_id, count(*) AS n FROM customer GROUP BY ALL
UNION ALL
SELECT 'employee', s_nationkey, count(*) FROM supplier GROUP BY ALL""")
def union_all(m):
    def one(kind, df):
        return df.groupBy(F.lit(kind).alias("kind"), "territory_id").agg(F.count("*").alias("n"))

    return one("customer", m.customers()).unionByName(one("employee", m.employees()))


@query("o04_recursive_days", """
WITH RECURSIVE d(day) AS (
    SELECT CAST(min(l_shipdate) AS DATE) FROM lineitem
    UNION ALL
    SELECT day + 1 FROM d WHERE day < (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem))
SELECT CAST(day AS VARCHAR) AS day, year(day) AS year, month(day) AS month FROM d""")
def recursive_days(m):
    ends = m.lines().agg(
        F.struct(F.min("ship_date").alias("lo"), F.max("ship_date").alias("hi"))
    ).scalar()
    days = sources.date_series(m.spark, ends["lo"], ends["hi"])
    return days.select("day", F.year("day").alias("year"), F.month("day").alias("month"))
