"""Scalar functions (F), each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from stardw.functions import (FIRST_DAY, LAST_DAY, date_attributes, date_key, days_between,
                              surrogate_key)

from .registry import query
from .sql import sk, with_


@query("f01_concat", """
SELECT c_custkey AS customer_id, c_name || ' (' || c_mktsegment || ')' AS label,
       c_name || CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE '' END AS null_part
FROM customer""")
def concat(m):
    nothing = F.when(F.col("segment") == "BUILDING", F.lit(None)).otherwise("")
    return m.customers().select(
        "customer_id",
        F.concat("customer_name", F.lit(" ("), "segment", F.lit(")")).alias("label"),
        F.concat("customer_name", nothing).alias("null_part"),
    )


@query("f02_trim", """
SELECT p_partkey AS product_id, p_name AS both_sides, '  ' || p_name AS right_side FROM part""")
def trim(m):
    padded = F.concat(F.lit("  "), F.col("product_name"), F.lit("    "))
    return m.products().select(
        "product_id", F.trim(padded).alias("both_sides"), F.rtrim(padded).alias("right_side")
    )


@query("f03_date_key", """
SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key, count(*) AS n
FROM lineitem GROUP BY ALL""")
def date_keys(m):
    return m.lines().groupBy(date_key(F.col("ship_date")).alias("date_key")).agg(
        F.count("*").alias("n")
    )


@query("f04_to_date", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n FROM events GROUP BY ALL""")
def to_date(m):
    return m.events().groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))


@query("f05_day_difference", with_("o l", """
SELECT date_diff('day', o.order_date, l.ship_date) AS days, count(*) AS n
FROM l JOIN o ON o.order_id = l.order_id GROUP BY ALL"""))
def day_difference(m):
    days = days_between(F.col("order_date"), F.col("ship_date"))
    return m.sales("order_date").groupBy(days.alias("days")).agg(F.count("*").alias("n"))


@query("f06_day_arithmetic", """
SELECT o_orderkey AS order_id, CAST(CAST(o_orderdate AS DATE) - 1 AS VARCHAR) AS day_before,
       CAST(CAST(o_orderdate AS DATE) + 60 AS VARCHAR) AS due FROM orders""")
def day_arithmetic(m):
    return m.orders().select(
        "order_id", F.date_sub("order_date", 1).alias("day_before"),
        F.date_add("order_date", 60).alias("due"),
    )


DAYS = """
SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem"""


@query("f07_f10_date_attributes", f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS VARCHAR) AS full_date,
       year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
       day(d) AS day, isodow(d) - 1 AS weekday, dayname(d) AS day_name,
       isodow(d) >= 6 AS is_weekend FROM ({DAYS})""")
def calendar_attributes(m):
    days = m.lines().select("ship_date").distinct()
    return days.select(*date_attributes(F.col("ship_date")))


@query("f11_load_date", """
SELECT count(*) AS orders, count(*) FILTER (WHERE o_orderdate < DATE '1999-01-01') AS before_load,
       true AS clock_after_load FROM orders""")
def load_date(m):
    """The load date is an argument; the clock is only its default."""
    day = F.lit("1999-01-01").cast("date")
    return m.orders().agg(
        F.count("*").alias("orders"), F.count_if(F.col("order_date") < day).alias("before_load"),
        (F.max(F.current_date()) > day).alias("clock_after_load"),
    )


@query("f12_round", """
SELECT o_orderkey AS order_id, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)), 1) AS DOUBLE)
       AS to_tenths, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)), 0) AS DOUBLE) AS to_units
FROM orders""")
def rounded(m):
    """Rounding of decimals; doubles round differently between engines."""
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return m.given("orders").select(
        F.col("o_orderkey").alias("order_id"), F.round(price, 1).alias("to_tenths"),
        F.round(price, 0).alias("to_units"),
    )


@query("f13_f14_hash_key", f"""
SELECT o_orderkey AS order_id, {sk('o_orderkey')} AS order_sk,
       {sk('o_custkey', 'CAST(o_orderdate AS DATE)')} AS version_sk,
       {sk('o_custkey', "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END")}
         AS null_part_sk FROM orders""")
def hash_key(m):
    part = F.when(F.col("status") != "F", F.col("status"))
    return m.orders().select(
        "order_id", surrogate_key("order_id").alias("order_sk"),
        surrogate_key("customer_id", "order_date").alias("version_sk"),
        surrogate_key(F.col("customer_id"), part).alias("null_part_sk"),
    )


@query("f15_defaults_and_guards", with_("ful", """
SELECT order_id, coalesce(shipped_date_key, 0) AS shipped_or_zero,
       nullif(days_to_ship, 0) AS days_or_null FROM ful"""))
def defaults_and_guards(m):
    return m.fulfillment().select(
        "order_id", F.coalesce("shipped_date_key", F.lit(0)).alias("shipped_or_zero"),
        F.nullif(F.col("days_to_ship"), F.lit(0)).alias("days_or_null"),
    )


@query("f16_arrays", """
SELECT r.r_name AS region_name, string_agg(n.n_name, '|' ORDER BY n.n_name) AS nations,
       count(*) AS n FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY r.r_name""")
def arrays(m):
    names = m.territories().join(m.regions(), "region_id").groupBy("region_name").agg(
        F.sort_array(F.collect_list("territory_name")).alias("names")
    )
    return names.select(
        "region_name", F.array_join("names", "|").alias("nations"), F.size("names").alias("n")
    )


@query("f17_casts", with_("l", """
SELECT order_id, line_number, product_id, employee_id, CAST(CAST(net AS DECIMAL(12,2)) AS DOUBLE)
       AS net_2, CAST(quantity AS DOUBLE) AS quantity_double, CAST(quantity AS VARCHAR)
       AS quantity_text, CAST(quantity - 1 AS BOOLEAN) AS more_than_one FROM l"""))
def casts(m):
    q = F.col("quantity")
    return m.lines().select(
        "order_id", "line_number", "product_id", "employee_id",
        F.col("net").cast("decimal(12,2)").alias("net_2"),
        q.cast("double").alias("quantity_double"), q.cast("string").alias("quantity_text"),
        (q - 1).cast("boolean").alias("more_than_one"),
    )


@query("f18_typed_literals", """
SELECT c_custkey AS customer_id, '1900-01-01' AS valid_from, '9999-12-31' AS valid_to,
       CAST(NULL AS VARCHAR) AS changed_on FROM customer""")
def typed_literals(m):
    return m.customers().select(
        "customer_id", F.lit(FIRST_DAY).alias("valid_from"), F.lit(LAST_DAY).alias("valid_to"),
        F.lit(None).cast("date").alias("changed_on"),
    )
