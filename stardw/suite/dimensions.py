"""Keys and dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from stardw.functions import dense_key, grown_keys
from stardw.operators import bridge, dims, facts, junk
from stardw.operators.merge import current_state

from .registry import query
from .sql import sk, with_


@query("p05_member_key", f"""
SELECT {sk('p_type')} AS category_sk, p_type AS category, count(*) AS products
FROM part GROUP BY p_type""")
def member_key(m):
    counted = m.products().groupBy("category").agg(F.count("*").alias("products"))
    return m.dim_category().join(counted, "category").select(
        "category_sk", "category", "products"
    )


@query("p06_version_key", with_("cust", f"""
SELECT {sk('customer_id', 'valid_from')} AS customer_sk, customer_id,
       CAST(valid_from AS VARCHAR) AS valid_from FROM cust"""))
def version_key(m):
    return m.dim_customer().select("customer_sk", "customer_id", "valid_from")


@query("p07_sequential_key", """
SELECT row_number() OVER (ORDER BY substr(md5(CAST(c_custkey AS VARCHAR)), 1, 3), c_custkey)
       AS customer_no, c_custkey AS customer_id FROM customer""")
def sequential_key(m):
    return dense_key(m.customers().select("customer_id"), "customer_id", "customer_no")


@query("p07_growing_key", """
WITH first_year AS (SELECT o_custkey AS customer_id, min(year(o_orderdate)) AS y FROM orders GROUP BY ALL),
  loads AS (SELECT customer_id, dense_rank() OVER (ORDER BY y) AS load FROM first_year)
SELECT row_number() OVER (ORDER BY load, substr(md5(CAST(customer_id AS VARCHAR)), 1, 3), customer_id)
       AS customer_no, customer_id FROM loads""")
def growing_key(m):
    """One load per year of orders, each repeating all earlier members: these keep their numbers."""
    orders, known = m.orders().select("customer_id", "order_date"), None
    for day in m.load_dates():
        members = orders.filter(F.col("order_date") < F.lit(day))
        known = m.written(grown_keys(known, members, "customer_id", "customer_no"))
    return known


EMPLOYEE_DIM = f"""
SELECT {sk('e.employee_id')} AS employee_sk, e.employee_id, e.full_name, e.reports_to,
       e.manager_name, x.territory_list, x.region_name
FROM emp e LEFT JOIN (
    SELECT p.employee_id, string_agg(t.territory_name, ', ' ORDER BY t.territory_name)
             AS territory_list, min(t.region_name) AS region_name
    FROM pairs p JOIN terr t ON t.territory_id = p.territory_id GROUP BY p.employee_id) x
  ON x.employee_id = e.employee_id"""


@query("p08_employee_dimension", with_("emp pairs terr", EMPLOYEE_DIM))
def employee_dimension(m):
    return m.dim_employee()


@query("p09_territory_dimension", with_("terr", f"""
SELECT {sk('territory_id')} AS territory_sk, territory_id, territory_name, region_name FROM terr"""))
def territory_dimension(m):
    return m.dim_territory()


@query("p09_product_lookup", f"""
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       {sk('p_type')} AS category_sk, p_brand AS brand, {sk('p_brand')} AS brand_sk FROM part""")
def product_lookup(m):
    brands = dims.keyed_dimension(m.products(), ["brand"], "brand", "brand_sk")
    named = dims.lookup(m.products(), m.dim_category(), "category", ["category_sk"])
    return dims.lookup(named, brands, "brand", ["brand_sk"]).select(
        "product_id", "product_name", "category", "category_sk", "brand", "brand_sk"
    )


@query("p10_date_dimension", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(CAST(d AS DATE) AS VARCHAR)
         AS full_date, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
       monthname(d) AS month_name, day(d) AS day, isodow(d) - 1 AS weekday,
       dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
FROM (SELECT make_date(min(year(o_orderdate)), 1, 1) AS a,
             make_date(max(year(o_orderdate)) + 1, 12, 31) AS b FROM orders) e,
     generate_series(e.a, e.b, INTERVAL 1 DAY) g(d)""")
def date_dimension(m):
    return m.dim_date()


@query("p31_bridge", with_("pairs", f"""
SELECT DISTINCT {sk('employee_id')} AS employee_sk, {sk('territory_id')} AS territory_sk
FROM pairs"""))
def bridge_table(m):
    return m.bridge()


@query("p32_bridge_weight", with_("pairs", f"""
SELECT {sk('employee_id')} AS employee_sk, {sk('territory_id')} AS territory_sk,
       count(*) OVER (PARTITION BY employee_id) AS parts,
       CAST(1 AS DOUBLE) / count(*) OVER (PARTITION BY employee_id) AS weight FROM pairs"""))
def bridge_weight(m):
    return bridge.with_weight(m.bridge())


FLAGGED = """
, flagged AS (SELECT l.*,
    CASE WHEN l.discount = 0 THEN 'None' WHEN l.discount <= 0.05 THEN 'Low'
         WHEN l.discount <= 0.15 THEN 'Medium' ELSE 'High' END AS discount_band,
    l.net > 1000 AS is_high_value,
    CASE o.ship_via WHEN 1 THEN 'Express' WHEN 2 THEN 'Standard' ELSE 'Economy' END AS ship_mode
  FROM l JOIN o ON o.order_id = l.order_id)"""
FLAG_SK = sk("discount_band", "is_high_value", "ship_mode")


@query("p33_flags_dimension", with_("o l", FLAGGED + f"""
, d AS (SELECT {FLAG_SK} AS order_flags_sk, *
        FROM (VALUES ('None'), ('Low'), ('Medium'), ('High')) b(discount_band),
             (VALUES (false), (true)) h(is_high_value),
             (VALUES ('Express'), ('Standard'), ('Economy')) s(ship_mode))
SELECT d.*, (SELECT count(*) FROM flagged f WHERE f.discount_band = d.discount_band
             AND f.is_high_value = d.is_high_value AND f.ship_mode = d.ship_mode) > 0 AS in_use
FROM d"""))
def flags_dimension(m):
    """All combinations, and whether the facts use them."""
    used = junk.with_flags(m.sales("ship_via")).select(*junk.FLAGS).distinct().withColumn(
        "_used", F.lit(True)
    )
    return m.flags().join(used, junk.FLAGS, "left").select(
        "order_flags_sk", *junk.FLAGS, F.coalesce("_used", F.lit(False)).alias("in_use")
    )


@query("p34_assign_flags", with_("o l", FLAGGED + f"""
SELECT order_id, product_id, employee_id, line_number, {FLAG_SK} AS order_flags_sk FROM flagged"""))
def assign_flags(m):
    return junk.assign_flags(m.sales("ship_via"), m.flags()).select(
        *facts.SALES_GRAIN, "order_flags_sk"
    )


@query("p35_assign_missing_flags", with_("o l", FLAGGED + f"""
SELECT order_id, product_id, employee_id, line_number,
       CASE WHEN line_number <= 3 THEN -1 ELSE {FLAG_SK} END AS order_flags_sk FROM flagged"""))
def assign_missing_flags(m):
    """Rows that already have a key keep it."""
    given = F.when(F.col("line_number") <= 3, F.lit(-1)).cast("bigint")
    keyed = m.sales("ship_via").withColumn("order_flags_sk", given)
    return junk.assign_flags(keyed, m.flags(), only_missing=True).select(
        *facts.SALES_GRAIN, "order_flags_sk"
    )


@query("p36_growing_flags", with_("o l", FLAGGED + f"""
SELECT DISTINCT {FLAG_SK} AS order_flags_sk, discount_band, is_high_value, ship_mode
FROM flagged"""))
def growing_flags(m):
    """The dimension after the lines before 1998, then after all lines."""
    sales = m.sales("ship_via", "order_date")
    none_yet = m.flags().filter(F.lit(False))
    early = sales.filter(F.col("order_date") < F.lit("1998-01-01").cast("date"))
    return junk.grow_flags(junk.grow_flags(none_yet, early), sales)


@query("p37_factless_activity", with_("act", f"""
SELECT CAST(strftime(activity_date, '%Y%m%d') AS INTEGER) AS activity_date_key,
       {sk('employee_id')} AS employee_sk, {sk('territory_id')} AS territory_sk FROM act"""))
def factless_activity(m):
    """Loaded in two steps; the second brings rows the first has already."""
    events = m.activity_events()
    early = events.filter(F.col("activity_date") < F.lit("1998-01-01").cast("date"))
    keys, places = m.employee_keys(), m.dim_territory()
    grain = ["activity_date_key", "employee_sk", "territory_sk"]
    first = m.spread(facts.activity_fact(early, keys, places), *grain, times=2)
    everything = m.spread(facts.activity_fact(events, keys, places), *grain, times=2)
    return current_state(facts.add_activity(first, everything))


@query("p37_territories_served", with_("served", f"""
SELECT CAST(strftime(activity_date, '%Y%m%d') AS INTEGER) AS activity_date_key,
       {sk('employee_id')} AS employee_sk, {sk('territory_id')} AS territory_sk FROM served"""))
def territories_served(m):
    """The same fact on the territories of the customers, off the bridge as well."""
    return facts.activity_fact(m.served_events(), m.employee_keys(), m.dim_territory())


@query("p38_served_off_bridge", with_("served pairs", """
SELECT count(*) AS off_bridge FROM served s WHERE NOT EXISTS (
  SELECT 1 FROM pairs p WHERE p.employee_id = s.employee_id AND p.territory_id = s.territory_id)"""))
def served_off_bridge(m):
    """Activity in territories that are not assigned to the member; coverage leaves it out."""
    served = m.served_events().distinct()
    off = served.join(m.member_territories(), ["employee_id", "territory_id"], "left_anti")
    return off.agg(F.count("*").alias("off_bridge"))


@query("p38_coverage", with_("act pairs", """
SELECT year(activity_date) * 100 + month(activity_date) AS period,
       count(DISTINCT (a.employee_id, a.territory_id)) AS active_pairs,
       (SELECT count(*) FROM pairs) AS expected_pairs,
       CAST(count(DISTINCT (a.employee_id, a.territory_id)) AS DOUBLE)
         / (SELECT count(*) FROM pairs) AS coverage
FROM act a JOIN pairs p ON p.employee_id = a.employee_id AND p.territory_id = a.territory_id
GROUP BY ALL"""))
def coverage(m):
    month = F.floor(F.col("activity_date_key") / 100).cast("int")
    return facts.coverage(m.fact_activity(), m.bridge(), month)


@query("p39_role_playing", """
, n AS (SELECT count(*) AS days FROM (
    SELECT make_date(min(year(o_orderdate)), 1, 1) AS a,
           make_date(max(year(o_orderdate)) + 1, 12, 31) AS b FROM orders) e,
    generate_series(e.a, e.b, INTERVAL 1 DAY))
SELECT role, days AS "rows" FROM n, (VALUES ('base'), ('order'), ('required'), ('shipped')) r(role)
""".strip().replace(", n AS", "WITH n AS", 1))
def role_playing(m):
    dates = m.dim_date()
    return dims.role_counts(
        dates, {r: dims.as_role(dates, r) for r in ("order", "required", "shipped")}
    )


@query("p40_degenerate_dimension", with_("l", """
SELECT order_id, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS quantity,
       CAST(sum(net) AS DOUBLE) AS net FROM l GROUP BY order_id"""))
def degenerate_dimension(m):
    """The order number stays in the fact and groups its lines."""
    return m.lines().groupBy("order_id").agg(
        F.count("*").alias("lines"), F.sum("quantity").alias("quantity"),
        F.sum("net").alias("net"),
    )
