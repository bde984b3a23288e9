"""Joins (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stardw.functions import changed, mean, surrogate_key
from stardw.operators import asof, bridge, dims, junk
from stardw.operators.skew import hot_keys

from .registry import query
from .sql import mean as sql_mean
from .sql import with_


@query("c01_inner_join", with_("o l", """
SELECT o.status, count(*) AS lines, CAST(sum(l.net) AS DOUBLE) AS net
FROM l JOIN o ON o.order_id = l.order_id GROUP BY o.status"""))
def inner_join(m):
    return m.sales("status").groupBy("status").agg(
        F.count("*").alias("lines"), F.sum("net").alias("net")
    )


@query("c02_left_join", with_("o l", """
SELECT o.order_id, coalesce(s.lines, 0) AS lines
FROM o LEFT JOIN (SELECT order_id, count(*) AS lines FROM l GROUP BY order_id) s
  ON s.order_id = o.order_id"""))
def left_join(m):
    per_order = m.lines().groupBy("order_id").agg(F.count("*").alias("n"))
    return m.orders().join(per_order, "order_id", "left").select(
        "order_id", F.coalesce("n", F.lit(0)).alias("lines")
    )


@query("c03_self_join", with_("emp", "SELECT employee_id, full_name, reports_to, manager_name FROM emp"))
def self_join(m):
    named = dims.with_parent(
        m.employees(), "employee_id", "reports_to", "full_name", "manager_name"
    )
    return named.select("employee_id", "full_name", "reports_to", "manager_name")


POINT_IN_TIME = with_("o cust_loads", """
SELECT o.order_id, o.customer_id, CAST(o.order_date AS VARCHAR) AS order_date,
       v.priority AS known_priority, v.status AS known_status,
       CAST(v.valid_from AS VARCHAR) AS version_from
FROM o JOIN cust_loads v ON v.customer_id = o.customer_id
 AND o.order_date >= v.valid_from AND o.order_date <= v.valid_to""")


def point_in_time(m, form, split=None):
    orders = m.orders().select("order_id", "customer_id", "order_date")
    versions = m.dim_customer_loads().select(
        "customer_id", "valid_from", "valid_to",
        F.col("priority").alias("known_priority"), F.col("status").alias("known_status"),
        F.col("valid_from").alias("version_from"),
    )
    hot = hot_keys(orders, split) if split else None
    return asof.as_of_join(
        orders, versions, "customer_id", "order_date",
        ["known_priority", "known_status", "version_from"], form=form, hot=hot,
        spread_by=["order_id"],
    ).select(
        "order_id", "customer_id", "order_date", "known_priority", "known_status",
        "version_from",
    )


@query("c04_point_in_time_range", POINT_IN_TIME)
def point_in_time_range(m):
    return point_in_time(m, "range")


@query("c04_point_in_time_bucket", POINT_IN_TIME)
def point_in_time_bucket(m):
    return point_in_time(m, "bucket")


@query("c04_point_in_time_lookup", POINT_IN_TIME)
def point_in_time_lookup(m):
    return point_in_time(m, "lookup")


@query("c04_point_in_time_carried", POINT_IN_TIME)
def point_in_time_carried(m):
    return point_in_time(m, "carried")


@query("c04_point_in_time_split", POINT_IN_TIME)
def point_in_time_split(m):
    return point_in_time(m, "bucket", ["customer_id"])


@query("c04_point_in_time_lookup_split", POINT_IN_TIME)
def point_in_time_lookup_split(m):
    return point_in_time(m, "lookup", ["customer_id", "order_date"])


@query("c04_price_at_sale", with_("o l prod", """
SELECT l.order_id, l.product_id, l.employee_id, l.line_number,
       CAST(l.unit_price AS DOUBLE) AS unit_price, CAST(p.unit_price AS DOUBLE) AS list_price
FROM l JOIN o ON o.order_id = l.order_id
JOIN prod p ON p.product_id = l.product_id
 AND o.order_date >= p.valid_from AND o.order_date <= p.valid_to"""))
def price_at_sale(m):
    versions = m.dim_product().withColumnRenamed("unit_price", "list_price")
    return asof.as_of_join(
        m.sales("order_date"), versions, "product_id", "order_date", ["list_price"],
        span=asof.years_of(m.orders(), "order_date"),
    ).select("order_id", "product_id", "employee_id", "line_number", "unit_price", "list_price")


@query("c04_unmatched_orders", with_("o cust_loads", """
SELECT o.order_id, o.customer_id, CAST(o.order_date AS VARCHAR) AS order_date FROM o
WHERE NOT EXISTS (SELECT 1 FROM cust_loads v WHERE v.customer_id = o.customer_id
                  AND o.order_date >= v.valid_from AND o.order_date <= v.valid_to)"""))
def unmatched_orders(m):
    orders = m.orders().select("order_id", "customer_id", "order_date")
    return asof.unmatched(orders, m.dim_customer_loads(), "customer_id", "order_date")


@query("c05_current_version", with_("o cust", """
SELECT v.priority AS current_priority, count(*) AS orders
FROM o JOIN cust v ON v.customer_id = o.customer_id AND v.is_current GROUP BY v.priority"""))
def current_version(m):
    versions = m.dim_customer().withColumnRenamed("priority", "current_priority")
    joined = asof.current_join(
        m.orders().select("order_id", "customer_id"), versions, "customer_id",
        ["current_priority"],
    )
    return joined.groupBy("current_priority").agg(F.count("*").alias("orders"))


@query("c06_naive_and_point_in_time", with_("o l cust", """
, sale AS (SELECT l.order_id, l.product_id, l.employee_id, l.line_number, o.customer_id,
                  o.order_date FROM l JOIN o ON o.order_id = l.order_id)
SELECT count(*) AS lines, count(*) FILTER (WHERE a.priority IS DISTINCT FROM c.priority)
       AS lines_with_other_profile
FROM sale s JOIN cust a ON a.customer_id = s.customer_id
 AND s.order_date >= a.valid_from AND s.order_date <= a.valid_to
JOIN cust c ON c.customer_id = s.customer_id AND c.is_current"""))
def naive_and_point_in_time(m):
    """Lines whose customer profile at the sale is not the one of today.

    Both profiles are found per order; the line only counts.
    """
    then = m.dim_customer().withColumnRenamed("priority", "then")
    now = m.dim_customer().withColumnRenamed("priority", "now")
    orders = asof.as_of_join(
        m.orders().select("order_id", "customer_id", "order_date"), then, "customer_id",
        "order_date", ["then"],
    )
    both = asof.current_join(orders, now, "customer_id", ["now"])
    lines = m.lines().groupBy("order_id").agg(F.count("*").alias("n"))
    differs = changed(F.col("then"), F.col("now"))
    return lines.join(both, "order_id").agg(
        F.sum("n").alias("lines"),
        F.sum(F.when(differs, F.col("n")).otherwise(0)).alias("lines_with_other_profile"),
    )


@query("c07_star_join", with_("o l emp terr", """
SELECT e.manager_name, t.region_name, year(o.order_date) AS order_year,
       p.p_type AS category, count(*) AS lines, CAST(sum(l.net) AS DOUBLE) AS net
FROM l JOIN o ON o.order_id = l.order_id
JOIN part p ON p.p_partkey = l.product_id
JOIN emp e ON e.employee_id = l.employee_id
JOIN customer c ON c.c_custkey = o.customer_id
JOIN terr t ON t.territory_id = c.c_nationkey
GROUP BY ALL"""))
def star_join(m):
    members = dims.with_parent(
        m.employees(), "employee_id", "reports_to", "full_name", "manager_name"
    ).select("employee_id", "manager_name")
    places = m.customers().select("customer_id", "territory_id").join(
        m.dim_territory().select("territory_id", "region_name"), "territory_id"
    )
    return (
        m.sales("customer_id", "order_date")
        .join(m.products().select("product_id", "category"), "product_id")
        .join(members, "employee_id")
        .join(places, "customer_id")
        .groupBy(
            "manager_name", "region_name", F.year("order_date").alias("order_year"), "category"
        )
        .agg(F.count("*").alias("lines"), F.sum("net").alias("net"))
    )


FLAG_COLUMNS = """
CASE WHEN l.discount = 0 THEN 'None' WHEN l.discount <= 0.05 THEN 'Low'
     WHEN l.discount <= 0.15 THEN 'Medium' ELSE 'High' END AS discount_band,
l.net > 1000 AS is_high_value,
CASE o.ship_via WHEN 1 THEN 'Express' WHEN 2 THEN 'Standard' ELSE 'Economy' END AS ship_mode"""


@query("c08_computed_key_join", with_("o l", f"""
SELECT discount_band, is_high_value, ship_mode, count(*) AS lines
FROM (SELECT {FLAG_COLUMNS} FROM l JOIN o ON o.order_id = l.order_id) GROUP BY ALL"""))
def computed_key_join(m):
    flags = m.flags()
    keyed = junk.assign_flags(m.sales("ship_via"), flags)
    return (
        keyed.groupBy("order_flags_sk").agg(F.count("*").alias("lines"))
        .join(F.broadcast(flags), "order_flags_sk")
        .select("discount_band", "is_high_value", "ship_mode", "lines")
    )


@query("c09_combinations", with_("o l", f"""
, used AS (SELECT {FLAG_COLUMNS} FROM l JOIN o ON o.order_id = l.order_id)
SELECT b.discount_band, h.is_high_value, s.ship_mode,
       (SELECT count(*) FROM used u WHERE u.discount_band = b.discount_band
          AND u.is_high_value = h.is_high_value AND u.ship_mode = s.ship_mode) AS lines
FROM (VALUES ('None'), ('Low'), ('Medium'), ('High')) b(discount_band)
CROSS JOIN (VALUES (false), (true)) h(is_high_value)
CROSS JOIN (VALUES ('Express'), ('Standard'), ('Economy')) s(ship_mode)"""))
def combinations(m):
    """All combinations of the flag domains, with the lines that use each."""
    used = junk.with_flags(m.sales("ship_via")).groupBy(*junk.FLAGS).agg(
        F.count("*").alias("n")
    )
    return m.flags().join(used, junk.FLAGS, "left").select(
        *junk.FLAGS, F.coalesce("n", F.lit(0)).alias("lines")
    )


@query("c10_semi_join", with_("o load_points", """
SELECT status, count(*) AS orders FROM o
WHERE customer_id IN (SELECT customer_id FROM load_points WHERE nth > 1) GROUP BY status"""))
def semi_join(m):
    moved = m.dim_customer_loads().filter(~F.col("is_current")).select("customer_id")
    orders = m.orders().join(moved, "customer_id", "left_semi")
    return orders.groupBy("status").agg(F.count("*").alias("orders"))


@query("c11_anti_join", with_("o", """
SELECT o.order_id FROM o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o.order_id)"""))
def anti_join(m):
    return m.orders().select("order_id").join(m.lines(), "order_id", "left_anti")


@query("c12_new_members", with_("loads", """
SELECT customer_id, priority FROM loads WHERE load_date = :second_load
AND customer_id NOT IN (SELECT customer_id FROM loads WHERE load_date = :first_load)"""))
def new_members(m):
    old, new = m.customer_snapshot(m.load_dates()[0]), m.customer_snapshot(m.load_dates()[1])
    return new.join(old.select("customer_id"), "customer_id", "left_anti").select(
        "customer_id", "priority"
    )


@query("c13_orphan_count", with_("cust_loads", """
SELECT count(*) AS orders, count(*) FILTER (WHERE v.customer_id IS NULL) AS without_member
FROM orders LEFT JOIN (SELECT DISTINCT customer_id FROM cust_loads) v
  ON v.customer_id = o_custkey"""))
def orphan_count(m):
    orders = m.orders().select("order_id", "customer_id")
    missing = orders.join(m.dim_customer_loads(), "customer_id", "left_anti")
    return orders.agg(F.count("*").alias("orders")).withColumn(
        "without_member", missing.agg(F.count("*")).scalar()
    )


@query("c14_bridge_join", with_("l pairs terr", """
SELECT t.territory_name, count(*) AS members, CAST(sum(e.lines) AS BIGINT) AS lines
FROM (SELECT employee_id, count(*) AS lines FROM l GROUP BY employee_id) e
JOIN pairs p ON p.employee_id = e.employee_id
JOIN terr t ON t.territory_id = p.territory_id GROUP BY t.territory_name"""))
def bridge_join(m):
    per_member = m.lines().groupBy("employee_id").agg(F.count("*").alias("lines")).select(
        surrogate_key("employee_id").alias("employee_sk"), "lines"
    )
    return (
        bridge.through_bridge(per_member, m.bridge())
        .join(m.dim_territory(), "territory_sk")
        .groupBy("territory_name")
        .agg(F.count("*").alias("members"), F.sum("lines").alias("lines"))
    )


@query("c15_role_playing_join", with_("ful", """
SELECT order_id, year(order_date) AS ordered_year, month(required_date) AS required_month,
       year(shipped_date) AS shipped_year, strftime(shipped_date, '%A') AS shipped_day_name
FROM ful"""))
def role_playing_join(m):
    dates = m.dim_date()
    facts = m.fulfillment()
    for role, how in [("order", "inner"), ("required", "left"), ("shipped", "left")]:
        one = dims.as_role(dates, role).withColumnRenamed(f"{role}_date_key", f"_{role}_key")
        # A calendar is bounded by the days of its years.
        facts = facts.join(
            F.broadcast(one), F.col(f"{role}_date_key") == F.col(f"_{role}_key"), how
        )
    return facts.select(
        "order_id", F.col("order_year").alias("ordered_year"), "required_month",
        "shipped_year", "shipped_day_name",
    )


@query("c16_lookup_by_id", """
SELECT n.n_nationkey AS territory_id, n.n_name AS territory_name, r.r_name AS region_name
FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey""")
def lookup_by_id(m):
    return dims.lookup(
        m.territories(), m.regions(), "region_id", ["region_name"], "inner"
    ).select("territory_id", "territory_name", "region_name")


@query("c17_lookup_in_update", with_("o", f"""
SELECT order_id, (SELECT {sql_mean('l_quantity')} FROM lineitem WHERE l_orderkey = o.order_id)
       AS mean_quantity FROM o"""))
def lookup_in_update(m):
    per_order = m.lines().groupBy("order_id").agg(
        mean(F.col("quantity")).alias("mean_quantity")
    )
    return m.orders().select("order_id").join(per_order, "order_id", "left")


def scd3_sql() -> str:
    """Current values, and of each attribute the last change over all loads."""
    def last_change(attr: str) -> str:
        return f"""
  {attr}_changes AS (SELECT customer_id, old AS previous_{attr}, load_date AS {attr}_changed_on FROM (
      SELECT customer_id, load_date, {attr}, lag({attr}) OVER w AS old, row_number() OVER w AS nth
      FROM loads WINDOW w AS (PARTITION BY customer_id ORDER BY load_date))
    WHERE nth > 1 AND {attr} IS DISTINCT FROM old
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY load_date DESC) = 1)"""

    return with_("loads", f""",{last_change('priority')},{last_change('status')}
SELECT c.customer_id, c.priority AS current_priority, p.previous_priority,
       CAST(p.priority_changed_on AS VARCHAR) AS priority_changed_on, c.status AS current_status,
       s.previous_status, CAST(s.status_changed_on AS VARCHAR) AS status_changed_on
FROM loads c LEFT JOIN priority_changes p ON p.customer_id = c.customer_id
LEFT JOIN status_changes s ON s.customer_id = c.customer_id WHERE c.load_date = :last_load""")


SCD3_SQL = scd3_sql()


@query("c18_type2_beside_type3", f"""
SELECT t3.customer_id, t2.priority AS version_priority,
       CAST(t2.valid_from AS VARCHAR) AS version_from, t3.current_priority,
       t3.previous_priority
FROM ({SCD3_SQL}) t3 JOIN ({with_("cust_loads", "SELECT * FROM cust_loads WHERE is_current")}) t2
  ON t2.customer_id = t3.customer_id""")
def type2_beside_type3(m):
    versions = m.dim_customer_loads().filter("is_current").select(
        "customer_id", F.col("priority").alias("version_priority"),
        F.col("valid_from").alias("version_from"),
    )
    return m.dim_customer_scd3().join(versions, "customer_id").select(
        "customer_id", "version_priority", "version_from", "current_priority",
        "previous_priority",
    )
