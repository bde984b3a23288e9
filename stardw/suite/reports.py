"""Analytical reports (Q)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stardw.functions import mean
from stardw.operators import asof, bridge, dims, facts, junk
from stardw.plans import reports

from .dimensions import FLAGGED
from .joins import SCD3_SQL
from .registry import query
from .sql import mean as sql_mean
from .sql import pct, sk, with_
from .warehouse import SALES


def with_product(m, *columns):
    return m.lines().join(m.products().select("product_id", *columns), "product_id")


def keyed_sales(m):
    """Lines with the key of their member."""
    return m.lines().join(m.employee_keys(), "employee_id")


@query("q01_revenue_by_category", with_("l", f"""
SELECT p.p_type AS category, count(DISTINCT l.order_id) AS orders,
       CAST(sum(l.gross) AS DOUBLE) AS gross, CAST(sum(l.net) AS DOUBLE) AS net,
       CAST(sum(l.gross - l.net) AS DOUBLE) AS discount_total,
       {sql_mean('l.discount')} * 100 AS mean_discount_pct
FROM l JOIN part p ON p.p_partkey = l.product_id GROUP BY p.p_type"""))
def revenue_by_category(m):
    return reports.revenue_by(with_product(m, "category"), ["category"])


@query("q02_top_customers", with_("o l cust", """
SELECT t.customer_id, c.c_name AS customer_name, v.priority AS current_priority, t.orders,
       CAST(t.net AS DOUBLE) AS net, t.place, CAST(t.net AS DOUBLE) / t.n AS mean_line
FROM (SELECT o.customer_id, count(DISTINCT o.order_id) AS orders, sum(l.net) AS net,
             count(*) AS n, rank() OVER (ORDER BY sum(l.net) DESC) AS place
      FROM l JOIN o ON o.order_id = l.order_id GROUP BY o.customer_id) t
JOIN customer c ON c.c_custkey = t.customer_id
JOIN cust v ON v.customer_id = t.customer_id AND v.is_current WHERE t.place <= 10"""))
def top_customers(m):
    """By customer, not by version; the profile shown is the current one."""
    best = reports.top_members(m.sales("customer_id"), "customer_id", 10)
    profile = m.dim_customer().filter("is_current").select(
        "customer_id", F.col("priority").alias("current_priority")
    )
    return best.join(m.customers().select("customer_id", "customer_name"), "customer_id").join(
        profile, "customer_id"
    )


@query("q02_top_customer_versions", with_("o l cust", """
SELECT v.customer_id, CAST(v.valid_from AS VARCHAR) AS valid_from, v.priority,
       CAST(sum(l.net) AS DOUBLE) AS net, rank() OVER (ORDER BY sum(l.net) DESC) AS place
FROM l JOIN o ON o.order_id = l.order_id JOIN cust v ON v.customer_id = o.customer_id
 AND o.order_date >= v.valid_from AND o.order_date <= v.valid_to
GROUP BY v.customer_id, v.valid_from, v.priority
QUALIFY rank() OVER (ORDER BY sum(l.net) DESC) <= 10"""))
def top_customer_versions(m):
    """By version: a customer with two profiles may show up twice."""
    versions = m.dim_customer()
    orders = asof.as_of_join(
        m.orders().select("order_id", "customer_id", "order_date"), versions,
        "customer_id", "order_date", ["customer_sk"],
    )
    totals = m.lines().join(orders, "order_id").groupBy("customer_sk").agg(
        F.sum("net").alias("net")
    )
    return reports.ranked(totals, "net", top=10).join(versions, "customer_sk").select(
        "customer_id", "valid_from", "priority", "net", "place"
    )


@query("q03_delivery_by_shipper", with_("ful shipper", f"""
SELECT s.shipper_name, count(*) AS delivered, count(*) FILTER (WHERE NOT f.is_late) AS on_time,
       count(*) FILTER (WHERE f.is_late) AS late,
       {pct('count(*) FILTER (WHERE NOT f.is_late)', 'count(*)')} AS on_time_pct,
       {sql_mean('f.days_to_ship')} AS mean_days
FROM ful f JOIN shipper s ON s.shipper_id = f.ship_via
WHERE f.shipped_date_key IS NOT NULL GROUP BY s.shipper_name"""))
def delivery_by_shipper(m):
    named = m.fulfillment().join(
        m.dim_shipper().select(F.col("shipper_id").alias("ship_via"), "shipper_name"), "ship_via"
    )
    return reports.delivery(named, ["shipper_name"])


AT_SALE = """
SELECT c.priority AS priority_at_sale, year(o.order_date) AS order_year,
       count(DISTINCT o.order_id) AS orders, CAST(sum(l.net) AS DOUBLE) AS net,
       rank() OVER (PARTITION BY year(o.order_date) ORDER BY sum(l.net) DESC) AS place
FROM l JOIN o ON o.order_id = l.order_id JOIN cust_loads c ON c.customer_id = o.customer_id
 AND o.order_date >= c.valid_from AND o.order_date <= c.valid_to
GROUP BY c.priority, year(o.order_date)"""


@query("q04_revenue_by_profile_at_sale", with_("o l cust_loads", AT_SALE))
def revenue_by_profile_at_sale(m):
    """Revenue by the profile known at the time of the sale, ranked per year."""
    return reports.ranked(profile_at_sale(m), "net", ["order_year"])


@query("q04_best_profiles_per_year", with_("o l cust_loads", f"SELECT * FROM ({AT_SALE}) WHERE place <= 3"))
def best_profiles_per_year(m):
    return reports.ranked(profile_at_sale(m), "net", ["order_year"], top=3)


def profile_at_sale(m):
    versions = m.dim_customer_loads().withColumnRenamed("priority", "priority_at_sale")
    orders = asof.as_of_join(
        m.orders().select("order_id", "customer_id", "order_date"), versions,
        "customer_id", "order_date", ["priority_at_sale"],
    )
    per_order = m.lines().groupBy("order_id").agg(F.sum("net").alias("net"))
    return per_order.join(orders, "order_id").groupBy(
        "priority_at_sale", F.year("order_date").alias("order_year")
    ).agg(F.count("*").alias("orders"), F.sum("net").alias("net"))


@query("q04_top_countries_per_year", with_("o l", """
SELECT n.n_name AS country, year(o.order_date) AS order_year,
       count(DISTINCT o.order_id) AS orders, CAST(sum(l.net) AS DOUBLE) AS net,
       rank() OVER (PARTITION BY year(o.order_date) ORDER BY sum(l.net) DESC) AS place
FROM l JOIN o ON o.order_id = l.order_id JOIN customer c ON c.c_custkey = o.customer_id
JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY n.n_name, year(o.order_date)
QUALIFY rank() OVER (PARTITION BY year(o.order_date) ORDER BY sum(l.net) DESC) <= 5"""))
def top_countries_per_year(m):
    per_order = m.lines().groupBy("order_id").agg(F.sum("net").alias("net"))
    totals = (
        per_order.join(m.orders().select("order_id", "customer_id", "order_date"), "order_id")
        .join(m.countries(), "customer_id")
        .groupBy(F.col("ship_country").alias("country"), F.year("order_date").alias("order_year"))
        .agg(F.count("*").alias("orders"), F.sum("net").alias("net"))
    )
    return reports.ranked(totals, "net", ["order_year"], top=5)


@query("q05_price_history", with_("o l prod", """
SELECT p.product_id, q.p_name AS product_name, q.p_type AS category,
       CAST(p.unit_price AS DOUBLE) AS unit_price, CAST(p.valid_from AS VARCHAR) AS valid_from,
       CAST(p.valid_to AS VARCHAR) AS valid_to, count(s.net) AS sales,
       CAST(coalesce(sum(s.net), 0) AS DOUBLE) AS net
FROM prod p JOIN part q ON q.p_partkey = p.product_id
LEFT JOIN (SELECT l.product_id, o.order_date, l.net FROM l JOIN o ON o.order_id = l.order_id) s
  ON s.product_id = p.product_id AND s.order_date >= p.valid_from AND s.order_date <= p.valid_to
GROUP BY ALL"""))
def price_history(m):
    versions = m.dim_product()
    sold = asof.as_of_join(
        m.sales("order_date"), versions, "product_id", "order_date", ["product_sk"],
        span=asof.years_of(m.orders(), "order_date"),
    )
    named = m.products().select("product_id", "product_name", "category")
    return reports.version_sales(versions, sold, "product_sk").join(named, "product_id").select(
        "product_id", "product_name", "category", "unit_price", "valid_from", "valid_to",
        "sales", "net",
    )


@query("q06_revenue_by_manager", with_("l emp", """
SELECT coalesce(e.manager_name, '(top)') AS manager, e.full_name, count(*) AS lines,
       CAST(sum(l.net) AS DOUBLE) AS net, CAST(sum(l.net) AS DOUBLE) / count(*) AS mean_line
FROM l JOIN emp e ON e.employee_id = l.employee_id GROUP BY ALL"""))
def revenue_by_manager(m):
    members = dims.with_parent(
        m.employees(), "employee_id", "reports_to", "full_name", "manager_name"
    )
    return reports.by_hierarchy(m.lines(), members)


@query("q07_seasonality", with_("o l", """
, mo AS (SELECT year(o.order_date) AS order_year, quarter(o.order_date) AS order_quarter,
                month(o.order_date) AS order_month, monthname(o.order_date) AS month_name,
                count(DISTINCT o.order_id) AS orders, sum(l.net) AS net
         FROM l JOIN o ON o.order_id = l.order_id GROUP BY ALL)
SELECT order_year, order_quarter, order_month, month_name, orders, CAST(net AS DOUBLE) AS net,
       CAST(sum(net) OVER (PARTITION BY order_year, order_quarter ORDER BY order_month)
            AS DOUBLE) AS quarter_to_date,
       CAST(net - lag(net) OVER (ORDER BY order_year, order_month) AS DOUBLE) AS change FROM mo"""))
def seasonality(m):
    return reports.seasonality(m.sales("order_date"))


@query("q08_to_reorder", with_("stock", """
SELECT product_id, product_name, category, units_in_stock, reorder_level,
       units_in_stock - reorder_level AS above_level, snapshot_date_key FROM stock
WHERE needs_reorder AND snapshot_date_key = (SELECT max(snapshot_date_key) FROM stock)"""))
def to_reorder(m):
    keys = m.dim_product().filter("is_current").select("product_id", "product_sk")
    names = m.products().select("product_id", "product_name", "category").join(
        keys, "product_id"
    )
    low = reports.to_reorder(m.fact_stock(), names, "product_sk")
    return low.select(
        "product_id", "product_name", "category", "units_in_stock", "reorder_level",
        "above_level", "snapshot_date_key",
    )


@query("q09_discount_impact", with_("l", f"""
SELECT category, mean_discount_pct, CAST(gross AS DOUBLE) AS gross, CAST(net AS DOUBLE) AS net,
       CAST(lost AS DOUBLE) AS lost, {pct('lost', 'gross')} AS lost_pct,
       ntile(4) OVER (ORDER BY mean_discount_pct, category) AS quartile
FROM (SELECT p.p_type AS category, {sql_mean('l.discount')} * 100 AS mean_discount_pct,
             sum(l.gross) AS gross, sum(l.net) AS net, sum(l.gross - l.net) AS lost
      FROM l JOIN part p ON p.p_partkey = l.product_id GROUP BY p.p_type)"""))
def discount_impact(m):
    return reports.discount_impact(with_product(m, "category"), "category")


@query("q10_orders_by_destination", with_("ful", f"""
SELECT ship_country, count(*) AS orders, count(*) FILTER (WHERE NOT is_late) AS on_time,
       count(*) FILTER (WHERE is_late) AS late, {sql_mean('days_to_ship')} AS mean_lead_time,
       {pct('count(*) FILTER (WHERE NOT is_late)', 'count(shipped_date_key)')} AS on_time_pct
FROM ful GROUP BY ship_country"""))
def orders_by_destination(m):
    return reports.destinations(m.fulfillment(), ["ship_country"])


@query("q11_category_by_year", with_("o l", """
SELECT p.p_type AS category, year(o.order_date) AS order_year, CAST(sum(l.net) AS DOUBLE) AS net
FROM l JOIN o ON o.order_id = l.order_id JOIN part p ON p.p_partkey = l.product_id GROUP BY ALL"""))
def category_by_year(m):
    sales = m.sales("order_date").join(
        m.products().select("product_id", "category"), "product_id"
    )
    return reports.cells(reports.by_year(sales, "category"), "category")


@query("q12_top_product_per_category", with_("l", """
SELECT p.p_type AS category, p.p_partkey AS product_id, p.p_name AS product_name,
       CAST(sum(l.net) AS DOUBLE) AS net FROM l JOIN part p ON p.p_partkey = l.product_id
GROUP BY p.p_type, p.p_partkey, p.p_name
QUALIFY rank() OVER (PARTITION BY p.p_type ORDER BY sum(l.net) DESC) = 1"""))
def top_product_per_category(m):
    totals = m.lines().groupBy("product_id").agg(F.sum("net").alias("net"))
    named = totals.join(
        m.products().select("product_id", "product_name", "category"), "product_id"
    )
    return reports.ranked(named, "net", ["category"], top=1).drop("place")


@query("q13_top_products", with_("l", """
SELECT t.product_id, p.p_name AS product_name, CAST(t.net AS DOUBLE) AS net FROM (
  SELECT product_id, sum(net) AS net FROM l GROUP BY product_id
  ORDER BY sum(net) DESC, product_id LIMIT 5) t JOIN part p ON p.p_partkey = t.product_id"""))
def top_products(m):
    totals = m.lines().groupBy("product_id").agg(F.sum("net").alias("net"))
    best = totals.orderBy(F.desc("net"), "product_id").limit(5)
    return best.join(m.products().select("product_id", "product_name"), "product_id")


@query("q13_top_lines", with_("l", """
SELECT order_id, line_number, product_id, employee_id, CAST(net AS DOUBLE) AS net FROM l
ORDER BY net DESC, order_id, product_id, employee_id, line_number LIMIT 5"""))
def top_lines(m):
    return m.lines().select(*facts.SALES_GRAIN, "net").orderBy(
        F.desc("net"), *facts.SALES_GRAIN
    ).limit(5)


@query("q14_revenue_by_territory", with_("l pairs terr", """
, parts AS (SELECT employee_id, count(*) AS parts FROM pairs GROUP BY employee_id),
  sold AS (SELECT employee_id, sum(net) AS net FROM l GROUP BY employee_id),
  placed AS (SELECT employee_id, territory_id, row_number() OVER (
                 PARTITION BY employee_id ORDER BY """ + sk("territory_id") + """) AS place FROM pairs),
  unit AS (SELECT employee_id, net, CAST(net * 10000 AS BIGINT) AS units FROM sold),
  revenue AS (SELECT p.territory_id, sum(s.net) AS net,
                     sum(s.units // q.parts + CASE WHEN p.place <= s.units % q.parts THEN 1 ELSE 0 END)
                       AS weighted
              FROM unit s JOIN placed p ON p.employee_id = s.employee_id
              JOIN parts q ON q.employee_id = s.employee_id GROUP BY p.territory_id),
  orders AS (SELECT p.territory_id, count(DISTINCT l.order_id) AS orders
             FROM l JOIN pairs p ON p.employee_id = l.employee_id GROUP BY p.territory_id)
SELECT t.region_name, t.territory_name, o.orders, CAST(r.net AS DOUBLE) AS net,
       CAST(r.weighted AS DOUBLE) / 10000 AS weighted_net
FROM revenue r JOIN orders o ON o.territory_id = r.territory_id
JOIN terr t ON t.territory_id = r.territory_id"""))
def revenue_by_territory(m):
    """Plain and weighted; the weighted ones add up to the net of the facts."""
    return reports.territory_revenue(
        keyed_sales(m), bridge.with_weight(m.bridge()), m.dim_territory()
    ).select(
        "region_name", "territory_name", "orders", "net", "weighted_net",
    )


@query("q15_members_by_territories", with_("pairs terr emp", """
SELECT e.full_name, count(*) AS territories,
       string_agg(t.territory_name, ', ' ORDER BY t.territory_name) AS territory_list
FROM pairs p JOIN terr t ON t.territory_id = p.territory_id
JOIN emp e ON e.employee_id = p.employee_id GROUP BY e.employee_id, e.full_name"""))
def members_by_territories(m):
    named = m.member_territories().join(m.dim_territory(), "territory_id")
    per_member = named.groupBy("employee_id").agg(
        F.count("*").alias("territories"),
        dims.ordered_list("territory_name").alias("territory_list"),
    )
    return per_member.join(m.employees().select("employee_id", "full_name"), "employee_id").drop(
        "employee_id"
    )


@query("q16_members_who_never_sold", with_("pairs", """
SELECT p.employee_id, p.territory_id FROM pairs p
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_suppkey = p.employee_id)"""))
def members_who_never_sold(m):
    """Assigned pairs whose member has no sale at all."""
    sold = m.lines().select("employee_id").distinct()
    return m.member_territories().join(sold, "employee_id", "left_anti")


@query("q16_members_without_sales", with_("pairs", """
SELECT p.employee_id, p.territory_id FROM pairs p
WHERE NOT EXISTS (SELECT 1 FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
                  WHERE l.l_suppkey = p.employee_id AND o.o_orderdate =
                        (SELECT max(o_orderdate) FROM orders))"""))
def members_without_sales(m):
    """Assigned pairs whose member sold nothing on the last day of business."""
    last = m.orders().agg(F.max("order_date")).scalar()
    orders = m.orders().filter(F.col("order_date") == last).select("order_id")
    sold = m.lines().join(orders, "order_id").select("employee_id")
    return m.member_territories().join(sold, "employee_id", "left_anti")


IDLE = """
, months AS (SELECT count(DISTINCT date_trunc('month', activity_date)) AS n FROM act)"""


@query("q16_idle_members", with_("act pairs", IDLE + """
SELECT p.employee_id, p.territory_id, m.n - coalesce(a.active, 0) AS idle_months
FROM pairs p CROSS JOIN months m
LEFT JOIN (SELECT employee_id, count(DISTINCT date_trunc('month', activity_date)) AS active
           FROM act GROUP BY employee_id) a ON a.employee_id = p.employee_id
WHERE m.n - coalesce(a.active, 0) > 0"""))
def idle_members(m):
    """Assigned pairs and the months in which their member sold nothing."""
    events = m.activity_events()
    month = F.trunc("activity_date", "month")
    return reports.idle_months(
        m.member_territories(), events, ["employee_id"], month,
        events.agg(F.count_distinct(month)).scalar(),
    )


@query("q17_revenue_by_flags", with_("o l", FLAGGED + """
SELECT discount_band, ship_mode, count(*) AS lines, CAST(sum(gross) AS DOUBLE) AS gross,
       CAST(sum(net) AS DOUBLE) AS net, CAST(sum(gross - net) AS DOUBLE) AS discount_total
FROM flagged GROUP BY discount_band, ship_mode"""))
def revenue_by_flags(m):
    """Totals per flag key first, so the flag texts are joined to a few rows."""
    flags = m.flags()
    keyed = junk.assign_flags(m.sales("ship_via"), flags)
    totals = keyed.groupBy("order_flags_sk").agg(
        F.count("*").alias("lines"), F.sum("gross").alias("gross"), F.sum("net").alias("net")
    )
    return totals.join(F.broadcast(flags), "order_flags_sk").groupBy(
        "discount_band", "ship_mode"
    ).agg(
        F.sum("lines").alias("lines"), F.sum("gross").alias("gross"), F.sum("net").alias("net"),
        F.sum(F.col("gross") - F.col("net")).alias("discount_total"),
    )


@query("q18_mean_line_by_flags", with_("o l", FLAGGED + f"""
SELECT ship_mode, is_high_value, count(*) AS lines, {sql_mean('net')} AS mean_line
FROM flagged GROUP BY ship_mode, is_high_value"""))
def mean_line_by_flags(m):
    return junk.with_flags(m.sales("ship_via")).groupBy("ship_mode", "is_high_value").agg(
        F.count("*").alias("lines"), mean(F.col("net")).alias("mean_line")
    )


@query("q19_customers_that_moved", f"""
SELECT customer_id, previous_priority, current_priority, priority_changed_on
FROM ({SCD3_SQL})
WHERE previous_priority IS NOT NULL""")
def customers_that_moved(m):
    return m.dim_customer_scd3().filter(F.col("previous_priority").isNotNull()).select(
        "customer_id", "previous_priority", "current_priority", "priority_changed_on"
    ).orderBy(F.desc("priority_changed_on"), "customer_id")


@query("q20_territories_covered", with_("act", """
SELECT count(DISTINCT territory_id) AS covered, (SELECT count(*) FROM nation) AS total FROM act"""))
def territories_covered(m):
    return m.activity_events().agg(F.count_distinct("territory_id").alias("covered")).withColumn(
        "total", m.territories().agg(F.count("*")).scalar()
    )


@query("q21_coverage_by_region", with_("act terr", """
SELECT year(a.activity_date) AS activity_year, t.region_name,
       count(DISTINCT a.territory_id) AS territories, count(DISTINCT a.employee_id) AS members,
       count(*) AS events
FROM act a JOIN terr t ON t.territory_id = a.territory_id GROUP BY ALL"""))
def coverage_by_region(m):
    """Events are counted per year, territory and member first; the distinct
    counts then read those totals."""
    year = F.year("activity_date").alias("activity_year")
    seen = m.activity_events().distinct().groupBy(year, "territory_id", "employee_id").agg(
        F.count("*").alias("n")
    )
    places = m.dim_territory().select("territory_id", "region_name")
    return seen.join(places, "territory_id").groupBy("activity_year", "region_name").agg(
        F.count_distinct("territory_id").alias("territories"),
        F.count_distinct("employee_id").alias("members"),
        F.sum("n").alias("events"),
    )


@query("q22_pairs_never_active", with_("act pairs", """
SELECT p.employee_id, p.territory_id FROM pairs p
WHERE NOT EXISTS (SELECT 1 FROM act a WHERE a.employee_id = p.employee_id
                  AND a.territory_id = p.territory_id)"""))
def pairs_never_active(m):
    """Assigned pairs without any activity in all facts."""
    active = m.activity_events().select("employee_id", "territory_id").distinct()
    return bridge.never_active(m.member_territories(), active, ["employee_id", "territory_id"])


@query("q22_pairs_without_activity", with_("act pairs", """
SELECT p.employee_id, p.territory_id FROM pairs p
WHERE NOT EXISTS (SELECT 1 FROM act a WHERE a.employee_id = p.employee_id
                  AND a.territory_id = p.territory_id
                  AND date_trunc('month', a.activity_date) =
                      (SELECT date_trunc('month', max(activity_date)) FROM act))"""))
def pairs_without_activity(m):
    """What did not happen in the last month of the facts."""
    events = m.activity_events()
    last = events.agg(F.max(F.trunc("activity_date", "month"))).scalar()
    active = events.filter(F.trunc("activity_date", "month") == last)
    return bridge.never_active(
        m.member_territories(), active, ["employee_id", "territory_id"]
    )


@query("q22_idle_pairs", with_("act pairs", IDLE + """
SELECT p.employee_id, p.territory_id, m.n - coalesce(a.active, 0) AS idle_months
FROM pairs p CROSS JOIN months m
LEFT JOIN (SELECT employee_id, territory_id,
                  count(DISTINCT date_trunc('month', activity_date)) AS active
           FROM act GROUP BY ALL) a
  ON a.employee_id = p.employee_id AND a.territory_id = p.territory_id
WHERE m.n - coalesce(a.active, 0) > 0"""))
def idle_pairs(m):
    events = m.activity_events()
    month = F.trunc("activity_date", "month")
    return reports.idle_months(
        m.member_territories(), events, ["employee_id", "territory_id"], month,
        events.agg(F.count_distinct(month)).scalar(),
    )


@query("q23_active_days", with_("act emp terr", """
SELECT e.full_name, t.territory_name, count(*) AS active_days
FROM act a JOIN emp e ON e.employee_id = a.employee_id
JOIN terr t ON t.territory_id = a.territory_id GROUP BY ALL"""))
def active_days(m):
    days = m.activity_events().distinct().groupBy("employee_id", "territory_id").agg(
        F.count("*").alias("active_days")
    )
    return (
        days.join(m.employees().select("employee_id", "full_name"), "employee_id")
        .join(m.dim_territory().select("territory_id", "territory_name"), "territory_id")
        .select("full_name", "territory_name", "active_days")
    )


def in_roles(m):
    """Orders with the calendar in its three roles; a calendar is small by nature."""
    orders, dates = m.fulfillment(), m.dim_date()
    for role, how in [("order", "inner"), ("required", "left"), ("shipped", "left")]:
        one = dims.as_role(
            dates.select("date_key", "year", "quarter", "month", "month_name"), role
        ).withColumnRenamed(f"{role}_date_key", f"_{role}")
        orders = orders.join(
            F.broadcast(one), F.col(f"{role}_date_key") == F.col(f"_{role}"), how
        )
    return orders


@query("q24_orders_by_quarter", with_("ful", f"""
SELECT year(order_date) AS order_year, quarter(order_date) AS order_quarter, count(*) AS orders,
       count(shipped_date_key) AS shipped, count(*) FILTER (WHERE shipped_date_key IS NULL)
         AS pending, {sql_mean('days_to_ship')} AS mean_days,
       count(*) FILTER (WHERE is_late) AS late FROM ful GROUP BY ALL"""))
def orders_by_quarter(m):
    done = F.col("shipped_date_key")
    return in_roles(m).groupBy("order_year", "order_quarter").agg(
        F.count("*").alias("orders"), F.count(done).alias("shipped"),
        F.count_if(done.isNull()).alias("pending"), mean(F.col("days_to_ship")).alias("mean_days"),
        F.count_if("is_late").alias("late"),
    )


@query("q25_order_month_by_ship_month", with_("ful", f"""
SELECT month(order_date) AS order_month, monthname(order_date) AS order_month_name,
       month(shipped_date) AS shipped_month, monthname(shipped_date) AS shipped_month_name,
       count(*) AS orders, {sql_mean('days_to_ship')} AS mean_days
FROM ful WHERE shipped_date IS NOT NULL GROUP BY ALL"""))
def order_month_by_ship_month(m):
    shipped = in_roles(m).filter(F.col("shipped_month").isNotNull())
    return shipped.groupBy(
        "order_month", "order_month_name", "shipped_month", "shipped_month_name"
    ).agg(F.count("*").alias("orders"), mean(F.col("days_to_ship")).alias("mean_days"))


@query("q26_order_drill_through", f"""
SELECT f.order_id, c.c_name AS customer_name, p.p_name AS product_name, f.quantity,
       f.unit_price, f.discount, f.net
FROM ({SALES}) f JOIN orders o ON o.o_orderkey = f.order_id
JOIN customer c ON c.c_custkey = o.o_custkey JOIN part p ON p.p_partkey = f.product_id""")
def order_drill_through(m):
    """The lines of every order with the names of the versions that were sold.

    Joined on the version keys alone: old versions stay in the result.
    """
    customers = m.dim_customer().join(
        m.customers().select("customer_id", "customer_name"), "customer_id"
    ).select("customer_sk", "customer_name")
    products = m.dim_product().join(
        m.products().select("product_id", "product_name"), "product_id"
    ).select("product_sk", "product_name")
    return m.fact_sales().join(customers, "customer_sk").join(products, "product_sk").select(
        "order_id", "customer_name", "product_name", "quantity", "unit_price", "discount", "net"
    )


@query("q27_orders_of_customer", with_("o l", """
SELECT o.customer_id, o.order_id, CAST(min(o.order_date) AS VARCHAR) AS ordered_on,
       CAST(sum(l.net) AS DOUBLE) AS net, count(*) AS lines
FROM l JOIN o ON o.order_id = l.order_id GROUP BY o.customer_id, o.order_id"""))
def orders_of_customer(m):
    per_order = m.lines().groupBy("order_id").agg(
        F.sum("net").alias("net"), F.count("*").alias("lines")
    )
    return m.orders().join(per_order, "order_id").select(
        "customer_id", "order_id", F.col("order_date").alias("ordered_on"), "net", "lines"
    )


@query("q28_lead_time_summary", with_("ful", f"""
SELECT count(*) AS orders, count(*) FILTER (WHERE shipped_date_key IS NULL) AS pending,
       count(*) FILTER (WHERE is_late) AS late, {sql_mean('days_to_ship')} AS mean_days,
       min(days_to_ship) AS least, max(days_to_ship) AS most FROM ful"""))
def lead_time_summary(m):
    return reports.lead_times(m.fulfillment())


@query("q29_pending_orders", with_("ful", """
SELECT order_id, order_date_key, required_date_key FROM ful WHERE shipped_date_key IS NULL"""))
def pending_orders(m):
    return m.fulfillment().filter(F.col("shipped_date_key").isNull()).select(
        "order_id", "order_date_key", "required_date_key"
    ).orderBy("order_id")


@query("q30_version_history", with_("cust_loads", """
SELECT customer_id, row_number() OVER (PARTITION BY customer_id ORDER BY valid_from) AS nth,
       priority, status, CAST(valid_from AS VARCHAR) AS valid_from,
       CAST(valid_to AS VARCHAR) AS valid_to, is_current FROM cust_loads"""))
def version_history(m):
    """All versions of each customer in order; a customer has one per day at most."""
    w = Window.partitionBy("customer_id").orderBy("valid_from")
    return m.dim_customer_loads().select(
        "customer_id", F.row_number().over(w).alias("nth"), "priority", "status", "valid_from",
        "valid_to", "is_current",
    )


@query("q31_version_summary", with_("cust_loads", """
SELECT count(*) AS versions, count(*) FILTER (WHERE is_current) AS current_versions,
       count(*) FILTER (WHERE NOT is_current) AS past_versions,
       CAST(min(valid_from) AS VARCHAR) AS first_from, CAST(max(valid_to) AS VARCHAR) AS last_to
FROM cust_loads"""))
def version_summary(m):
    return m.dim_customer_loads().agg(
        F.count("*").alias("versions"), F.count_if("is_current").alias("current_versions"),
        F.count_if(~F.col("is_current")).alias("past_versions"),
        F.min("valid_from").alias("first_from"), F.max("valid_to").alias("last_to"),
    )


LATE_RATE = f"""{sql_mean('days_to_ship')} AS mean_days,
       {sql_mean('CASE WHEN is_late THEN 1 WHEN NOT is_late THEN 0 END')} AS late_rate"""


def late_rate(orders, by):
    return orders.groupBy(*by).agg(
        mean(F.col("days_to_ship")).alias("mean_days"),
        mean(F.col("is_late").cast("int")).alias("late_rate"),
    )


@query("q32_late_rate_by_shipper_and_country", with_("ful", f"""
SELECT ship_via, ship_country, {LATE_RATE} FROM ful GROUP BY ALL"""))
def late_rate_by_shipper_and_country(m):
    return late_rate(m.fulfillment(), ["ship_via", "ship_country"])


@query("q32_lead_time_by_member", with_("ful l", f"""
SELECT s.employee_id, {LATE_RATE} FROM ful f
JOIN (SELECT DISTINCT order_id, employee_id FROM l) s ON s.order_id = f.order_id
GROUP BY s.employee_id"""))
def lead_time_by_member(m):
    taken = m.lines().select("order_id", "employee_id").distinct()
    orders = m.fulfillment().select("order_id", "days_to_ship", "is_late")
    return late_rate(taken.join(orders, "order_id"), ["employee_id"])


@query("q33_filter_by_date_role", with_("ful", """
SELECT 'ordered' AS role, year(order_date) AS year, count(*) AS orders FROM ful GROUP BY ALL
UNION ALL
SELECT 'shipped', year(shipped_date), count(*) FROM ful WHERE shipped_date IS NOT NULL GROUP BY ALL"""))
def filter_by_date_role(m):
    """Orders per year by the day ordered and by the day shipped."""
    orders = in_roles(m)

    def one(role, column):
        return orders.filter(F.col(column).isNotNull()).groupBy(
            F.lit(role).alias("role"), F.col(column).alias("year")
        ).agg(F.count("*").alias("orders"))

    return one("ordered", "order_year").unionByName(one("shipped", "shipped_year"))
