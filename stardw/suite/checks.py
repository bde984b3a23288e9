"""Integrity checks (V), each compared with its own count in SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stardw.functions import net_amount, surrogate_key
from stardw.operators import asof, dims, facts, quality

from .dimensions import FLAGGED
from .joins import SCD3_SQL
from .registry import query
from .sql import with_


def verdict(name: str, value: str, expected: str = "0") -> str:
    """SQL of one check row; `value` and `expected` are scalar queries or numbers."""
    return f"""
SELECT '{name}' AS "check", CASE WHEN value = expected THEN 'PASS' ELSE 'FAIL' END AS status,
       value, expected
FROM (SELECT CAST(({value}) AS DOUBLE) AS value, CAST(({expected}) AS DOUBLE) AS expected)"""


@query("v01_expected_count", verdict(
    "territories", "SELECT count(*) FROM nation", "25") + "\nUNION ALL" + verdict(
    "pending orders", "SELECT count(*) FROM orders o WHERE o_orderstatus <> 'F' OR NOT EXISTS "
    "(SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
    "SELECT count(*) FROM orders o WHERE o_orderstatus <> 'F' OR NOT EXISTS "
    "(SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"))
def expected_count(m):
    pending = m.fulfillment().filter(F.col("shipped_date_key").isNull())
    open_orders = m.orders().filter(F.col("status") != "F")
    no_lines = m.orders().filter(F.col("status") == "F").join(
        m.lines(), "order_id", "left_anti"
    )
    wanted = open_orders.agg(F.count("*")).scalar() + no_lines.agg(F.count("*")).scalar()
    return quality.expect_count("territories", m.territories(), 25).unionByName(
        quality.expect_count("pending orders", pending, wanted)
    )


@query("v02_layer_counts", """
SELECT t AS "table", n AS source_rows, n AS target_rows, true AS ok FROM (
  SELECT 'orders' AS t, count(*) AS n FROM orders UNION ALL
  SELECT 'lines', count(*) FROM lineitem UNION ALL
  SELECT 'members', count(*) FROM supplier UNION ALL
  SELECT 'territories', count(*) FROM nation)""")
def layer_counts(m):
    return quality.reconcile_counts({
        "orders": (m.given("orders"), m.fact_fulfillment()),
        "lines": (m.given("lineitem"), m.fact_sales()),
        "members": (m.given("supplier"), m.dim_employee()),
        "territories": (m.given("nation"), m.dim_territory()),
    })


@query("v02_layer_content", with_("o l", """
SELECT year(o.order_date) AS order_year, count(*) AS source_rows, count(*) AS target_rows,
       year(o.order_date) <> (SELECT year(order_date) FROM o WHERE order_id = (SELECT min(order_id) FROM l)) AS ok
FROM l JOIN o ON o.order_id = l.order_id GROUP BY ALL"""))
def layer_content(m):
    """The fact against the lines by value, with one order's quantity changed: counts agree, its year does not."""
    columns = [*facts.SALES_GRAIN, "quantity", "discount", "gross", "net"]
    lines = m.sales("order_date").withColumn("order_year", F.year("order_date"))
    fact = m.fact_sales().withColumn("order_year", F.floor(F.col("order_date_key") / 10000).cast("int"))
    first = fact.agg(F.min("order_id")).scalar()
    spoiled = fact.withColumn(
        "quantity", F.when(F.col("order_id") == first, F.col("quantity") + 1).otherwise(F.col("quantity")))
    return quality.reconcile_content(lines, spoiled, columns, "order_year")


@query("v03_unique_grain", verdict(
    "order grain", "SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY ALL HAVING count(*) > 1)"
) + "\nUNION ALL" + verdict(
    "line number within order", "SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem "
    "GROUP BY ALL HAVING count(*) > 1)"
) + "\nUNION ALL" + verdict(
    "line grain", "SELECT count(*) FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber "
    "FROM lineitem GROUP BY ALL HAVING count(*) > 1)"
) + "\nUNION ALL" + verdict(
    "stock grain", "SELECT count(*) FROM (" + with_("levels", "SELECT product_id, snapshot_day "
    "FROM levels GROUP BY ALL HAVING count(*) > 1") + ")") + "\nUNION ALL" + verdict(
    "activity grain", "SELECT count(*) FROM (" + with_("act", "SELECT activity_date, employee_id, "
    "territory_id FROM act GROUP BY ALL HAVING count(*) > 1") + ")"))
def unique_grain(m):
    return (
        quality.expect_unique("order grain", m.fulfillment(), ["order_id"])
        .unionByName(quality.expect_unique(
            "line number within order", m.lines(), ["order_id", "line_number"]))
        .unionByName(quality.expect_unique("line grain", m.lines(), facts.SALES_GRAIN))
        .unionByName(quality.expect_unique(
            "stock grain", m.stock_levels(), ["product_id", "snapshot_day"]))
        .unionByName(quality.expect_unique(
            "activity grain", m.fact_activity(),
            ["activity_date_key", "employee_sk", "territory_sk"]))
    )


@query("v04_one_current_version", with_("cust_loads prod", verdict(
    "customer versions", "SELECT count(*) FROM (SELECT customer_id FROM cust_loads WHERE is_current "
    "GROUP BY ALL HAVING count(*) > 1)") + "\nUNION ALL" + verdict(
    "product versions", "SELECT count(*) FROM (SELECT product_id FROM prod WHERE is_current "
    "GROUP BY ALL HAVING count(*) > 1)")))
def one_current_version(m):
    return quality.expect_one_current(
        "customer versions", m.dim_customer_loads(), "customer_id"
    ).unionByName(quality.expect_one_current("product versions", m.dim_product(), "product_id"))


@query("v05_no_version_gaps", with_("cust_loads cust", verdict(
    "loads", "SELECT count(*) FROM (SELECT valid_to, lead(valid_from) OVER (PARTITION BY customer_id "
    "ORDER BY valid_from) AS n, valid_from FROM cust_loads) WHERE valid_to + 1 <> n OR valid_from > valid_to"
) + "\nUNION ALL" + verdict(
    "history", "SELECT count(*) FROM (SELECT valid_to, lead(valid_from) OVER (PARTITION BY customer_id "
    "ORDER BY valid_from) AS n, valid_from FROM cust) WHERE valid_to + 1 <> n OR valid_from > valid_to")))
def no_version_gaps(m):
    return quality.expect_none(
        "loads", quality.version_gaps(m.dim_customer_loads(), "customer_id")
    ).unionByName(
        quality.expect_none("history", quality.version_gaps(m.dim_customer(), "customer_id"))
    )


@query("v06_referential_integrity", with_("cust_loads shipper", verdict(
    "line to order", "SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN "
    "(SELECT o_orderkey FROM orders)") + "\nUNION ALL" + verdict(
    "line to product", "SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_partkey NOT IN "
    "(SELECT p_partkey FROM part)") + "\nUNION ALL" + verdict(
    "line to member", "SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_suppkey NOT IN "
    "(SELECT s_suppkey FROM supplier)") + "\nUNION ALL" + verdict(
    "order to loaded customer", "SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN "
    "(SELECT customer_id FROM cust_loads)") + "\nUNION ALL" + verdict(
    "order to shipper", "SELECT count(DISTINCT ship_via) FROM o WHERE ship_via NOT IN "
    "(SELECT shipper_id FROM shipper)") + "\nUNION ALL" + verdict(
    "order to date", "SELECT count(DISTINCT order_date) FROM o, (SELECT min(year(order_date)) AS a, "
    "max(year(order_date)) + 1 AS b FROM o) WHERE year(order_date) < a OR year(order_date) > b")))
def referential_integrity(m):
    lines, orders = m.lines(), m.orders()
    dated = m.fulfillment()
    checks = [
        quality.expect_fk("line to order", lines, orders, "order_id"),
        quality.expect_fk("line to product", lines, m.products(), "product_id"),
        quality.expect_fk("line to member", lines, m.employees(), "employee_id"),
        quality.expect_fk(
            "order to loaded customer", orders, m.dim_customer_loads(), "customer_id"),
        quality.expect_fk("order to shipper", orders, m.dim_shipper(), "ship_via", "shipper_id"),
        quality.expect_fk("order to date", dated, m.dim_date(), "order_date_key", "date_key"),
    ]
    return quality.run_checks(checks).drop("no")


@query("v07_date_coverage", verdict(
    "order dates", "SELECT CAST(a > low AS INTEGER) + CAST(b < high AS INTEGER) FROM (SELECT "
    "make_date(min(year(o_orderdate)), 1, 1) AS a, make_date(max(year(o_orderdate)) + 1, 12, 31) AS b, "
    "min(CAST(o_orderdate AS DATE)) AS low, max(CAST(o_orderdate AS DATE)) AS high FROM orders)"
) + "\nUNION ALL" + verdict(
    "dates of years with orders only",
    "SELECT CASE WHEN year(max(l_shipdate)) > year(max(o_orderdate)) THEN 1 ELSE 0 END "
    "FROM lineitem, (SELECT max(o_orderdate) AS o_orderdate FROM orders)"))
def date_coverage(m):
    """The calendar covers the orders; does it need its extra year for shipments?"""
    dates = m.dim_date()
    last = m.orders().agg(F.max(F.year("order_date"))).scalar()
    shipped = m.lines().select(
        (F.year("ship_date") * 10000 + F.month("ship_date") * 100 + F.dayofmonth("ship_date"))
        .alias("ship_date_key")
    )
    return quality.expect_date_cover(
        "order dates", m.fulfillment(), "order_date_key", dates
    ).unionByName(quality.expect_date_cover(
        "dates of years with orders only", shipped, "ship_date_key",
        dates.filter(F.col("year") <= last),
    ))


@query("v08_measure_bound", with_("l", verdict(
    "net up to gross", "SELECT count(*) FROM l WHERE NOT net <= gross + 0.01") + "\nUNION ALL" + verdict(
    "net below 90000", "SELECT count(*) FROM l WHERE NOT net < 90000")))
def measure_bound(m):
    return quality.expect_rows(
        "net up to gross", m.lines(), F.col("net") <= F.col("gross") + F.lit(0.01)
    ).unionByName(quality.expect_rows("net below 90000", m.lines(), F.col("net") < 90000))


@query("v09_revenue_total", with_("l", """
SELECT 'net revenue' AS "check", CASE WHEN abs(value - expected) <= 0.01 THEN 'PASS' ELSE 'FAIL' END
         AS status, value, expected
FROM (SELECT (SELECT CAST(sum(net) AS DOUBLE) FROM l) AS value,
             (SELECT CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2))
                * (1 - CAST(l_discount AS DECIMAL(5,4))) AS DECIMAL(18,4))) AS DOUBLE)
              FROM lineitem) AS expected)"""))
def revenue_total(m):
    """The fact against the raw lines, computed anew."""
    gross = F.col("l_extendedprice").cast("decimal(18,2)")
    rate = F.col("l_discount").cast("decimal(5,4)")
    raw = m.given("lineitem").select(net_amount(gross, rate).alias("net"))
    return quality.expect_close("net revenue", m.fact_sales(), "net", raw, "net", 0.01)


@query("v10_derived_flags", with_("ful stock", verdict(
    "late flag", "SELECT count(*) FROM ful WHERE is_late IS DISTINCT FROM (shipped_date_key > required_date_key)"
) + "\nUNION ALL" + verdict(
    "reorder flag", "SELECT count(*) FROM stock WHERE needs_reorder <> (units_in_stock <= reorder_level)")))
def derived_flags(m):
    late = F.col("is_late").eqNullSafe(F.col("shipped_date_key") > F.col("required_date_key"))
    reorder = F.col("needs_reorder") == (F.col("units_in_stock") <= F.col("reorder_level"))
    return quality.expect_rows("late flag", m.fulfillment(), late).unionByName(
        quality.expect_rows("reorder flag", m.fact_stock(), reorder)
    )


@query("v11_hierarchy_top", with_("emp", """
SELECT employee_id, full_name, reports_to FROM emp WHERE manager_name IS NULL"""))
def hierarchy_top(m):
    return m.dim_employee().filter(F.col("manager_name").isNull()).select(
        "employee_id", "full_name", "reports_to"
    )


@query("v12_bridge_complete", with_("pairs", verdict("bridge complete", """
SELECT count(*) FROM (SELECT s_suppkey, n.n_nationkey FROM supplier, nation n, region, nation h
  WHERE n.n_regionkey = r_regionkey AND h.n_regionkey = r_regionkey AND h.n_nationkey = s_nationkey
  EXCEPT SELECT employee_id, territory_id FROM pairs)""")
    + "\nUNION ALL" + verdict("home territories only", """
SELECT count(*) FROM pairs p JOIN supplier s ON s.s_suppkey = p.employee_id
WHERE p.territory_id <> s.s_nationkey""")))
def bridge_complete(m):
    """Against the whole bridge, and against one that has only the home territories."""
    keys = ["employee_sk", "territory_sk"]
    source = m.member_territories().select(
        surrogate_key("employee_id").alias("employee_sk"),
        surrogate_key("territory_id").alias("territory_sk"),
    )
    home = m.employees().select(
        surrogate_key("employee_id").alias("employee_sk"),
        surrogate_key("territory_id").alias("territory_sk"),
    )
    return quality.expect_none(
        "bridge complete", source.join(m.bridge(), keys, "left_anti")
    ).unionByName(
        quality.expect_none("home territories only", source.join(home, keys, "left_anti"))
    )


DOMAINS = """(VALUES ('None'), ('Low'), ('Medium'), ('High')) b(discount_band),
  (VALUES (false), (true)) h(is_high_value), (VALUES ('Express'), ('Standard'), ('Economy')) s(ship_mode)"""


@query("v13_flags_filled", with_("o l", FLAGGED + verdict("flag keys filled", f"""
SELECT count(*) FROM flagged f WHERE NOT EXISTS (SELECT 1 FROM {DOMAINS}
  WHERE b.discount_band = f.discount_band AND h.is_high_value = f.is_high_value
    AND s.ship_mode = f.ship_mode)""") + "\nUNION ALL"
    + verdict("flag combinations", f"SELECT count(*) FROM {DOMAINS}", "24")))
def flags_filled(m):
    return quality.expect_rows(
        "flag keys filled", m.fact_sales(), F.col("order_flags_sk").isNotNull()
    ).unionByName(quality.expect_count("flag combinations", m.flags(), 24))


@query("v14_current_equals_source", with_("loads", verdict(
    "after the last load", f"""SELECT count(*) FROM ({SCD3_SQL}) t JOIN loads a
    ON a.customer_id = t.customer_id AND a.load_date = :last_load
    WHERE a.priority IS DISTINCT FROM t.current_priority""") + "\nUNION ALL" + verdict(
    "against the first load", f"""SELECT count(*) FROM ({SCD3_SQL}) t JOIN loads a
    ON a.customer_id = t.customer_id AND a.load_date = :first_load
    WHERE a.priority IS DISTINCT FROM t.current_priority""")))
def current_equals_source(m):
    dim = m.dim_customer_scd3()
    return quality.expect_equal_values(
        "after the last load", dim, m.customer_snapshot(m.load_dates()[-1]), "customer_id",
        {"current_priority": "priority"},
    ).unionByName(quality.expect_equal_values(
        "against the first load", dim, m.customer_snapshot(m.load_dates()[0]), "customer_id",
        {"current_priority": "priority"},
    ))


@query("v15_roles_equal_base", """
SELECT role AS "table", n AS source_rows, n AS target_rows, true AS ok FROM (
  SELECT count(*) AS n FROM (SELECT make_date(min(year(o_orderdate)), 1, 1) AS a,
    make_date(max(year(o_orderdate)) + 1, 12, 31) AS b FROM orders) e,
    generate_series(e.a, e.b, INTERVAL 1 DAY)), (VALUES ('order'), ('required'), ('shipped')) r(role)""")
def roles_equal_base(m):
    dates = m.dim_date()
    return quality.reconcile_counts(
        {r: (dates, dims.as_role(dates, r)) for r in ("order", "required", "shipped")}
    )


@query("v16_orphans_by_build", with_("o l cust_loads cust prod", verdict(
    "sale days without a version", "SELECT count(*) FROM o WHERE NOT EXISTS (SELECT 1 FROM cust_loads v "
    "WHERE v.customer_id = o.customer_id AND o.order_date >= v.valid_from "
    "AND o.order_date <= v.valid_to)") + "\nUNION ALL" + verdict(
    "sale days without a version, from history", "SELECT count(*) FROM o WHERE NOT EXISTS (SELECT 1 "
    "FROM cust v WHERE v.customer_id = o.customer_id AND o.order_date >= v.valid_from "
    "AND o.order_date <= v.valid_to)") + "\nUNION ALL" + verdict(
    "lines without a product version", "SELECT count(*) FROM l JOIN o ON o.order_id = l.order_id "
    "WHERE NOT EXISTS (SELECT 1 FROM prod v WHERE v.product_id = l.product_id "
    "AND o.order_date >= v.valid_from AND o.order_date <= v.valid_to)")))
def orphans_by_build(m):
    orders = m.orders()
    return quality.expect_cover(
        "sale days without a version", orders, m.dim_customer_loads(), "customer_id",
        "order_date",
    ).unionByName(quality.expect_cover(
        "sale days without a version, from history", orders, m.dim_customer(), "customer_id",
        "order_date",
    )).unionByName(quality.expect_cover(
        "lines without a product version", m.sales("order_date"), m.dim_product(), "product_id",
        "order_date",
    ))


@query("v18_negative_duration", with_("ful", verdict(
    "days to ship", "SELECT count(*) FROM ful WHERE days_to_ship < 0")))
def negative_duration(m):
    """Reported, not repaired: the given data ships many lines before the order."""
    return quality.expect_rows("days to ship", m.fulfillment(), F.col("days_to_ship") >= 0)


def report(m):
    """The versions and the orders are built once; each row test is a count of its own."""
    lines, orders = m.lines(), m.written(m.fulfillment())
    versions = m.written(m.dim_customer_loads())
    return quality.run_checks([
        quality.expect_unique("order grain", orders, ["order_id"]),
        quality.expect_unique("line grain", lines, facts.SALES_GRAIN),
        quality.expect_one_current("one current version", versions, "customer_id"),
        quality.expect_none("version gaps", quality.version_gaps(versions, "customer_id")),
        quality.expect_fk("line to product", lines, m.products(), "product_id"),
        quality.expect_none("orders without a version", asof.unmatched(
            m.orders(), versions, "customer_id", "order_date")),
        quality.expect_rows("net up to gross", lines, F.col("net") <= F.col("gross")),
        quality.expect_rows("days to ship", orders, F.col("days_to_ship") >= 0),
    ])


REPORT_SQL = """
, v(no, name, value) AS (
  SELECT 1, 'order grain', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
  UNION ALL SELECT 3, 'one current version', count(*) FROM (SELECT 1 FROM cust_loads WHERE is_current
    GROUP BY customer_id HAVING count(*) > 1)
  UNION ALL SELECT 4, 'version gaps', count(*) FROM (SELECT valid_from, valid_to, lead(valid_from) OVER (
      PARTITION BY customer_id ORDER BY valid_from) AS n FROM cust_loads)
    WHERE valid_to + 1 <> n OR valid_from > valid_to
  UNION ALL SELECT 5, 'line to product', count(DISTINCT l_partkey) FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
  UNION ALL SELECT 7, 'net up to gross', count(*) FROM l WHERE NOT net <= gross
  UNION ALL SELECT 2, 'line grain', count(*) FROM (SELECT 1 FROM lineitem
    GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber HAVING count(*) > 1)
  UNION ALL SELECT 6, 'orders without a version', count(*) FROM o WHERE NOT EXISTS (
    SELECT 1 FROM cust_loads v WHERE v.customer_id = o.customer_id
       AND o.order_date >= v.valid_from AND o.order_date <= v.valid_to)
  UNION ALL SELECT 8, 'days to ship', count(*) FROM ful WHERE days_to_ship < 0),
r AS (SELECT no, name AS "check", CASE WHEN value = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
             CAST(value AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS expected FROM v)"""


@query("v17_check_report", with_("o l ful cust_loads", REPORT_SQL + "\nSELECT * FROM r"))
def check_report(m):
    return report(m)


@query("v17_one_pass_report", with_("o l ful cust_loads", REPORT_SQL + "\nSELECT * FROM r"))
def one_pass_report(m):
    """The same report from one pass over each table: versions know their successor, orders their version."""
    versions = m.written(m.dim_customer_loads())
    following = F.lead("valid_from").over(Window.partitionBy("customer_id").orderBy("valid_from", "valid_to"))
    closed = F.col("next_from").isNull() | (F.date_add("valid_to", 1) == F.col("next_from"))
    placed = asof.as_of_join(
        m.fulfillment(), versions, "customer_id", "order_date", ["customer_sk"], how="left")
    return quality.check_tables(
        {
            "orders": placed, "lines": m.lines(), "products": m.products(),
            "versions": versions.withColumn("next_from", following),
        },
        [
            quality.unique("order grain", "orders", ["order_id"]),
            quality.unique("line grain", "lines", facts.SALES_GRAIN),
            quality.unique("one current version", "versions", ["customer_id"], F.col("is_current")),
            quality.holds("version gaps", "versions", closed & (F.col("valid_from") <= F.col("valid_to"))),
            quality.refers("line to product", "lines", ["product_id"], "products", ["product_id"]),
            quality.holds("orders without a version", "orders", F.col("customer_sk").isNotNull()),
            quality.holds("net up to gross", "lines", F.col("net") <= F.col("gross")),
            quality.holds("days to ship", "orders", F.col("days_to_ship") >= 0),
        ],
    )


@query("v17_check_summary", with_("o l ful cust_loads", REPORT_SQL + """
SELECT count(*) AS checks, count(*) FILTER (WHERE status = 'PASS') AS passed,
       count(*) FILTER (WHERE status = 'FAIL') AS failed FROM r"""))
def check_summary(m):
    return quality.summary(report(m))
