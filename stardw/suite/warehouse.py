"""Facts and the ordered load."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from stardw import sources
from stardw.functions import date_key
from stardw.operators import facts, merge, scd
from stardw.plans import load
from stardw.session import work_folder

from .dimensions import FLAG_SK, FLAGGED
from .histories import type_1_loads
from .registry import query
from .sql import fk, sk, with_

SALES = with_("o l cust prod", FLAGGED + f"""
SELECT {fk('f.order_id', 'f.product_id', 'f.employee_id', 'f.line_number')} AS sales_sk,
       f.order_id, f.product_id, f.employee_id, f.line_number,
       CAST(strftime(o.order_date, '%Y%m%d') AS INTEGER) AS order_date_key,
       {sk('c.customer_id', 'c.valid_from')} AS customer_sk,
       {sk('p.product_id', 'p.valid_from')} AS product_sk,
       {sk('f.employee_id')} AS employee_sk, {sk('o.ship_via')} AS shipper_sk,
       {FLAG_SK} AS order_flags_sk, CAST(f.unit_price AS DOUBLE) AS unit_price, f.quantity,
       CAST(f.discount AS DOUBLE) AS discount, CAST(f.gross AS DOUBLE) AS gross,
       CAST(f.net AS DOUBLE) AS net
FROM flagged f JOIN o ON o.order_id = f.order_id
JOIN cust c ON c.customer_id = o.customer_id
 AND o.order_date >= c.valid_from AND o.order_date <= c.valid_to
JOIN prod p ON p.product_id = f.product_id
 AND o.order_date >= p.valid_from AND o.order_date <= p.valid_to""")


@query("p21_sales_fact", SALES)
def sales_fact(m):
    return m.fact_sales()


def half_and_all(m):
    """The fact before 1998 with outdated quantities, and the whole fact as source."""
    dated = m.grain_totals("order_date")
    early = dated.filter(F.col("order_date") < F.lit("1998-01-01").cast("date"))
    return early.withColumn("quantity", F.lit(0).cast("bigint")), dated


@query("p22_fact_upsert", with_("o l", """
SELECT l.order_id, l.product_id, l.employee_id, l.line_number,
       CAST(sum(l.quantity) AS BIGINT) AS quantity,
       CASE WHEN o.order_date < DATE '1998-01-01' THEN 'updated' ELSE 'inserted' END AS action
FROM l JOIN o ON o.order_id = l.order_id GROUP BY ALL"""))
def fact_upsert(m):
    target, source = half_and_all(m)
    merged = facts.upsert_fact(target, source, facts.SALES_GRAIN)
    return merged.select(
        *facts.SALES_GRAIN, "quantity", F.col(merge.ACTION).alias("action")
    )


@query("p22_fact_upsert_by_partition", with_("o l", """
SELECT year(order_date) AS order_year, count(*) AS n,
       CAST(sum(CASE WHEN year(order_date) >= 2000 THEN quantity + 1 ELSE quantity END)
            AS BIGINT) AS quantity
FROM (SELECT o.order_date, l.order_id, l.product_id, l.employee_id, l.line_number,
             sum(l.quantity) AS quantity
      FROM l JOIN o ON o.order_id = l.order_id GROUP BY ALL) GROUP BY ALL"""))
def fact_upsert_by_partition(m):
    """Corrections of the last years rewrite the partitions of those years only."""
    path = work_folder(m.spark, "sales-by-year")
    sales = m.grain_totals("order_date").select(
        *facts.SALES_GRAIN, "quantity", F.year("order_date").alias("order_year")
    )
    sources.append_periods(sales, path, "order_year")
    corrected = sales.filter(F.col("order_year") >= 2000).withColumn(
        "quantity", F.col("quantity") + 1
    )
    sources.merge_into_partitions(
        m.spark, path, corrected, "order_year", facts.SALES_GRAIN,
        lambda target, source: merge.current_state(
            merge.merge_rows(target, source, facts.SALES_GRAIN)
        ),
    )
    return m.spark.read.parquet(path).groupBy("order_year").agg(
        F.count("*").alias("n"), F.sum("quantity").alias("quantity")
    )


@query("p23_fulfillment_fact", with_("ful cust", f"""
SELECT {fk('f.order_id')} AS fulfillment_sk, f.order_id,
       {sk('c.customer_id', 'c.valid_from')} AS customer_sk, {sk('f.ship_via')} AS shipper_sk,
       f.order_date_key, f.required_date_key, f.shipped_date_key, f.ship_country,
       f.days_to_ship, f.is_late
FROM ful f JOIN cust c ON c.customer_id = f.customer_id
 AND f.order_date >= c.valid_from AND f.order_date <= c.valid_to"""))
def fulfillment_fact(m):
    return m.fact_fulfillment()


STOCK = with_("stock prod", f"""
, fact AS (SELECT {fk('s.snapshot_date_key', sk('p.product_id', 'p.valid_from'))} AS stock_sk,
       s.snapshot_date_key, {sk('p.product_id', 'p.valid_from')} AS product_sk,
       {sk('s.category')} AS category_sk, s.units_in_stock, s.reorder_level, s.needs_reorder
  FROM stock s JOIN prod p ON p.product_id = s.product_id AND p.is_current)""")


@query("p26_stock_snapshots", STOCK + "\nSELECT * FROM fact")
def stock_snapshots(m):
    """Snapshots of the first years are loaded; a later run with all of them adds the rest."""
    everything = m.written(m.fact_stock(), compression="zstd")  # read three times; its keys are hex digits
    loaded = everything.filter(F.col("snapshot_date_key") < 19980101)
    return loaded.unionByName(facts.append_snapshot(loaded, everything))


@query("p27_copied_snapshot", STOCK + f"""
SELECT {fk('20020131', 'product_sk')} AS stock_sk, CAST(20020131 AS INTEGER) AS snapshot_date_key,
       product_sk, category_sk, units_in_stock, reorder_level, needs_reorder
FROM fact WHERE snapshot_date_key = 20010930""")
def copied_snapshot(m):
    return facts.copy_snapshot(m.fact_stock(), 20010930, date(2002, 1, 31)).select(
        "stock_sk", "snapshot_date_key", "product_sk", "category_sk", "units_in_stock",
        "reorder_level", "needs_reorder",
    )


@query("p28_dropped_snapshot", with_("stock", """
SELECT snapshot_date_key, count(*) AS n FROM stock WHERE snapshot_date_key <> 20010930 GROUP BY ALL"""))
def dropped_snapshot(m):
    """One snapshot removed from the stored table, and the same on the frame."""
    levels = m.stock_levels().select(
        date_key(F.col("snapshot_day")).alias("snapshot_date_key"), "product_id"
    )
    path = work_folder(m.spark, "stock")
    sources.append_periods(levels, path, "snapshot_date_key")
    sources.drop_periods(m.spark, path, "snapshot_date_key", [20010930])
    stored = m.spark.read.parquet(path)
    kept = facts.drop_snapshot(levels, 20010930)
    both = stored.groupBy("snapshot_date_key").agg(F.count("*").alias("n"))
    return both.join(
        kept.groupBy("snapshot_date_key").agg(F.count("*").alias("n")), ["snapshot_date_key", "n"]
    )


@query("p29_snapshot_trend", with_("stock", """
SELECT snapshot_date_key, count(*) AS products, CAST(sum(units_in_stock) AS BIGINT) AS total_stock,
       count(*) FILTER (WHERE needs_reorder) AS to_reorder FROM stock GROUP BY ALL"""))
def snapshot_trend(m):
    return facts.snapshot_trend(m.fact_stock())


@query("p30_snapshot_as_of", STOCK + """
SELECT product_sk, snapshot_date_key, units_in_stock FROM fact
WHERE snapshot_date_key = (SELECT max(snapshot_date_key) FROM fact
                           WHERE snapshot_date_key <= 20000215)""")
def snapshot_as_of(m):
    return facts.snapshot_as_of(m.fact_stock(), 20000215).select(
        "product_sk", "snapshot_date_key", "units_in_stock"
    )


LOADED = """
, n AS (SELECT 'dim_customer' AS step, count(*) AS "rows" FROM cust
  UNION ALL SELECT 'dim_product', count(*) FROM prod
  UNION ALL SELECT 'dim_employee', count(*) FROM supplier
  UNION ALL SELECT 'dim_territory', count(*) FROM nation
  UNION ALL SELECT 'dim_category', count(DISTINCT p_type) FROM part
  UNION ALL SELECT 'dim_shipper', count(*) FROM shipper
  UNION ALL SELECT 'dim_date', (SELECT count(*) FROM (SELECT make_date(min(year(o_orderdate)), 1, 1) AS a,
        make_date(max(year(o_orderdate)) + 1, 12, 31) AS b FROM orders) e,
        generate_series(e.a, e.b, INTERVAL 1 DAY))
  UNION ALL SELECT 'dim_order_flags', 24
  UNION ALL SELECT 'bridge_employee_territory', count(*) FROM pairs
  UNION ALL SELECT 'fact_sales', count(*) FROM lineitem
  UNION ALL SELECT 'fact_fulfillment', count(*) FROM orders
  UNION ALL SELECT 'fact_stock', count(*) FROM stock
  UNION ALL SELECT 'fact_activity', count(*) FROM act
  UNION ALL SELECT 'dim_customer_scd3', count(DISTINCT customer_id) FROM loads)
"""


@query("p42_p43_ordered_load", with_("cust prod shipper pairs stock act loads", LOADED + """
SELECT step, "rows", 'ok' AS status FROM n"""))
def ordered_load(m):
    """The whole warehouse built in dependency order; one log row per step."""
    folder = work_folder(m.spark, "warehouse")
    load.run(m, folder, datetime(2024, 1, 1, 6, 0))
    return load.run_log(m.spark, folder).select("step", "rows", "status")


@query("p43_continued_load", with_("cust prod shipper pairs stock act loads", LOADED + """
SELECT step, "rows", step NOT LIKE 'dim%' OR step = 'dim_customer_scd3' AS second_run FROM n"""))
def continued_load(m):
    """A load that breaks off at the first fact, run again: it goes on from there."""
    folder, when = work_folder(m.spark, "warehouse"), datetime(2024, 1, 1, 6, 0)
    steps = load.warehouse(m)
    first = [s for s in steps if s.name.startswith("dim") and s.name != "dim_customer_scd3"]

    def broken(_):
        raise RuntimeError("the load was stopped")

    fact = next(s for s in steps if s.name == "fact_sales")
    stopped = load.Step(fact.name, fact.schema, broken, tuple(s.name for s in first))
    try:
        load.run_steps(m.spark, folder, [*first, stopped], when)
    except RuntimeError:
        ran = load.run(m, folder, when)
    return load.run_log(m.spark, folder).select("step", "rows", F.col("step").isin(ran).alias("second_run"))


@query("p44_second_run_versions", with_("cust_loads", """
SELECT 'kept' AS action, count(*) AS "rows" FROM cust_loads"""))
def second_run_versions(m):
    """The last snapshot applied again on its own day changes no version."""
    day = m.load_dates()[-1]
    again = scd.scd2_apply(
        m.dim_customer_loads(), m.customer_snapshot(day), "customer_id", ["priority", "status"],
        day, "customer_sk",
    )
    return merge.action_counts(again)


@query("p44_second_run_fact", with_("o l", """
SELECT 'kept' AS action, count(*) AS "rows" FROM (
  SELECT 1 FROM l JOIN o ON o.order_id = l.order_id
  GROUP BY l.order_id, l.product_id, l.employee_id, l.line_number)"""))
def second_run_fact(m):
    """Merging the fact into itself changes no row."""
    fact = m.grain_totals()
    return merge.action_counts(merge.merge_rows(fact, fact, facts.SALES_GRAIN, only_changes=True))


@query("p44_second_run_snapshot", with_("stock", """
SELECT count(*) AS "rows", 0::BIGINT AS added FROM stock"""))
def second_run_snapshot(m):
    """Appending the snapshots that are loaded already adds none."""
    levels = m.stock_levels().withColumn("snapshot_date_key", date_key(F.col("snapshot_day")))
    added = facts.append_snapshot(levels, levels)
    return levels.agg(F.count("*").alias("rows")).withColumn("added", added.agg(F.count("*")).scalar())


@query("p44_second_run", with_("loads", """
SELECT 'kept' AS action, count(DISTINCT customer_id) AS "rows" FROM loads"""))
def second_run(m):
    """Merging the state a table already has changes no row."""
    state = merge.current_state(type_1_loads(m))
    again = merge.scd1_merge(state, state, "customer_id", only_changes=True)
    return merge.action_counts(again)
