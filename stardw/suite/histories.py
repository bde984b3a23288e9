"""Merges and slowly changing dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from stardw.functions import FIRST_DAY
from stardw.operators import facts, merge, scd
from stardw.session import work_folder
from stardw.sources import full_load

from .joins import SCD3_SQL
from .registry import query
from .sql import sk, with_

TRACKED = ["priority", "status"]

# Latest profile of each customer over all loads: the state of a type 1 dimension.
TYPE_1 = """
SELECT customer_id, priority, status FROM loads
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY load_date DESC) = 1"""


def type_1_loads(m, **options):
    """All snapshots merged one after the other; the last merge with its actions."""
    days = m.load_dates()
    state = m.written(m.customer_snapshot(days[0]))
    for day in days[1:-1]:
        merged = merge.scd1_merge(state, m.customer_snapshot(day), "customer_id", **options)
        state = m.written(merge.current_state(merged))
    return merge.scd1_merge(state, m.customer_snapshot(days[-1]), "customer_id", **options)


@query("p01_scd1_merge", with_("loads", TYPE_1))
def scd1_merge(m):
    return merge.current_state(type_1_loads(m))


@query("p02_scd1_only_changes", with_("loads", """
, a AS (SELECT * FROM loads WHERE load_date = :last_load),
  b AS (SELECT * FROM loads WHERE load_date = :next_to_last_load)
SELECT CASE WHEN b.customer_id IS NULL THEN 'inserted'
            WHEN a.priority IS DISTINCT FROM b.priority OR a.status IS DISTINCT FROM b.status
            THEN 'updated' ELSE 'kept' END AS action, count(*) AS "rows"
FROM a LEFT JOIN b ON b.customer_id = a.customer_id GROUP BY ALL"""))
def scd1_only_changes(m):
    return merge.action_counts(type_1_loads(m, only_changes=True))


@query("p03_scd1_refresh", """
SELECT n_nationkey AS territory_id, trim(n_name) AS territory_name, n_regionkey AS region_id
FROM nation""")
def scd1_refresh(m):
    path = work_folder(m.spark, "territory")
    for _ in range(2):
        full_load(m.territories(), path)
    return m.spark.read.parquet(path)


@query("p04_insert_only_merge", with_("loads", """
SELECT customer_id, priority, status, load_date > :first_load AS added FROM loads
WHERE load_date <= :second_load
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY load_date) = 1"""))
def insert_only_merge(m):
    old, new = m.customer_snapshot(m.load_dates()[0]), m.customer_snapshot(m.load_dates()[1])
    merged = merge.insert_only(old, new, ["customer_id"])
    return merged.withColumn("added", F.col(merge.ACTION) == "inserted").drop(merge.ACTION)


@query("p11_scd2_initial", with_("loads", f"""
SELECT {sk('customer_id', "DATE '1900-01-01'")} AS customer_sk, customer_id, priority, status,
       '1900-01-01' AS valid_from, '9999-12-31' AS valid_to, true AS is_current
FROM loads WHERE load_date = :first_load"""))
def scd2_initial(m):
    return scd.scd2_initial(m.customer_snapshot(m.load_dates()[0]), "customer_id", "customer_sk")


@query("p12_scd2_changes", with_("loads", """
SELECT b.customer_id, a.priority AS old_priority, a.status AS old_status, b.priority, b.status
FROM loads a JOIN loads b ON a.customer_id = b.customer_id
 AND a.load_date = :first_load AND b.load_date = :second_load
WHERE a.priority IS DISTINCT FROM b.priority OR a.status IS DISTINCT FROM b.status"""))
def scd2_changes(m):
    found = scd.scd2_changes(
        scd2_initial(m), m.customer_snapshot(m.load_dates()[1]), "customer_id", TRACKED
    )
    return found.withColumnsRenamed({"_old_priority": "old_priority", "_old_status": "old_status"})


@query("p13_p15_scd2_actions", with_("loads", """
, a AS (SELECT * FROM loads WHERE load_date = :first_load),
  b AS (SELECT * FROM loads WHERE load_date = :second_load),
  c AS (SELECT a.customer_id AS old_id, b.customer_id AS new_id,
               a.priority IS DISTINCT FROM b.priority OR a.status IS DISTINCT FROM b.status AS diff
        FROM a FULL JOIN b ON a.customer_id = b.customer_id)
SELECT 'expired' AS action, count(*) AS "rows" FROM c WHERE old_id IS NOT NULL AND new_id IS NOT NULL AND diff
UNION ALL
SELECT 'inserted', count(*) FROM c WHERE old_id IS NULL OR (new_id IS NOT NULL AND diff)
UNION ALL
SELECT 'kept', count(*) FROM c WHERE old_id IS NOT NULL AND (new_id IS NULL OR NOT diff)"""))
def scd2_actions(m):
    applied = scd.scd2_apply(
        scd2_initial(m), m.customer_snapshot(m.load_dates()[1]), "customer_id", TRACKED,
        m.load_dates()[1], "customer_sk",
    )
    return merge.action_counts(applied)


def versions_sql(part: str, key: str, name: str, columns: str) -> str:
    return with_(part, f"""
SELECT {sk(key, 'valid_from')} AS {name}, {key}, {columns},
       CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
       is_current FROM {part}""")


@query("p16_scd2_customer", versions_sql(
    "cust_loads", "customer_id", "customer_sk", "priority, status"))
def scd2_customer(m):
    return m.dim_customer_applied()


@query("p16_scd2_one_pass", versions_sql(
    "cust_loads", "customer_id", "customer_sk", "priority, status"))
def scd2_one_pass(m):
    """The state after all loads, built from the orders at once."""
    return m.dim_customer_loads()


@query("p16_scd2_from_first_day", with_("load_points", """
SELECT customer_id, priority, status,
       CAST(CASE WHEN nth = 1 THEN DATE '1900-01-01' ELSE load_date END AS VARCHAR) AS valid_from,
       CAST(coalesce(lead(load_date) OVER w - 1, DATE '9999-12-31') AS VARCHAR) AS valid_to
FROM load_points WINDOW w AS (PARTITION BY customer_id ORDER BY load_date)"""))
def scd2_from_first_day(m):
    """New members valid from the first day, so that early facts find them."""
    dim = m.dim_customer_applied(new_member_from=FIRST_DAY)
    return dim.select("customer_id", "priority", "status", "valid_from", "valid_to")


@query("p16_scd2_close_missing", with_("load_days", """
, y AS (SELECT year(load_date) AS load_year FROM load_days),
  snap AS (SELECT y.load_year, o.customer_id, o.priority FROM o JOIN y
             ON year(o.order_date) = y.load_year - 1 WHERE o.status = 'F'
           QUALIFY row_number() OVER (PARTITION BY y.load_year, o.customer_id
                                      ORDER BY o.order_date DESC, o.order_id DESC) = 1),
  p AS (SELECT *, lag(load_year) OVER w AS last_year, lag(priority) OVER w AS last_priority
        FROM snap WINDOW w AS (PARTITION BY customer_id ORDER BY load_year)),
  starts AS (SELECT customer_id, load_year, priority FROM p
             WHERE last_year IS NULL OR last_year < load_year - 1
                OR priority IS DISTINCT FROM last_priority),
  ends AS (SELECT s.customer_id, s.load_year, s.priority,
                  (SELECT min(y2.load_year) FROM y y2 WHERE y2.load_year > s.load_year
                     AND NOT EXISTS (SELECT 1 FROM p q WHERE q.customer_id = s.customer_id
                                     AND q.load_year = y2.load_year
                                     AND q.priority IS NOT DISTINCT FROM s.priority)) AS ended
           FROM starts s)
SELECT customer_id, priority,
       CASE WHEN load_year = year(:first_load) THEN '1900-01-01' ELSE load_year || '-01-01' END AS valid_from,
       CASE WHEN ended IS NULL THEN '9999-12-31' ELSE (ended - 1) || '-12-31' END AS valid_to,
       ended IS NULL AS is_current FROM ends"""))
def scd2_close_missing(m):
    """Members without a finished order in the year before a load are closed by it."""
    def snapshot(load_date):
        year = load_date.year - 1
        seen = m.orders().filter((F.year("order_date") == year) & (F.col("status") == "F"))
        last = F.max_by("priority", F.struct("order_date", "order_id"))
        return seen.groupBy("customer_id").agg(last.alias("priority"))

    dim = m.in_turn(
        lambda day: scd.scd2_initial(snapshot(day), "customer_id", "customer_sk"),
        lambda dim, day: scd.scd2_apply(
            dim, snapshot(day), "customer_id", ["priority"], day, "customer_sk",
            close_missing=True,
        ).drop(merge.ACTION),
    )
    return dim.select("customer_id", "priority", "valid_from", "valid_to", "is_current")


@query("p17_scd2_customer_history", versions_sql(
    "cust", "customer_id", "customer_sk", "priority, status"))
def scd2_customer_history(m):
    return m.dim_customer()


@query("p17_scd2_product_history", versions_sql(
    "prod", "product_id", "product_sk", "CAST(unit_price AS DOUBLE) AS unit_price"))
def scd2_product_history(m):
    return m.dim_product()


@query("p17_scd2_product_profile", with_("prod", f"""
SELECT {sk('v.product_id', 'v.valid_from')} AS product_sk, v.product_id, CAST(v.unit_price AS DOUBLE) AS unit_price,
       p.p_name AS product_name, p.p_type AS category, p.p_brand AS brand,
       CAST(v.valid_from AS VARCHAR) AS valid_from, CAST(v.valid_to AS VARCHAR) AS valid_to, v.is_current
FROM prod v LEFT JOIN part p ON p.p_partkey = v.product_id"""))
def scd2_product_profile(m):
    """Columns that open no version stand on every version of a product."""
    return m.dim_product_profile()


@query("p17_scd2_late_events", with_("cust", f"""
SELECT {sk('v.customer_id', 'v.valid_from')} AS customer_sk, v.customer_id, v.priority, v.status, n.ship_via,
       CAST(v.valid_from AS VARCHAR) AS valid_from, CAST(v.valid_to AS VARCHAR) AS valid_to, v.is_current,
       d.days AS days_seen
FROM cust v JOIN (SELECT customer_id, arg_max(ship_via, (order_date, order_id)) AS ship_via FROM o
                  GROUP BY customer_id) n ON n.customer_id = v.customer_id
JOIN (SELECT v.customer_id, v.valid_from, CAST(count(DISTINCT o.order_date) AS INTEGER) AS days
      FROM cust v JOIN o ON o.customer_id = v.customer_id AND o.order_date BETWEEN v.valid_from AND v.valid_to
      GROUP BY ALL) d ON d.customer_id = v.customer_id AND d.valid_from = v.valid_from"""))
def scd2_late_events(m):
    """Three batches, each from all days: versions are split and closed up as events arrive late."""
    return m.dim_customer_absorbed().withColumn("days_seen", F.size("seen")).drop("seen")


@query("p18_scd3_initial", with_("loads", """
SELECT customer_id, priority AS current_priority, CAST(NULL AS VARCHAR) AS previous_priority,
       CAST(NULL AS VARCHAR) AS priority_changed_on, status AS current_status,
       CAST(NULL AS VARCHAR) AS previous_status, CAST(NULL AS VARCHAR) AS status_changed_on
FROM loads WHERE load_date = :first_load"""))
def scd3_initial(m):
    return scd.scd3_initial(m.customer_snapshot(m.load_dates()[0]), "customer_id", TRACKED)


@query("p19_scd3_rotate", SCD3_SQL)
def scd3_rotate(m):
    return m.dim_customer_scd3()


@query("p20_scd3_new_members", with_("loads", """
SELECT customer_id, priority AS current_priority, CAST(NULL AS VARCHAR) AS previous_priority
FROM loads WHERE load_date = :second_load AND customer_id NOT IN
  (SELECT customer_id FROM loads WHERE load_date = :first_load)"""))
def scd3_new_members(m):
    applied = scd.scd3_apply(
        scd3_initial(m), m.customer_snapshot(m.load_dates()[1]), "customer_id", TRACKED,
        m.load_dates()[1],
    )
    return applied.filter(F.col(merge.ACTION) == "inserted").select(
        "customer_id", "current_priority", "previous_priority"
    )


def pending_then_shipped(m):
    """The order fact before and after the shipped dates since 1998 arrive."""
    after = m.fulfillment().select(
        "order_id", "order_date_key", "shipped_date_key", "days_to_ship", "is_late"
    )
    known = F.col("shipped_date_key") < 19980101
    before = after.withColumns({
        c: F.when(known, F.col(c)) for c in ("shipped_date_key", "days_to_ship", "is_late")
    })
    return before, after


@query("p24_milestone_merge", with_("ful", """
SELECT order_id, order_date_key, shipped_date_key, days_to_ship, is_late,
       CASE WHEN shipped_date_key >= 19980101 THEN 'updated' ELSE 'kept' END AS action FROM ful"""))
def milestone_merge(m):
    before, after = pending_then_shipped(m)
    return facts.milestone_merge(before, after).withColumnRenamed(merge.ACTION, "action")


@query("p25_rows_to_change", with_("ful", """
SELECT CASE WHEN shipped_date_key >= 19980101 THEN 'updated' ELSE 'kept' END AS action,
       count(*) AS "rows" FROM ful GROUP BY ALL"""))
def rows_to_change(m):
    before, after = pending_then_shipped(m)
    return merge.action_counts(facts.milestone_merge(before, after))


@query("p41_update_delete_by_predicate", with_("o", """
SELECT order_id, CASE WHEN priority = '5-LOW' THEN 'H' ELSE status END AS status, priority
FROM o WHERE NOT (status = 'P' AND ship_via = 1)"""))
def update_delete_by_predicate(m):
    orders = m.orders()
    low = merge.update_where(orders, F.col("priority") == "5-LOW", {"status": F.lit("H")})
    urgent = (F.col("status") == "P") & (F.col("ship_via") == 1)
    return merge.delete_where(low, urgent).select("order_id", "status", "priority")


@query("p45_update_from_source", with_("o l", """
SELECT o.order_id, CASE WHEN s.order_id IS NULL THEN o.priority ELSE s.label END AS priority,
       o.status
FROM o LEFT JOIN (SELECT order_id, 'big' AS label FROM l GROUP BY order_id
                  HAVING sum(quantity) > 200) s ON s.order_id = o.order_id"""))
def update_from_source(m):
    big = m.lines().groupBy("order_id").agg(F.sum("quantity").alias("q")).filter("q > 200")
    return merge.current_state(
        merge.update_from(
            m.orders().select("order_id", "priority", "status"),
            big.select("order_id", F.lit("big").alias("priority")), ["order_id"], ["priority"],
        )
    )
