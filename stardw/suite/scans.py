"""Sources, sinks and table definitions (A)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw import sources
from stardw.operators import incremental, quality
from stardw.operators.merge import current_state
from stardw.session import work_folder
from stardw.sources.contracts import (DAY, FLAG, ID, NUMBER, RAW, TEXT, contract,
                                      with_missing_columns)
from stardw.sources.readers import stamped

from .registry import query
from .sql import with_

LOAD_TS = datetime(2024, 1, 1, 6, 0)


@query("a01_csv_scan", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS territory_id,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance, c_mktsegment AS segment
FROM customer""")
def csv_scan(m):
    path = work_folder(m.spark, "customer-csv")
    m.customers().write.option("header", True).csv(path)
    return sources.read_csv(m.spark, path, RAW["customer"]).drop("load_ts")


@query("a02_csv_line_breaks", """
SELECT c_custkey AS customer_id, c_name || chr(10) || 'Att. "' || c_mktsegment || '", desk' AS address,
       c_nationkey AS territory_id FROM customer""")
def csv_line_breaks(m):
    path = work_folder(m.spark, "address-csv")
    address = F.concat(
        "customer_name", F.lit('\nAtt. "'), "segment", F.lit('", desk')
    )
    m.customers().select("customer_id", address.alias("address"), "territory_id").write.option(
        "header", True
    ).option("escape", '"').csv(path)
    shape = contract(customer_id=ID, address=TEXT, territory_id=NUMBER)
    return sources.read_csv(m.spark, path, shape, multi_line=True).drop("load_ts")


@query("a03_cast_or_null", """
SELECT o_orderstatus AS status, count(*) AS n, count(code) AS n_valid,
       CAST(sum(code) AS BIGINT) AS total
FROM (SELECT o_orderstatus, TRY_CAST(CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS VARCHAR)
             ELSE o_orderpriority END AS BIGINT) AS code FROM orders)
GROUP BY o_orderstatus""")
def cast_or_null(m):
    text = F.when(F.col("status") == "F", F.col("order_id").cast("string"))
    raw = m.orders().select("status", text.otherwise(F.col("priority")).alias("code"))
    typed = sources.conform(raw, contract(status=TEXT, code=ID))
    return typed.groupBy("status").agg(
        F.count("*").alias("n"), F.count("code").alias("n_valid"), F.sum("code").alias("total")
    )


@query("a04_projected_scan", """
SELECT s_suppkey AS supplier_id, s_name AS company_name, s_nationkey AS country_id FROM supplier""")
def projected_scan(m):
    return sources.read_table(
        m.spark, f"{m.folder}/supplier.parquet",
        {"s_suppkey": "supplier_id", "s_name": "company_name", "s_nationkey": "country_id"},
    )


@query("a05_trim_and_cut", """
SELECT p_partkey AS product_id, p_name AS product_name, substr(p_brand || ' ' || p_type, 1, 10)
       AS description FROM part""")
def trim_and_cut(m):
    path = work_folder(m.spark, "part-csv")
    m.products().select(
        "product_id",
        F.rpad("product_name", 50, " ").alias("product_name"),
        F.concat_ws(" ", "brand", "category").alias("description"),
    ).write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(path)
    shape = contract(product_id=ID, product_name=TEXT, description=TEXT)
    return sources.read_csv(
        m.spark, path, shape, trim=["product_name"], cut={"description": 10}
    ).drop("load_ts")


@query("a06_full_load", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date FROM orders""")
def full_load(m):
    path = work_folder(m.spark, "orders")
    shape = contract(order_id=ID, customer_id=ID, status=TEXT, order_date=DAY)
    shuffled_columns = m.orders().select("status", "order_date", "order_id", "customer_id")
    for _ in range(2):  # the second load replaces the first
        sources.full_load(shuffled_columns, path, shape)
    return m.spark.read.parquet(path)


@query("a07_load_stamp", """
SELECT '2024-01-01 06:00:00.000000' AS load_ts, count(*) AS n FROM customer""")
def load_stamp(m):
    return stamped(m.customers(), LOAD_TS).groupBy("load_ts").agg(F.count("*").alias("n"))


@query("a08_append", """
SELECT year(o_orderdate) AS order_year, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY ALL""")
def append(m):
    path = work_folder(m.spark, "orders-by-year")
    dated = m.given("orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_price"),
        F.year("o_orderdate").alias("order_year"),
    )
    early = F.col("order_year") < 1998
    sources.append_periods(dated.filter(early), path, "order_year")
    sources.append_periods(dated.filter(~early), path, "order_year")
    return m.spark.read.parquet(path).groupBy("order_year").agg(
        F.count("*").alias("n"), F.sum("total_price").alias("total")
    )


@query("a09_create_or_replace", """
SELECT c_nationkey AS territory_id, count(*) AS customers FROM customer GROUP BY c_nationkey""")
def create_or_replace(m):
    path = work_folder(m.spark, "customers")
    sources.create_or_replace(m.customers().select("customer_id"), path)
    counted = m.customers().groupBy("territory_id").agg(F.count("*").alias("customers"))
    sources.create_or_replace(counted, path)
    return m.spark.read.parquet(path)


@query("a10_typed_contract", with_("l", """
SELECT order_id, product_id, employee_id, line_number, quantity,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount AS DOUBLE) AS discount,
       CAST(gross AS DOUBLE) AS gross, CAST(net AS DOUBLE) AS net,
       CAST(ship_date AS VARCHAR) AS ship_date FROM l"""))
def typed_contract(m):
    return m.lines()


@query("a11_temporary_view", with_("o", """
SELECT status, count(*) AS n FROM o GROUP BY status"""))
def temporary_view(m):
    m.orders().createOrReplaceTempView("stardw_src_orders")
    return m.spark.sql("SELECT status, count(*) AS n FROM stardw_src_orders GROUP BY status")


@query("a12_persistent_view", """
SELECT o_orderstatus AS order_status, count(*) AS n FROM orders GROUP BY o_orderstatus""")
def persistent_view(m):
    m.spark.sql(
        "CREATE OR REPLACE VIEW stardw_v_order AS SELECT o_orderkey AS order_id, "
        f"o_orderstatus AS order_status FROM parquet.`{m.folder}/orders.parquet`"
    )
    return m.spark.table("stardw_v_order").groupBy("order_status").agg(F.count("*").alias("n"))


@query("a13_literal_rows", with_("o", """
SELECT v.shipper_name, count(*) AS orders
FROM o JOIN (VALUES (1, 'Express'), (2, 'Standard'), (3, 'Economy')) v(code, shipper_name)
  ON v.code = o.ship_via GROUP BY v.shipper_name"""))
def literal_rows(m):
    codes = sources.rows(
        m.spark, [(1, "Express"), (2, "Standard"), (3, "Economy")],
        "ship_via int, shipper_name string",
    )
    return (
        m.orders().join(F.broadcast(codes), "ship_via")
        .groupBy("shipper_name").agg(F.count("*").alias("orders"))
    )


@query("a14_date_series", with_("o", """
SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS day, coalesce(n, 0) AS orders
FROM (SELECT min(order_date) AS a, max(order_date) AS b FROM o) e,
     generate_series(e.a, e.b, INTERVAL 1 DAY) g(d)
LEFT JOIN (SELECT order_date, count(*) AS n FROM o GROUP BY order_date) c
  ON c.order_date = CAST(d AS DATE)"""))
def date_series(m):
    ends = m.order_days()
    days = sources.date_series(m.spark, ends["lo"], ends["hi"])
    per_day = m.orders().groupBy(F.col("order_date").alias("day")).agg(F.count("*").alias("n"))
    return days.join(per_day, "day", "left").select(
        "day", F.coalesce("n", F.lit(0)).alias("orders")
    )


@query("a15_added_column", with_("o", """
SELECT year(order_date) AS order_year, count(*) AS n, count(order_flags_sk) AS n_flagged
FROM (SELECT order_date, CASE WHEN order_date >= DATE '1998-01-01' THEN ship_via END
             AS order_flags_sk FROM o) GROUP BY ALL"""))
def added_column(m):
    cut = F.lit("1998-01-01").cast("date")
    old = m.orders().filter(F.col("order_date") < cut).select("order_id", "order_date")
    new = m.orders().filter(F.col("order_date") >= cut).select(
        "order_id", "order_date", F.col("ship_via").alias("order_flags_sk")
    )
    # A second run finds the column present and changes nothing.
    widened = with_missing_columns(with_missing_columns(old, new.schema), new.schema)
    both = widened.unionByName(new)
    return both.groupBy(F.year("order_date").alias("order_year")).agg(
        F.count("*").alias("n"), F.count("order_flags_sk").alias("n_flagged")
    )


@query("a16_inventory", "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS \"rows\", {e} AS expected, count(*) = {e} AS ok FROM {t}"
    for t, e in [("region", "CAST(5 AS BIGINT)"), ("nation", "CAST(25 AS BIGINT)"),
                 ("customer", "CAST(NULL AS BIGINT)"), ("supplier", "CAST(NULL AS BIGINT)"),
                 ("part", "CAST(NULL AS BIGINT)"), ("orders", "CAST(NULL AS BIGINT)"),
                 ("lineitem", "CAST(NULL AS BIGINT)")]))
def inventory(m):
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
    return quality.inventory({n: m.given(n) for n in names}, {"region": 5, "nation": 25})


@query("a17_preview", with_("o", """
SELECT order_id, customer_id, status, CAST(order_date AS VARCHAR) AS order_date
FROM o ORDER BY order_id LIMIT 10"""))
def preview(m):
    return m.orders().select("order_id", "customer_id", "status", "order_date").orderBy(
        "order_id"
    ).limit(10)


@query("a18_load_window", """
SELECT 'orders' AS "table", CAST(min(o_orderdate) AS DATE)::VARCHAR AS first_load,
       CAST(max(o_orderdate) AS DATE)::VARCHAR AS last_load, count(*) AS "rows" FROM orders
UNION ALL
SELECT 'lineitem', CAST(min(l_shipdate) AS DATE)::VARCHAR,
       CAST(max(l_shipdate) AS DATE)::VARCHAR, count(*) FROM lineitem
UNION ALL
SELECT 'events', CAST(min(ts) AS DATE)::VARCHAR, CAST(max(ts) AS DATE)::VARCHAR, count(*)
FROM events""")
def load_window(m):
    stamps = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    return quality.load_window({n: (m.given(n), c) for n, c in stamps.items()})


LATEST_EVENT = """
SELECT user_id, event_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


@query("a19_high_water_mark", LATEST_EVENT)
def high_water_mark(m):
    """First load up to a day, then everything after the mark of that load."""
    events, order = m.events(), ["ts", "event_id"]
    first_load = events.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    table = incremental.latest_per_key(first_load, ["user_id"], order)
    arrived = incremental.new_rows(events, table, "ts")
    return current_state(incremental.upsert_latest(table, arrived, ["user_id"], order))


def change_feed(m) -> tuple[DataFrame, DataFrame]:
    events = m.events()
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    return events.filter(early), events.filter(~early)


@query("a20_change_feed", f"SELECT * FROM ({LATEST_EVENT}) WHERE event_type <> 'error'")
def change_feed_applied(m):
    """Two batches of a feed in which an error event deletes the user."""
    first, second = change_feed(m)
    keys, order = ["user_id"], ["ts", "event_id"]
    deleted = F.col("event_type") == "error"
    empty = with_missing_columns(first, contract(is_deleted=FLAG)).filter(F.lit(False))
    state = current_state(incremental.apply_changes(empty, first, keys, order, deleted))
    state = current_state(incremental.apply_changes(state, second, keys, order, deleted))
    return incremental.live(state).select("user_id", "event_id", "event_type", "value", "ts")
