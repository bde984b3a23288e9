"""Aggregates and windows (D, W)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stardw.functions import dense_key, mean, percent
from stardw.operators import quality, ranking
from stardw.operators.dims import ordered_list
from stardw.plans import reports

from .registry import query
from .sql import mean as sql_mean
from .sql import pct, with_


@query("d01_counts", with_("shipments", """
SELECT status, count(*) AS orders, count(shipped_date) AS shipped FROM shipments GROUP BY status"""))
def counts(m):
    return m.shipments().groupBy("status").agg(
        F.count("*").alias("orders"), F.count("shipped_date").alias("shipped")
    )


@query("d02_distinct_counts", with_("act", """
SELECT year(activity_date) AS activity_year, count(DISTINCT employee_id) AS members,
       count(DISTINCT territory_id) AS territories, count(DISTINCT activity_date) AS days
FROM act GROUP BY ALL"""))
def distinct_counts(m):
    """Distinct rows first: several distinct counts multiply the rows they read."""
    return m.activity_events().distinct().groupBy(F.year("activity_date").alias("activity_year")).agg(
        F.count_distinct("employee_id").alias("members"),
        F.count_distinct("territory_id").alias("territories"),
        F.count_distinct("activity_date").alias("days"),
    )


@query("d03_basic_aggregates", with_("l", f"""
SELECT employee_id, CAST(sum(net) AS DOUBLE) AS net, {sql_mean('net')} AS mean_net,
       CAST(min(net) AS DOUBLE) AS lowest, CAST(max(net) AS DOUBLE) AS highest
FROM l GROUP BY employee_id"""))
def basic_aggregates(m):
    net = F.col("net")
    return m.lines().groupBy("employee_id").agg(
        F.sum(net).alias("net"), mean(net).alias("mean_net"),
        F.min(net).alias("lowest"), F.max(net).alias("highest"),
    )


@query("d04_conditional_aggregates", with_("ful", """
SELECT ship_via, count(*) FILTER (WHERE is_late) AS late,
       count(*) FILTER (WHERE NOT is_late) AS on_time,
       CAST(sum(CASE WHEN is_late THEN days_to_ship ELSE 0 END) AS BIGINT) AS late_days
FROM ful GROUP BY ship_via"""))
def conditional_aggregates(m):
    late = F.col("is_late")
    return m.fulfillment().groupBy("ship_via").agg(
        F.count_if(late).alias("late"), F.count_if(~late).alias("on_time"),
        F.sum(F.when(late, F.col("days_to_ship")).otherwise(0)).alias("late_days"),
    )


@query("d05_guarded_ratio", with_("ful", f"""
SELECT ship_country, year(order_date) AS order_year, month(order_date) AS order_month,
       {pct('count(*) FILTER (WHERE is_late)', 'count(shipped_date)')} AS late_percent
FROM ful GROUP BY ALL"""))
def guarded_ratio(m):
    """NULL where nothing was shipped."""
    day = F.col("order_date")
    return m.fulfillment().groupBy(
        "ship_country", F.year(day).alias("order_year"), F.month(day).alias("order_month")
    ).agg(percent(F.count_if("is_late"), F.count("shipped_date")).alias("late_percent"))


@query("d06_difference_of_sums", with_("l", f"""
SELECT product_id, CAST(sum(gross - net) AS DOUBLE) AS lost,
       {pct('sum(gross - net)', 'sum(gross)')} AS lost_percent FROM l GROUP BY product_id"""))
def difference_of_sums(m):
    lost = F.sum(F.col("gross") - F.col("net"))
    return m.lines().groupBy("product_id").agg(
        lost.alias("lost"), percent(lost, F.sum("gross")).alias("lost_percent")
    )


@query("d07_ordered_text", with_("pairs terr", """
SELECT p.employee_id, string_agg(t.territory_name, ', ' ORDER BY t.territory_name)
       AS territory_list
FROM pairs p JOIN terr t ON t.territory_id = p.territory_id GROUP BY p.employee_id"""))
def ordered_text(m):
    return m.member_territories().join(m.territories(), "territory_id").groupBy(
        "employee_id"
    ).agg(ordered_list("territory_name").alias("territory_list"))


@query("d08_value_per_group", with_("pairs terr", """
SELECT p.employee_id, min(t.region_name) AS region_name
FROM pairs p JOIN terr t ON t.territory_id = p.territory_id GROUP BY p.employee_id"""))
def value_per_group(m):
    return m.member_territories().join(m.dim_territory(), "territory_id").groupBy(
        "employee_id"
    ).agg(F.min("region_name").alias("region_name"))


@query("d09_global_aggregate", with_("l", """
SELECT count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS quantity,
       CAST(sum(gross) AS DOUBLE) AS gross, CAST(sum(net) AS DOUBLE) AS net FROM l"""))
def global_aggregate(m):
    return m.lines().agg(
        F.count("*").alias("lines"), F.sum("quantity").alias("quantity"),
        F.sum("gross").alias("gross"), F.sum("net").alias("net"),
    )


@query("d10_pivot", with_("o l", """
SELECT p.p_brand AS brand, year(o.order_date) AS order_year, CAST(sum(l.net) AS DOUBLE) AS net
FROM l JOIN o ON o.order_id = l.order_id JOIN part p ON p.p_partkey = l.product_id GROUP BY ALL"""))
def pivot(m):
    """One column per year; shown with one row per cell, as SQL must know its columns beforehand."""
    sales = m.sales("order_date").join(m.products().select("product_id", "brand"), "product_id")
    return reports.cells(reports.by_year(sales, "brand"), "brand")


@query("d11_status_split", with_("ful", """
SELECT CASE WHEN shipped_date IS NULL THEN 'pending' WHEN is_late THEN 'late' ELSE 'on time' END
       AS state, count(*) AS orders FROM ful GROUP BY ALL"""))
def status_split(m):
    state = F.when(F.col("shipped_date").isNull(), "pending").when(F.col("is_late"), "late")
    return m.fulfillment().groupBy(state.otherwise("on time").alias("state")).agg(
        F.count("*").alias("orders")
    )


@query("d12_duplicate_grain", with_("l", """
SELECT order_id, line_number, count(*) AS n FROM l GROUP BY ALL HAVING count(*) > 1"""))
def duplicate_grain(m):
    return quality.duplicates(m.lines(), ["order_id", "line_number"])


@query("w01_rank_in_group", with_("o l", """
SELECT n.n_name AS country, year(o.order_date) AS order_year, CAST(sum(l.net) AS DOUBLE) AS net,
       rank() OVER (PARTITION BY year(o.order_date) ORDER BY sum(l.net) DESC) AS place
FROM l JOIN o ON o.order_id = l.order_id JOIN customer c ON c.c_custkey = o.customer_id
JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY n.n_name, year(o.order_date)"""))
def rank_in_group(m):
    return reports.ranked(
        m.sales("customer_id", "order_date").join(m.countries(), "customer_id")
        .groupBy(F.col("ship_country").alias("country"), F.year("order_date").alias("order_year"))
        .agg(F.sum("net").alias("net")),
        "net", ["order_year"],
    )


@query("w02_rank_filter", with_("o l", """
SELECT o.customer_id, CAST(sum(l.net) AS DOUBLE) AS net,
       rank() OVER (ORDER BY sum(l.net) DESC) AS place
FROM l JOIN o ON o.order_id = l.order_id GROUP BY o.customer_id
QUALIFY rank() OVER (ORDER BY sum(l.net) DESC) <= 10"""))
def rank_filter(m):
    totals = m.sales("customer_id").groupBy("customer_id").agg(F.sum("net").alias("net"))
    return reports.ranked(totals, "net", top=10)


@query("w03_top_per_group", with_("l", """
SELECT p.p_brand AS brand, l.product_id, CAST(sum(l.net) AS DOUBLE) AS net,
       rank() OVER (PARTITION BY p.p_brand ORDER BY sum(l.net) DESC) AS place
FROM l JOIN part p ON p.p_partkey = l.product_id GROUP BY p.p_brand, l.product_id
QUALIFY rank() OVER (PARTITION BY p.p_brand ORDER BY sum(l.net) DESC) <= 3"""))
def top_per_group(m):
    totals = (
        m.lines().groupBy("product_id").agg(F.sum("net").alias("net"))
        .join(m.products().select("product_id", "brand"), "product_id")
    )
    return reports.ranked(totals, "net", ["brand"], top=3).select(
        "brand", "product_id", "net", "place"
    )


MONTHLY = """
, mo AS (SELECT year(o.order_date) AS order_year, quarter(o.order_date) AS order_quarter,
                month(o.order_date) AS order_month, sum(l.net) AS net
         FROM l JOIN o ON o.order_id = l.order_id GROUP BY ALL)"""


@query("w04_running_total", with_("o l", MONTHLY + """
SELECT order_year, order_quarter, order_month, CAST(net AS DOUBLE) AS net,
       CAST(sum(net) OVER (PARTITION BY order_year, order_quarter ORDER BY order_month)
            AS DOUBLE) AS running FROM mo"""))
def running_total(m):
    w = (
        Window.partitionBy("order_year", "order_quarter").orderBy("order_month")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return reports.monthly(m.sales("order_date")).withColumn("running", F.sum("net").over(w))


@query("w05_previous_month", with_("o l", MONTHLY + """
SELECT order_year, order_quarter, order_month, CAST(net AS DOUBLE) AS net,
       CAST(net - lag(net) OVER (ORDER BY order_year, order_month) AS DOUBLE) AS change FROM mo"""))
def previous_month(m):
    """The window runs over one row per month."""
    w = Window.orderBy("order_year", "order_month")
    return reports.monthly(m.sales("order_date")).withColumn(
        "change", F.col("net") - F.lag("net").over(w)
    )


@query("w06_next_version", with_("prod", """
SELECT product_id, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
       CAST(lead(valid_from) OVER (PARTITION BY product_id ORDER BY valid_from) AS VARCHAR)
         AS next_from FROM prod"""))
def next_version(m):
    w = Window.partitionBy("product_id").orderBy("valid_from")
    return m.dim_product().select(
        "product_id", "valid_from", "valid_to", F.lead("valid_from").over(w).alias("next_from")
    )


@query("w07_quartiles", with_("l", f"""
SELECT brand, mean_discount, ntile(4) OVER (ORDER BY mean_discount, brand) AS quartile
FROM (SELECT p.p_brand AS brand, {sql_mean('l.discount')} AS mean_discount
      FROM l JOIN part p ON p.p_partkey = l.product_id GROUP BY p.p_brand)"""))
def quartiles(m):
    """The window runs over one row per brand."""
    sales = m.lines().join(m.products().select("product_id", "brand"), "product_id")
    means = sales.groupBy("brand").agg(mean(F.col("discount")).alias("mean_discount"))
    w = Window.orderBy("mean_discount", "brand")
    return means.withColumn("quartile", F.ntile(4).over(w))


@query("w07_quartiles_of_products", with_("l", f"""
SELECT product_id, mean_discount, ntile(4) OVER (ORDER BY mean_discount, product_id) AS quartile
FROM (SELECT product_id, {sql_mean('discount')} AS mean_discount FROM l GROUP BY product_id)"""))
def quartiles_of_products(m):
    """Over as many rows as there are products: by ranges, with no window over all of them."""
    means = m.lines().groupBy("product_id").agg(mean(F.col("discount")).alias("mean_discount"))
    return ranking.tiled(means, 4, ["mean_discount", "product_id"], "quartile")


@query("w02_rank_of_all", with_("o l", """
SELECT o.customer_id, CAST(sum(l.net) AS DOUBLE) AS net, count(*) AS lines,
       rank() OVER (ORDER BY count(*) DESC) AS place
FROM l JOIN o ON o.order_id = l.order_id GROUP BY o.customer_id"""))
def rank_of_all(m):
    """Every customer ranked, with many ties, and none dropped."""
    totals = m.sales("customer_id").groupBy("customer_id").agg(
        F.sum("net").alias("net"), F.count("*").alias("lines"))
    return ranking.ranked_all(totals, "-lines", "place")


@query("w08_latest_row", """
SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_orderstatus AS status FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_row(m):
    """The test on the row number lets every task drop all but its own latest rows."""
    w = Window.partitionBy("customer_id").orderBy(F.desc("order_date"), F.desc("order_id"))
    numbered = m.orders().withColumn("_nth", F.row_number().over(w))
    return numbered.filter(F.col("_nth") == 1).select("customer_id", "order_id", "status")


@query("w08_dense_key", """
SELECT row_number() OVER (ORDER BY substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 3), o_orderkey)
       AS order_no, o_orderkey AS order_id FROM orders""")
def dense_key_query(m):
    return dense_key(m.orders().select("order_id"), "order_id", "order_no")
