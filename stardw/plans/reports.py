"""Analytical reports on the dimensional model.

`sales` is a frame of sale lines (order_id, gross, net, discount and the
attributes a report groups by); `orders` is the accumulating fact with
shipped_date_key, days_to_ship and is_late. Attribute joins go before the
grouping only where the grouping needs them; where a report groups by a key,
totals per key are formed first and named afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stardw.functions import mean, percent
from stardw.operators.ranking import tiled


def ranked(
    totals: DataFrame, by: str, within: Sequence[str] = (), top: int | None = None
) -> DataFrame:
    """Rank by a total, ties sharing a place; `top` keeps places up to it.

    With `top` every task drops rows beyond its own top places before the
    shuffle, so the ranking of many rows does not gather them in one task.
    Without `top` the totals must be few.
    """
    place = F.rank().over(Window.partitionBy(*within).orderBy(F.desc(by)))
    out = totals.withColumn("place", place)
    return out if top is None else out.filter(F.col("place") <= top)


def monthly(sales: DataFrame) -> DataFrame:
    day = F.col("order_date")
    return sales.groupBy(
        F.year(day).alias("order_year"), F.quarter(day).alias("order_quarter"),
        F.month(day).alias("order_month"),
    ).agg(F.sum("net").alias("net"))


def by_year(sales: DataFrame, by: str, years: Sequence[int] | None = None) -> DataFrame:
    """Net revenue with one column per year that occurs.

    The years are found by one more job over the totals; given `years` save it
    and leave all others out.
    """
    totals = sales.groupBy(by, F.year("order_date").alias("_year")).agg(F.sum("net").alias("net"))
    return totals.groupBy(by).pivot("_year", None if years is None else list(years)).agg(F.sum("net"))


def cells(pivoted: DataFrame, by: str) -> DataFrame:
    """The filled cells of a table of `by_year`, one row each."""
    years = [c for c in pivoted.columns if c != by]
    if not years:
        return pivoted.select(by, F.lit(None).cast("int").alias("order_year"), F.lit(None).alias("net"))
    long = pivoted.unpivot(by, years, "order_year", "net").filter(F.col("net").isNotNull())
    return long.withColumn("order_year", F.col("order_year").cast("int"))


def revenue_by(sales: DataFrame, by: Sequence[str]) -> DataFrame:
    """Orders, gross, net, discount given and mean discount in percent.

    Orders are counted apart from the sums: a distinct count in the same
    grouping would carry every sum through the shuffle of each single order.
    """
    orders = sales.select(*by, "order_id").distinct().groupBy(*by).agg(
        F.count("*").alias("orders")
    )
    sums = sales.groupBy(*by).agg(
        F.sum("gross").alias("gross"),
        F.sum("net").alias("net"),
        F.sum(F.col("gross") - F.col("net")).alias("discount_total"),
        (mean(F.col("discount")) * 100).alias("mean_discount_pct"),
    )
    return same_groups(sums, orders, by)


def same_groups(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Put two totals of the same groups side by side; a NULL group meets its like."""
    other = right.withColumnsRenamed({c: f"_r_{c}" for c in by})
    equal = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in by))
    return left.join(other, equal).drop(*[f"_r_{c}" for c in by])


def top_members(sales: DataFrame, key: str, top: int) -> DataFrame:
    """Orders, net and mean line of the members with the highest net.

    Lines are summed per order before orders are counted per member: no
    distinct count is needed, and a busy member is summed by many tasks.
    """
    per_order = sales.groupBy(key, "order_id").agg(
        F.sum("net").alias("_net"), F.count("*").alias("_lines")
    )
    totals = per_order.groupBy(key).agg(
        F.count("*").alias("orders"),
        F.sum("_net").alias("net"),
        F.sum("_lines").alias("_lines"),
    )
    best = ranked(totals, "net", top=top)
    return best.withColumn(
        "mean_line", F.col("net").cast("double") / F.col("_lines")
    ).drop("_lines")


def delivery(orders: DataFrame, by: Sequence[str]) -> DataFrame:
    """Delivered orders: on time, late, percent on time, mean days."""
    late = F.col("is_late")
    return orders.filter(F.col("shipped_date_key").isNotNull()).groupBy(*by).agg(
        F.count("*").alias("delivered"),
        F.count_if(~late).alias("on_time"),
        F.count_if(late).alias("late"),
        percent(F.count_if(~late), F.count("*")).alias("on_time_pct"),
        mean(F.col("days_to_ship")).alias("mean_days"),
    )


def destinations(orders: DataFrame, by: Sequence[str]) -> DataFrame:
    """All orders by destination; the percentage is over the shipped ones."""
    late = F.col("is_late")
    return orders.groupBy(*by).agg(
        F.count("*").alias("orders"),
        F.count_if(~late).alias("on_time"),
        F.count_if(late).alias("late"),
        mean(F.col("days_to_ship")).alias("mean_lead_time"),
        percent(F.count_if(~late), F.count("shipped_date_key")).alias("on_time_pct"),
    )


def version_sales(versions: DataFrame, facts: DataFrame, sk: str) -> DataFrame:
    """Sales and revenue per version, zero for a version without sales.

    `facts` carries the version key; its totals are formed before the join.
    """
    totals = facts.groupBy(sk).agg(F.count("*").alias("_n"), F.sum("net").alias("_net"))
    return versions.join(totals, sk, "left").withColumns(
        {
            "sales": F.coalesce("_n", F.lit(0)),
            "net": F.coalesce("_net", F.lit(0).cast("decimal(18,4)")),
        }
    ).drop("_n", "_net")


def by_hierarchy(sales: DataFrame, members: DataFrame) -> DataFrame:
    """Lines, net and mean line per member under its manager."""
    totals = sales.groupBy("employee_id").agg(
        F.count("*").alias("lines"), F.sum("net").alias("net")
    )
    return totals.join(
        members.select("employee_id", "full_name", "manager_name"), "employee_id"
    ).select(
        F.coalesce("manager_name", F.lit("(top)")).alias("manager"),
        "full_name", "lines", "net",
        (F.col("net").cast("double") / F.col("lines")).alias("mean_line"),
    )


def seasonality(sales: DataFrame) -> DataFrame:
    """Orders and net per month, running total of the quarter, change on the month before.

    The windows run over one row per month. Lines are summed per order first,
    so that counting orders needs no distinct count.
    """
    day = F.col("order_date")
    per_order = sales.groupBy("order_id", "order_date").agg(F.sum("net").alias("net"))
    months = per_order.groupBy(
        F.year(day).alias("order_year"), F.quarter(day).alias("order_quarter"),
        F.month(day).alias("order_month"), F.date_format(day, "MMMM").alias("month_name"),
    ).agg(F.count("*").alias("orders"), F.sum("net").alias("net"))
    quarter = Window.partitionBy("order_year", "order_quarter").orderBy("order_month")
    line = Window.orderBy("order_year", "order_month")
    return months.withColumns(
        {
            "quarter_to_date": F.sum("net").over(quarter),
            "change": F.col("net") - F.lag("net").over(line),
        }
    )


def to_reorder(stock: DataFrame, products: DataFrame, key: str) -> DataFrame:
    """Products below their level in the latest snapshot."""
    latest = stock.agg(F.max("snapshot_date_key")).scalar()
    low = stock.filter((F.col("snapshot_date_key") == latest) & F.col("needs_reorder"))
    return low.join(products, key).withColumn(
        "above_level", F.col("units_in_stock") - F.col("reorder_level")
    )


def discount_impact(sales: DataFrame, by: str) -> DataFrame:
    """What discounts cost per group, and the quartile of the group by mean discount.

    The quartiles are formed over one row per group, by ranges: there may be as
    many groups as products.
    """
    lost = F.sum(F.col("gross") - F.col("net"))
    groups = sales.groupBy(by).agg(
        (mean(F.col("discount")) * 100).alias("mean_discount_pct"),
        F.sum("gross").alias("gross"),
        F.sum("net").alias("net"),
        lost.alias("lost"),
        percent(lost, F.sum("gross")).alias("lost_pct"),
    )
    return tiled(groups, 4, ["mean_discount_pct", by], "quartile")


def territory_revenue(
    sales: DataFrame, bridge: DataFrame, territories: DataFrame
) -> DataFrame:
    """Orders and net per territory through the bridge, plain and weighted.

    Plain sums count a sale once per territory of its member; weighted sums
    add up to the total of the facts, to the last unit: of the units (1/10000)
    of a member, each of its `parts` territories gets the whole quotient and the
    first ones in order of their key one unit of the remainder.

    Net is summed per member before the fan-out. An order has lines of several
    members, so it must count once per territory: members are first replaced by
    the set of their territories, which many of them share, and orders are made
    distinct per set. Only an order with several sets can meet a territory
    twice, so that the distinct pairs of order and territory are few.
    """
    units = (F.col("net") * 10_000).cast("decimal(38,0)")
    place = F.row_number().over(Window.partitionBy("employee_sk").orderBy("territory_sk"))
    shares = bridge.withColumn("_place", place)
    per_member = sales.groupBy("employee_sk").agg(F.sum("net").alias("net"))
    quotient = F.expr("_units div parts")
    part = quotient + F.when(
        F.col("_place") <= F.col("_units") - quotient * F.col("parts"), 1
    ).otherwise(0)
    revenue = (
        per_member.withColumn("_units", units.cast("bigint")).join(shares, "employee_sk")
        .withColumn("_part", part)
        .groupBy("territory_sk")
        .agg(F.sum("net").alias("net"), (F.sum("_part").cast("decimal(22,0)") / 10_000)
             .cast("decimal(22,4)").alias("weighted_net"))
    )
    sets = bridge.groupBy("employee_sk").agg(F.array_sort(F.collect_list("territory_sk")).alias("_set"))
    sets = sets.withColumn("_set_sk", F.xxhash64("_set"))
    orders = (
        sales.select("employee_sk", "order_id").join(sets.select("employee_sk", "_set_sk"), "employee_sk")
        .select("_set_sk", "order_id").distinct()
        .join(sets.select("_set_sk", "_set").dropDuplicates(["_set_sk"]), "_set_sk")
        .groupBy("order_id").agg(F.array_distinct(F.flatten(F.collect_list("_set"))).alias("_all"))
        .select(F.explode("_all").alias("territory_sk"))
        .groupBy("territory_sk").agg(F.count("*").alias("orders"))
    )
    return revenue.join(orders, "territory_sk").join(territories, "territory_sk")


def lead_times(orders: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    days = F.col("days_to_ship")
    return orders.groupBy(*by).agg(
        F.count("*").alias("orders"),
        F.count_if(F.col("shipped_date_key").isNull()).alias("pending"),
        F.count_if("is_late").alias("late"),
        mean(days).alias("mean_days"), F.min(days).alias("least"), F.max(days).alias("most"),
    )


def idle_months(
    bridge: DataFrame, activity: DataFrame, on: Sequence[str], month: Column, months: Column
) -> DataFrame:
    """Assigned pairs with the number of months in which nothing happened.

    Active months are counted per key and taken from the number of all months;
    pairs with no activity at all are idle in every month.
    """
    active = activity.select(*on, month.alias("_month")).distinct().groupBy(*on).agg(
        F.count("*").alias("_active")
    )
    idle = months - F.coalesce(F.col("_active"), F.lit(0))
    return bridge.join(active, list(on), "left").withColumn("idle_months", idle).filter(
        F.col("idle_months") > 0
    ).drop("_active")
