"""Fact builds: transactional, accumulating, periodic and factless."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stardw.functions import changed, date_key, days_between, fact_key, late_flag

from .asof import as_of_join, years_of
from .junk import assign_flags
from .merge import insert_only, merge_rows

SALES_GRAIN = ["order_id", "product_id", "employee_id", "line_number"]


def sales_fact(
    lines: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    employees: DataFrame,
    shippers: DataFrame,
    flags: DataFrame,
    hot_customers: DataFrame | None = None,
    hot_products: DataFrame | None = None,
) -> DataFrame:
    """Transactional fact on the grain of a line, with version keys as of the order date.

    Customer versions are resolved on the orders, before the lines multiply
    them. Inner joins: a line without a version is left out and shows up in
    `asof.unmatched`. `hot_customers` and `hot_products` (from `skew.hot_keys`)
    split members that hold a large share of the rows.
    """
    years = years_of(orders, "order_date")
    headers = as_of_join(
        orders.select("order_id", "customer_id", "order_date", "ship_via"),
        customers, "customer_id", "order_date", ["customer_sk"], span=years,
        hot=hot_customers, spread_by=["order_id"],
    ).join(
        shippers.select(F.col("shipper_id").alias("ship_via"), "shipper_sk"), "ship_via"
    )
    sold = lines.join(headers, "order_id").join(
        employees.select("employee_id", "employee_sk"), "employee_id"
    )
    priced = as_of_join(
        sold, products, "product_id", "order_date", ["product_sk"], span=years,
        hot=hot_products, spread_by=SALES_GRAIN,
    )
    return assign_flags(priced, flags).select(
        fact_key(*SALES_GRAIN).alias("sales_sk"),
        *SALES_GRAIN,
        date_key(F.col("order_date")).alias("order_date_key"),
        "customer_sk", "product_sk", "employee_sk", "shipper_sk", "order_flags_sk",
        "unit_price", "quantity", "discount", "gross", "net",
    )


def upsert_fact(target: DataFrame, source: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Update or insert on the grain; fails if the source has a grain key twice."""
    return merge_rows(target, source, grain)


def fulfillment_fact(
    orders: DataFrame, customers: DataFrame, shippers: DataFrame, countries: DataFrame,
    hot_customers: DataFrame | None = None,
) -> DataFrame:
    """Accumulating snapshot: one row per order, filled as milestones arrive.

    Everything that depends on the shipped date is NULL while it is missing.
    """
    placed = as_of_join(
        orders, customers, "customer_id", "order_date", ["customer_sk"],
        hot=hot_customers, spread_by=["order_id"],
    )
    return (
        placed.join(countries.select("customer_id", "ship_country"), "customer_id")
        .join(
            shippers.select(F.col("shipper_id").alias("ship_via"), "shipper_sk"),
            "ship_via", "left",
        )
        .select(
            fact_key("order_id").alias("fulfillment_sk"),
            "order_id", "customer_sk", "shipper_sk", *milestones(), "ship_country",
        )
    )


def milestones(
    ordered: str = "order_date", required: str = "required_date", shipped: str = "shipped_date"
) -> list[Column]:
    """Date keys, lead time and late flag of an order."""
    start, due, done = F.col(ordered), F.col(required), F.col(shipped)
    return [
        date_key(start).alias("order_date_key"),
        date_key(due).alias("required_date_key"),
        date_key(done).alias("shipped_date_key"),
        days_between(start, done).alias("days_to_ship"),
        late_flag(done, due).alias("is_late"),
    ]


def milestone_merge(target: DataFrame, source: DataFrame) -> DataFrame:
    """Update an order only when its shipped date arrives, changes or is withdrawn."""
    return merge_rows(
        target, source, ["order_id"],
        update_when=lambda t, s: changed(t("shipped_date_key"), s("shipped_date_key")),
        update_cols=["shipped_date_key", "days_to_ship", "is_late"],
    )


def stock_snapshot(state: DataFrame, day: Column, products: DataFrame) -> DataFrame:
    """State of every product stamped with a snapshot day."""
    stamped = state.withColumn("snapshot_date_key", date_key(day))
    return stamped.join(products, "product_id").select(
        fact_key("snapshot_date_key", "product_sk").alias("stock_sk"),
        "snapshot_date_key", "product_sk", "category_sk", "units_in_stock", "reorder_level",
        (F.col("units_in_stock") <= F.col("reorder_level")).alias("needs_reorder"),
    )


def append_snapshot(
    existing: DataFrame, batch: DataFrame, period: str = "snapshot_date_key"
) -> DataFrame:
    """Rows of `batch` whose period is not loaded yet; a loaded period is left alone.

    Periods are as few as a calendar has, so they go to all tasks and the batch,
    a whole fact maybe, is not shuffled by them.
    """
    loaded = existing.select(period).distinct()
    return batch.join(F.broadcast(loaded), period, "left_anti")


def copy_snapshot(stock: DataFrame, source_key: int, target_day: date) -> DataFrame:
    """Rows of one snapshot filed under another day."""
    return stock.filter(F.col("snapshot_date_key") == source_key).withColumn(
        "snapshot_date_key", date_key(F.lit(target_day))
    ).withColumn("stock_sk", fact_key("snapshot_date_key", "product_sk"))


def drop_snapshot(stock: DataFrame, snapshot_key: int) -> DataFrame:
    return stock.filter(F.col("snapshot_date_key") != snapshot_key)


def snapshot_as_of(stock: DataFrame, cut_off: int | Column) -> DataFrame:
    """The latest snapshot not after a date key."""
    limit = cut_off if isinstance(cut_off, Column) else F.lit(cut_off)
    latest = stock.filter(F.col("snapshot_date_key") <= limit).agg(F.max("snapshot_date_key"))
    return stock.filter(F.col("snapshot_date_key") == latest.scalar())


def snapshot_trend(stock: DataFrame) -> DataFrame:
    """Products, total stock and products to reorder per snapshot."""
    return stock.groupBy("snapshot_date_key").agg(
        F.count("*").alias("products"),
        F.sum("units_in_stock").alias("total_stock"),
        F.count_if("needs_reorder").alias("to_reorder"),
    )


def month_end_levels(
    movements: DataFrame, spread: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Stock level of every product at every month end from its first movement on.

    `quantity` is signed: what comes in is positive, what goes out negative.

    Movements are summed per product and month before the window, so a product
    has at most one row per month there. Months without movement repeat the
    last level: each row is repeated up to the next one, without a grid of all
    products and months. `spread` may deal the monthly sums by product over more
    tasks, as their rows multiply there.
    """
    month = F.last_day("moved_on")
    monthly = movements.groupBy("product_id", month.alias("month_end")).agg(
        F.sum("quantity").alias("moved")
    )
    monthly = spread(monthly) if spread else monthly
    by_month = Window.partitionBy("product_id").orderBy("month_end")
    final = movements.agg(F.max(month)).scalar()
    run = monthly.select(
        "product_id",
        "month_end",
        F.sum("moved").over(by_month).alias("units_in_stock"),
        F.coalesce(
            F.last_day(F.add_months(F.lead("month_end").over(by_month), -1)), final
        ).alias("_until"),
    )
    months = F.sequence(
        F.trunc("month_end", "month"), F.trunc("_until", "month"), F.expr("interval 1 month")
    )
    return run.select("product_id", F.explode(months).alias("_month"), "units_in_stock").select(
        "product_id", F.last_day("_month").alias("snapshot_day"), "units_in_stock"
    )


def activity_fact(events: DataFrame, employees: DataFrame, territories: DataFrame) -> DataFrame:
    """Factless fact: distinct (day, member, territory). Distinct before the key lookups."""
    seen = events.select("activity_date", "employee_id", "territory_id").distinct()
    return (
        seen.join(employees.select("employee_id", "employee_sk"), "employee_id")
        .join(territories.select("territory_id", "territory_sk"), "territory_id")
        .select(
            date_key(F.col("activity_date")).alias("activity_date_key"),
            "employee_sk", "territory_sk",
        )
    )


def add_activity(target: DataFrame, source: DataFrame) -> DataFrame:
    return insert_only(target, source, ["activity_date_key", "employee_sk", "territory_sk"])


def coverage(activity: DataFrame, bridge: DataFrame, period: Column) -> DataFrame:
    """Share of the assigned pairs that were active, per period.

    The denominator is the number of assigned pairs, the same in every period,
    so the grid of pairs and periods is never built. Days become periods before
    the join, which so sorts one row per pair and period.
    """
    pairs = bridge.select("employee_sk", "territory_sk")
    active = (
        activity.select(period.alias("period"), "employee_sk", "territory_sk").distinct()
        .join(pairs, ["employee_sk", "territory_sk"], "left_semi")
        .groupBy("period")
        .agg(F.count("*").alias("active_pairs"))
    )
    expected = pairs.agg(F.count("*")).scalar()
    return active.withColumn("expected_pairs", expected).withColumn(
        "coverage", F.try_divide(F.col("active_pairs").cast("double"), F.col("expected_pairs"))
    )
