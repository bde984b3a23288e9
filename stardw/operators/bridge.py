"""Many-to-many bridge between members and territories."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def load_bridge(pairs: DataFrame, employees: DataFrame, territories: DataFrame) -> DataFrame:
    """Distinct surrogate key pairs of the source pairs."""
    return (
        pairs.join(employees.select("employee_id", "employee_sk"), "employee_id")
        .join(territories.select("territory_id", "territory_sk"), "territory_id")
        .select("employee_sk", "territory_sk")
        .distinct()
    )


def with_weight(bridge: DataFrame) -> DataFrame:
    """Add weight 1/n per member, so that weighted sums do not count a sale twice.

    `parts` is n itself, for exact division of a sum by the number of shares.
    """
    per_member = Window.partitionBy("employee_sk")
    parts = F.count("*").over(per_member)
    return bridge.withColumn("parts", parts).withColumn(
        "weight", F.lit(1.0) / F.col("parts")
    )


def through_bridge(per_member: DataFrame, bridge: DataFrame) -> DataFrame:
    """Fan out member totals to their territories.

    Takes totals per member, not facts: the fan-out then grows with members
    and territories and not with sales.
    """
    return per_member.join(bridge, "employee_sk")


def never_active(bridge: DataFrame, activity: DataFrame, on: list[str]) -> DataFrame:
    """Assigned pairs without any activity."""
    return bridge.join(activity.select(*on), on, "left_anti")
