"""Dimension builds: calendar, flattened hierarchy, lookups, roles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.functions import date_attributes, surrogate_key


def date_dimension(days: DataFrame, day: str = "day") -> DataFrame:
    """One row per calendar day with its attributes."""
    return days.select(*date_attributes(F.col(day)))


def as_role(dim: DataFrame, role: str) -> DataFrame:
    """The same dimension under a role: every column gets the prefix `role_`."""
    return dim.select(*[F.col(c).alias(f"{role}_{c}") for c in dim.columns])


def with_parent(df: DataFrame, key: str, parent: str, name: str, out: str) -> DataFrame:
    """Add the name of the direct parent, NULL at the top."""
    parents = df.select(F.col(key).alias("_parent"), F.col(name).alias(out))
    return df.join(parents, F.col(parent) == F.col("_parent"), "left").drop("_parent")


def ordered_list(col: str, separator: str = ", "):
    """Trimmed values in order as one text; a value that occurs twice stands there twice.

    The group must be bounded by a reference table (names of territories of a
    member, not facts of a member), since the text is one value of one row.
    """
    return F.array_join(F.array_sort(F.collect_list(F.trim(col))), separator)


def lookup(
    df: DataFrame, reference: DataFrame, on: str, take: Sequence[str], how: str = "left"
) -> DataFrame:
    """Denormalise: add attributes of a reference table by its key."""
    return df.join(reference.select(on, *take), on, how)


def employee_dimension(
    employees: DataFrame, member_territory: DataFrame, territories: DataFrame
) -> DataFrame:
    """Members with manager, ordered territory list and region.

    A member in several regions gets the smallest region name, so that there
    is always one row per member. Territory names are put together before the
    join: the pairs are reduced to one row per member first.
    """
    per_member = (
        member_territory.join(territories, "territory_id")
        .groupBy("employee_id")
        .agg(
            ordered_list("territory_name").alias("territory_list"),
            F.min("region_name").alias("region_name"),
        )
    )
    named = with_parent(employees, "employee_id", "reports_to", "full_name", "manager_name")
    return named.join(per_member, "employee_id", "left").select(
        surrogate_key("employee_id").alias("employee_sk"),
        "employee_id", "full_name", "reports_to", "manager_name", "territory_list",
        "region_name",
    )


def territory_dimension(territories: DataFrame, regions: DataFrame) -> DataFrame:
    named = lookup(territories, regions, "region_id", ["region_name"])
    return named.select(
        surrogate_key("territory_id").alias("territory_sk"),
        "territory_id",
        F.trim("territory_name").alias("territory_name"),
        F.trim("region_name").alias("region_name"),
    )


def keyed_dimension(df: DataFrame, columns: Sequence[str], key: str, sk: str) -> DataFrame:
    """Distinct members of a lookup with a surrogate key."""
    members = df.select(*columns).distinct()
    return members.select(surrogate_key(key).alias(sk), *columns)


def role_counts(dim: DataFrame, roles: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of a dimension and of its roles, side by side."""
    counted = dim.agg(F.lit("base").alias("role"), F.count("*").alias("rows"))
    for role, frame in roles.items():
        counted = counted.unionByName(
            frame.agg(F.lit(role).alias("role"), F.count("*").alias("rows"))
        )
    return counted
