"""Junk dimension: low-cardinality flags of a sale under one key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stardw.functions import discount_band, ship_mode, surrogate_key

# The domain of each flag.
DISCOUNT_BANDS = ["None", "Low", "Medium", "High"]
HIGH_VALUE = [False, True]
SHIP_MODES = ["Express", "Standard", "Economy"]
HIGH_VALUE_ABOVE = 1000

FLAGS = ["discount_band", "is_high_value", "ship_mode"]


def flags_dimension(spark: SparkSession) -> DataFrame:
    """Every combination of the flag domains, with its key."""
    def each(values, name):
        return F.explode(F.array(*[F.lit(v) for v in values])).alias(name)

    combos = (
        spark.range(1)
        .select(each(DISCOUNT_BANDS, "discount_band"))
        .select("*", each(HIGH_VALUE, "is_high_value"))
        .select("*", each(SHIP_MODES, "ship_mode"))
    )
    return combos.select(flag_key().alias("order_flags_sk"), *FLAGS)


def flag_key() -> Column:
    return surrogate_key(*FLAGS)


def with_flags(
    facts: DataFrame, discount: str = "discount", net: str = "net", code: str = "ship_via"
) -> DataFrame:
    """Derive the flag columns of each fact."""
    return facts.withColumns(
        {
            "discount_band": discount_band(F.col(discount)),
            "is_high_value": F.col(net) > HIGH_VALUE_ABOVE,
            "ship_mode": ship_mode(F.col(code)),
        }
    )


def assign_flags(facts: DataFrame, flags: DataFrame, only_missing: bool = False) -> DataFrame:
    """Set the flag key of each fact, or only of those without one.

    `flags` is the flag dimension, bounded by the product of the flag domains.
    """
    keyed = with_flags(facts.drop("order_flags_sk")) if not only_missing else with_flags(facts)
    dim = F.broadcast(flags.select(*FLAGS, F.col("order_flags_sk").alias("_sk")))
    joined = keyed.join(dim, FLAGS, "left")
    sk = F.coalesce("order_flags_sk", "_sk") if only_missing else F.col("_sk")
    return joined.withColumn("order_flags_sk", sk).drop("_sk", *FLAGS)


def grow_flags(flags: DataFrame, facts: DataFrame) -> DataFrame:
    """Flag dimension that grows: add the combinations seen in the facts only."""
    seen = with_flags(facts).select(*FLAGS).distinct()
    new = seen.join(F.broadcast(flags.select(*FLAGS)), FLAGS, "left_anti")
    return flags.unionByName(new.select(flag_key().alias("order_flags_sk"), *FLAGS))
