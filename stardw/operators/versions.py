"""Versioned publication of a table and the log of its loads.

A version is a folder `version=n` of plain Parquet under the table path. The
data is written first and the log row last, so a version that is in the log is
complete; a failed write leaves a folder nothing refers to. One writer per
table at a time.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "version int, load_ts timestamp, operation string, rows bigint"


def publish(
    df: DataFrame, path: str, version: int, load_ts: datetime, operation: str
) -> None:
    """Write version `version` of the table; repeating a failed call is safe."""
    spark = df.sparkSession
    folder = f"{path}/data/version={version}"
    df.write.mode("overwrite").parquet(folder)
    entry = spark.read.parquet(folder).agg(
        F.lit(version).alias("version"),
        F.lit(load_ts).cast("timestamp").alias("load_ts"),
        F.lit(operation).alias("operation"),
        F.count("*").alias("rows"),
    )
    entry.coalesce(1).write.mode("overwrite").parquet(f"{path}/log/entry={version}")


def history(spark: SparkSession, path: str) -> DataFrame:
    """One row per published version."""
    return spark.read.schema(LOG).option("recursiveFileLookup", True).parquet(f"{path}/log")


def any_version(spark: SparkSession, path: str) -> bool:
    """Whether a version has been published."""
    try:
        return not history(spark, path).isEmpty()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def read_version(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/data/version={version}")


def latest_version(spark: SparkSession, path: str, not_after: datetime | None = None) -> int:
    """Highest version in the log, or the highest one loaded by `not_after`."""
    log = history(spark, path)
    if not_after is not None:
        log = log.filter(F.col("load_ts") <= F.lit(not_after).cast("timestamp"))
    found = log.agg(F.max("version")).first()[0]  # one row of a log, not data
    if found is None:
        raise LookupError(f"no version of {path} by {not_after}")
    return found


def read_as_of(spark: SparkSession, path: str, moment: datetime) -> DataFrame:
    return read_version(spark, path, latest_version(spark, path, moment))


def difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows only in one of two versions, marked removed or added; copies count."""
    cols = old.columns
    same = new.select(*cols)
    gone = old.exceptAll(same).withColumn("change", F.lit("removed"))
    come = same.exceptAll(old).withColumn("change", F.lit("added"))
    return gone.unionByName(come)


def restore(
    spark: SparkSession, path: str, version: int, load_ts: datetime
) -> int:
    """Publish an earlier version again as the newest one."""
    newest = latest_version(spark, path) + 1
    publish(read_version(spark, path, version), path, newest, load_ts, f"restore {version}")
    return newest
