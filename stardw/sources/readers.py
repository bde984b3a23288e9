"""Sources: CSV, Parquet, JDBC, literal rows and day series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    multi_line: bool = False,
    trim: Sequence[str] = (),
    cut: Mapping[str, int] | None = None,
    load_ts: datetime | None = None,
) -> DataFrame:
    """Header CSV held to a contract, read in one pass without inference.

    Fields are read as text and cast afterwards, so a bad value gives NULL in
    its own column and the row stays. `multi_line` is for files with line
    breaks inside quotes; such a file cannot be split, so it is off by default.
    `trim` removes padding on the right; `cut` shortens long texts.
    """
    cut = cut or {}
    as_text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    raw = (
        spark.read.schema(as_text)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )

    def clean(field: StructField) -> Column:
        col = F.col(field.name)
        if field.name in trim:
            col = F.rtrim(col)
        if field.name in cut:
            col = F.substring(col, 1, cut[field.name])
        return col.try_cast(field.dataType).alias(field.name)

    return stamped(raw.select(*[clean(f) for f in schema.fields]), load_ts)


def stamped(df: DataFrame, load_ts: datetime | None) -> DataFrame:
    """Add one load timestamp for the whole load."""
    if load_ts is None:
        return df.withColumn("load_ts", F.current_timestamp())
    return df.withColumn("load_ts", F.lit(load_ts))


def read_table(
    spark: SparkSession, path: str, columns: Mapping[str, str] | None = None
) -> DataFrame:
    """Parquet table, projected to `columns` (source name -> own name)."""
    df = spark.read.parquet(path)
    return df if columns is None else projected(df, columns)


def projected(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Select columns under own names (source name -> own name)."""
    return df.select(*[F.col(f"`{source}`").alias(own) for source, own in columns.items()])


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Mapping[str, str],
    split_column: str,
    lower: int,
    upper: int,
    partitions: int,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Table of a source database, read in parallel ranges of `split_column`.

    Needs the driver of that database on the class path.
    """
    df = (
        spark.read.format("jdbc")
        .options(**(options or {}))
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", split_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )
    return projected(df, columns)


def rows(spark: SparkSession, values: Sequence[tuple], ddl: str) -> DataFrame:
    """A few literal rows with a declared schema."""
    return spark.createDataFrame(values, ddl)


def date_series(
    spark: SparkSession, start: date | Column, end: date | Column, name: str = "day"
) -> DataFrame:
    """One row per day, both ends included."""
    lo = start if isinstance(start, Column) else F.lit(start)
    hi = end if isinstance(end, Column) else F.lit(end)
    return spark.range(1).select(
        F.explode(F.sequence(lo, hi, F.expr("interval 1 day"))).alias(name)
    )
