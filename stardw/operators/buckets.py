"""A table of latest rows in hash buckets, of which a batch of changes rewrites only those it touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from stardw.sources.manifest import Manifest, manifests, newest, read_live, rows_by, switch
from stardw.sources.writers import by_period

from .incremental import apply_changes
from .merge import current_state

BUCKETS = 256
_BUCKET = "_bucket"


def state_schema(events: StructType) -> StructType:
    """What is stored of events: their columns and whether the key is deleted."""
    return StructType([*events.fields, StructField("is_deleted", BooleanType())])


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def apply_batch(
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    is_delete: Column,
    label: str,
    buckets: int = BUCKETS,
) -> bool:
    """Work a batch of ordered changes into the table at `path`; False if `label` is there already.

    Rows of a key are in one bucket, by its hash. Only the buckets of the
    batch are read, merged and written, to folders of their own; the manifest that
    follows names these and the old folders of all other buckets. So the bytes of a
    batch follow the batch, up to the size of its buckets, and a batch that broke
    off leaves the table as it was and is simply applied again. A label that a kept
    manifest carries is a batch that comes a second time. The number of buckets
    is that of the first batch; give one that keeps a bucket at some hundred MB.
    """
    spark = batch.sparkSession
    kept = manifests(spark, path)
    if any(label == m.label.partition("|")[2] for m in kept):
        return False
    last = kept[-1] if kept else Manifest()
    if kept:
        buckets = int(last.label.partition("|")[0])
    schema = state_schema(batch.schema)
    number = last.number + 1
    touched = [str(r[0]) for r in batch.select(bucket_of(keys, buckets)).distinct().collect()]  # `buckets` at most
    before = read_live(spark, path, schema, touched, last)
    after = current_state(apply_changes(before, batch, keys, order_by, is_delete))
    folder = f"data/load={number}"
    (
        by_period(after.withColumn(_BUCKET, bucket_of(keys, buckets)), _BUCKET)
        .write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{path}/{folder}")
    )
    counts = {}
    if touched:
        written = spark.read.schema(StructType([*schema.fields])).option("basePath", f"{path}/{folder}")
        counts = rows_by(written.parquet(f"{path}/{folder}").withColumn(_BUCKET, bucket_of(keys, buckets)), _BUCKET)
    pieces = {p: f for p, f in last.pieces.items() if p not in set(touched)}
    pieces |= {p: (f"{folder}/{_BUCKET}={p}", n) for p, n in counts.items()}
    switch(spark, path, Manifest(number, f"{buckets}|{label}", pieces))
    return True


def state(spark: SparkSession, path: str, events: StructType) -> DataFrame:
    """The table with deleted keys marked; `incremental.live` leaves them out."""
    return read_live(spark, path, state_schema(events), manifest=newest(spark, path))
