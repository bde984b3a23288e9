"""Continuous forms of the incremental loads.

Both take a streaming frame and run with a checkpoint: after a lost driver the
same batch comes again with the same number, and both sinks replace what that
batch wrote before instead of adding to it. What a batch wrote is known by the
checkpoint and the number together, so that a second stream into one path, or
one that starts anew with another checkpoint, adds to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from stardw.operators.buckets import BUCKETS, apply_batch


def stream_name(checkpoint: str) -> str:
    """What a stream's batches are filed under: a hash of its checkpoint folder."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def stream_append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Load new files as they arrive, one folder per stream and batch."""
    name = stream_name(checkpoint)

    def load(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/stream={name}/batch={number}")

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_changes(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    is_delete: Column,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Apply change events batch by batch to a table in hash buckets (`buckets.state` reads it).

    A batch rewrites the buckets of its keys only. One that comes again after it
    was published is passed over; one that broke off before is applied from the
    state in which it began. One stream at a time may run on a path.
    """
    name = stream_name(checkpoint)

    def apply(batch: DataFrame, number: int) -> None:
        apply_batch(path, batch, keys, order_by, is_delete, f"batch {number} of {name}", buckets)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
