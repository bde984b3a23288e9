"""Session settings for tests and benchmarks, and the shared working folder.

On a cluster the session comes from outside; the library never sets options
on a session it did not build.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_base: str | None = None


def local_session(cores: str = "8", app: str = "stardw") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables under ``spark.checkpoint.dir``.

    Every executor must see that folder, so on a cluster the setting is
    required; a machine-local folder is used only by a local master.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="stardw-")
        base = _local_base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
