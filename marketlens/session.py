"""Session settings the library relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# UTC makes both timestamp texts of the snapshots comparable; AQE sizes and splits shuffle
# partitions, so no partition count is fixed in the code.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime options the library relies on; sizes stay as the cluster has them."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table, under the folder all executors share.

    The folder is the session's ``spark.checkpoint.dir``. A local temporary folder is used
    only where that is unset and the session runs on this machine alone.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root().name
    return f"{root.rstrip('/')}/marketlens/{label}-{uuid.uuid4().hex}"


@functools.cache
def _local_root() -> tempfile.TemporaryDirectory:
    """A folder for a session in this one process; it goes when the process ends."""
    return tempfile.TemporaryDirectory(prefix="marketlens-")
