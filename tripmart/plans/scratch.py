"""A folder that driver and executors share, for what a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the one that spark.checkpoint.dir names.  A local
    session may do without; on a cluster there is no other place that all see."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="scratch-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
