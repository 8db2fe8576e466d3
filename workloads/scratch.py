"""Where queries that write and read back put their files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder; a local one only where none is set and all runs on one machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{shared or tempfile.mkdtemp(prefix='run-')}/{uuid.uuid4().hex}"
