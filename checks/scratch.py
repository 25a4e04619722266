"""Fresh folders for queries that write files and read them back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def fresh_folder(spark: SparkSession) -> str:
    """A new path in the folder all executors share; a local session without one gets a folder of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="checks-")
    return f"{shared.rstrip('/')}/checks-{uuid.uuid4().hex}"
