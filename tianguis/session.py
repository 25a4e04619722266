"""Session settings the plans assume."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Sizes are targets per task, so they hold whatever the size of the input: AQE
# derives the number of reduce tasks, splits hot join keys and hot output days.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Reduce tasks to start from for a job over ``input_bytes``; AQE merges the small ones.

    Set it as ``spark.sql.shuffle.partitions`` on a cluster: too many is cheap to merge, too
    few means partitions that spill. 100 TB gives about 800,000 before pruning; an input cut
    down by partition filters and column selection counts with what is left.
    """
    return max(cores, -(-input_bytes // PARTITION_BYTES))


def local_session(cpus: int | str = "*", **extra: str) -> SparkSession:
    """A single-process session for tests and the bench; a cluster sets its own master."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tianguis")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
