"""Session settings the jobs rely on, and the shared folder they may write to."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings. Skewed shuffle partitions of a join are split even when that costs one
# more exchange downstream: a single hot person or spell must not become one task.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Files of shuffles go when the query that made them ends, not when the driver's memory is next swept:
    # a run of many writes holds those of one write at a time.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Products hold hashes in hex, which the default codec stores at full length.
    "spark.sql.parquet.compression.codec": "zstd",
}


_local_root: str | None = None


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Only a local session may go without it; there a
    temporary folder is made. On a cluster a missing setting is an error, since a
    machine-local folder would be lost with its machine.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
        _local_root = root = _local_root or tempfile.mkdtemp(prefix="casebook-")
    return f"{root.rstrip('/')}/casebook/{name}-{uuid.uuid4().hex}"
