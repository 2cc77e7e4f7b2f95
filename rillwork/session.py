"""Session set-up and the shared folder that jobs write intermediate data to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rillwork")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder; a cluster
    without it is an error, because a machine-local folder would be lost with
    its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="rillwork-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read it from there afterwards."""
    shared_root(df.sparkSession)
    return df.checkpoint()
