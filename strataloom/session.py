"""Session settings and the shared folder that written tables live in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "strataloom", shuffle_partitions: int | None = None) -> SparkSession:
    """Create a session; leave `master` and the partition count to the cluster unless given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split hot join partitions even where that costs one more exchange.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # Let a join decide which folders of a fact are read even if its other side is too large to broadcast.
        .config("spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Pin the one setting that changes results: the session time zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def new_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder so that lost executors cannot change it."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
