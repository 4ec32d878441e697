"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Event dates, hours and event ids depend on the zone, so it is pinned.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Sums of money that do not fit raise an error instead of wrapping round.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Do not group in place by a subset of the keys, e.g. by the product of an earlier join:
    # one hot product would then hold up a task that the full key would have spread.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    # A day of event ids outgrows executor memory; this store keeps them on local disk and
    # saves the changes of each micro-batch to the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Recording the Python line of every Column call doubles the time the driver needs to
# describe a wide table; the plan is the same without.
BUILD_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def get_spark(
    app_name: str = "shopstream",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Build (or fetch) a session with the settings the operators expect.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the submit
    command names the first, and adaptive execution shrinks a generous default of
    the second to fit.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SESSION_CONF, **BUILD_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and intermediate tables.

    It is the one named in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors share a disk, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        return current.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):  # not local-cluster, whose executors are processes of their own
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="shopstream-")
    spark.sparkContext.setCheckpointDir(made)
    return (spark.sparkContext.getCheckpointDir() or made).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/shopstream/{app}/{label}-{uuid.uuid4().hex[:12]}"
