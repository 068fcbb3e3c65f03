"""Session settings and the shared checkpoint location."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the engine's plans are written for, the same on a laptop and a
# cluster. AQE re-plans joins and coalesces small shuffle partitions at
# runtime from measured stage sizes; skew-join splits oversized partitions.
# UTC keeps day stamps stable.
# Shuffles start wide, so that TBs of distinct keys from a 100 TB table still
# spread, and AQE merges what a smaller input does not need; a merged
# partition is 64 KB at least, so CPU-heavy stages over a few MB still use
# every core. Scans read 256 MB splits.
# Broadcasts are decided only at runtime: the static planner's size guess
# comes from compressed file sizes and can be several times too small, while
# AQE's threshold applies to the measured output of a finished stage.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "tallycheck",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with the engine settings applied.

    On a cluster, leave ``master`` unset and let spark-submit decide.
    ``shuffle_partitions`` is where shuffles start instead of the default.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in conf.items():
        if not key.startswith("spark.ui") and not key.startswith("spark.driver"):
            try:
                spark.conf.set(key, value)
            except Exception:  # static conf of an already running session
                pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster, from ``spark.checkpoint.dir`` or the context."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured and not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    found = configured or sc.getCheckpointDir()
    if not found:
        raise ValueError("spark.checkpoint.dir is not set")
    return found
