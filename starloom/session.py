"""Session construction and cluster-aware defaults."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive execution re-plans joins from the
# sizes it observes (runtime broadcast, partition coalescing, skew splitting).
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.ansi.enabled": "true",  # a bad cast fails instead of turning to NULL
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # a checkpoint goes when nothing on the driver refers to it any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Sizing for a large cluster (hundreds of executors, ~100 TB inputs).  Start
# with many shuffle partitions and let AQE coalesce them to ~256 MB each, so a
# shuffle of tens of TB never builds multi-GB partitions that spill; read
# files in 512 MB splits; treat a partition as skewed above 1 GB (AQE splits
# it); keep automatic broadcasts small (dimension sides only).
CLUSTER_CONF: dict[str, str] = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(
    master: str | None = "local[*]",
    app_name: str = "starloom",
    shuffle_partitions: int = 8,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master=None`` leaves the master to ``spark-submit`` (cluster runs); pass
    ``conf=CLUSTER_CONF`` there (its shuffle partitions override
    ``shuffle_partitions``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this program wrote and that no DataFrame in use still reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must set it to a shared file system.  Only on a local master,
    where driver and executors are one process, is a fresh temporary folder
    created when it is unset; anywhere else that raises ``ValueError``.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all nodes share")
    local = tempfile.mkdtemp(prefix="starloom-ckpt-")
    sc.setCheckpointDir(local)
    return local
