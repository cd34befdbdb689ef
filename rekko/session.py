"""SparkSession helpers: one place for the settings every job relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the engine expects.  On a cluster the launcher usually sets most of
# them; ``get_spark`` only fills in what is missing.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # let AQE coalesce the shuffles inside cached (persisted) plans too
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}


def get_spark(master: str | None = None, app_name: str = "rekko",
              shuffle_partitions: int | None = None,
              extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, creating a local one when none exists."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints and intermediate tables.

    Uses the folder the cluster names in ``spark.checkpoint.dir`` (or one set
    on the context).  Only a local-mode session (tests, laptops) without a
    configured folder gets a fresh temporary one; a cluster session without
    one is an error, because a machine-local folder would not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS, S3, ...) before running multi-stage jobs on a cluster")
    local = tempfile.mkdtemp(prefix="rekko-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def remove_table(spark: SparkSession, path: str) -> bool:
    """Delete a table that a job wrote for itself below the checkpoint folder; False where none is there."""
    if not path.startswith(checkpoint_dir(spark)):
        raise ValueError(f"not below the checkpoint folder: {path}")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
