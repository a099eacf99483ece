"""Session helpers: building a session for local runs and finding the shared
folder for checkpoints and scratch output."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# Applications and folders without a scheme that were found to be shared.
_SHARED: set[tuple[str, str]] = set()


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "isotherm") -> SparkSession:
    """A session for tests and the local benchmark (UI off, UTC, AQE on)."""
    parts = shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("ISOTHERM_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``; that value is used as is.
    On a cluster, a path without a scheme may be a shared mount or each
    machine's own disk when the default file system is ``file:``; it is tried
    once and refused if rows written by tasks do not reach the driver. Only a
    local session without the setting gets a folder of its own.
    """
    sc = spark.sparkContext
    local = sc.master.startswith("local[") or sc.master == "local"
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if configured and not local and "://" not in configured and not configured.startswith("file:"):
        if sc._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:"):
            _try_shared(spark, configured)
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not local:
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; a cluster run needs a shared folder for checkpoints"
        )
    own = tempfile.mkdtemp(prefix="isotherm-ckpt-")
    sc.setCheckpointDir(own)
    _delete_on_exit(spark, own)
    return sc.getCheckpointDir() or own


def _try_shared(spark: SparkSession, folder: str) -> None:
    """Write two small files per core to the folder, once per application, and raise unless every row is read back."""
    tried = (spark.sparkContext.applicationId, folder)
    if tried in _SHARED:
        return
    path = f"{folder.rstrip('/')}/shared-{uuid.uuid4().hex}"
    _delete_on_exit(spark, path)
    rows = 2 * spark.sparkContext.defaultParallelism
    spark.range(0, rows, 1, rows).write.mode("append").parquet(path)
    found = spark.read.schema("id long").parquet(path).count()
    if found != rows:
        raise RuntimeError(f"{CHECKPOINT_CONF}={folder} is not shared: {found} of {rows} rows written by tasks were read back")
    _SHARED.add(tried)


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    """Make the folder now, and have the driver's JVM remove it when it ends."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared checkpoint folder, removed when the session's JVM ends."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    _delete_on_exit(spark, folder)
    return f"{folder}/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable checkpoint).

    Survives executor loss, unlike a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Settings for a large cluster run (set at submit time). Each is a public
# Spark setting; the reasons are in the README ("Cluster settings").
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.files.openCostInBytes": "4m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.ansi.enabled": "true",
}


def cluster_session(app_name: str = "isotherm", extra: dict[str, str] | None = None) -> SparkSession:
    """A session for a cluster: the submit-time master, the settings above as
    defaults (values given at submit time win; ``extra`` wins over both), and
    the cluster's shared checkpoint folder."""
    submitted = SparkConf()  # what spark-submit and spark-defaults.conf set
    builder = SparkSession.builder.appName(app_name)
    for key, value in CLUSTER_CONF.items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark
