"""Session construction and the shared working folder.

On a cluster the session comes from the platform; ``get_session`` only fills
in settings that are unset.  Scratch tables (upsert staging, lineage cuts,
stream checkpoints) live under ``spark.checkpoint.dir`` read from the session,
never under a machine-local temporary folder.
"""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Defaults for local runs and tests.  On a cluster every one of these is
# normally set by the job submitter and is left untouched here.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Partition sizing for large inputs: scan splits and post-shuffle
    # partitions around 256 MB; AQE coalesces small ones and splits skewed
    # ones (joins and rebalance-hinted writes).
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tickvault", extra: dict | None = None) -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:          # a platform-provided session: keep its settings
        configure(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Settings the operators rely on.

    The session zone must be UTC: all timestamps are zone-less UTC values
    (``timestamp_ntz``) and bucket arithmetic goes through epoch seconds.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static").lower() != "dynamic":
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared scratch root named by ``spark.checkpoint.dir``.

    Read from the session.  Only in local mode (tests, a laptop) and only
    when nothing is configured, a temporary folder is set and written back;
    on a cluster an unset value is an error, because a machine-local folder
    would not survive the loss of an executor."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:            # a setting of the launched session: it cannot be changed, only the context's folder can
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a cluster-shared folder (staging, stream checkpoints)")
        import tempfile
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tickvault-ckpt-"))
        d = spark.sparkContext.getCheckpointDir()
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared scratch root."""
    return f"{shared_dir(spark)}/tickvault/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(module: str) -> None:
    """Send the functions of a module to Python workers by value (needed only
    by operators that run Python on executors, e.g. the ST5 state function):
    the package need not be installed there, and no file is shipped."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def size_shuffle_partitions(spark: SparkSession, paths, target_bytes: int = 256 << 20) -> int:
    """Raise ``spark.sql.shuffle.partitions`` (and AQE's initial partition
    number) to about input bytes / ``target_bytes`` for a large job, so a
    shuffle of the input lands in partitions that fit executor memory; AQE
    then coalesces small ones.  Never lowers an existing setting.  The size
    comes from the file system's content summary (driver-side metadata)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in ([paths] if isinstance(paths, str) else paths):
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            total += fs.getContentSummary(hp).getLength()
    want = max(1, -(-total // target_bytes))
    cur = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    n = max(cur, want)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n
