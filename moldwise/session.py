"""Session construction and shared-storage helpers."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every moldwise job relies on: UTC for date extraction, AQE for
# runtime coalescing and skew splitting, no web UI.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete reliable-checkpoint files once their DataFrame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "moldwise", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects.

    On a cluster, pass ``master=None`` and let spark-submit decide; locally
    tests pass ``local[*]`` and a small partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, conf[k])
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Directory for reliable checkpoints and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` (shared storage).  Only in
    local mode, when it is unset (tests), a scratch directory is created and
    registered; on a cluster a missing setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
        # a machine-local folder is invisible to other executors and lost with them
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's distributed storage)")
    path = tempfile.mkdtemp(prefix="moldwise-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    try:  # also visible to later readers of the conf; a session may refuse core confs
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # noqa: BLE001
        pass
    return path


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files of the queries built and run inside are removed when a query ends.

    Otherwise they stay until the driver's garbage collector happens on them,
    so a job of many checkpoints needs the disk of all its steps at once.  A
    frame that is run after the block should be built after it.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def reliable_checkpoint(df):
    """Cut lineage with a reliable checkpoint on shared storage (never local)."""
    spark = df.sparkSession
    d = checkpoint_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return df.checkpoint(eager=True)


def stored(df):
    """The rows of ``df`` as a Parquet table in the shared folder: cut off from
    its lineage like a checkpoint, but read back by column."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_bucketed(df, keys, buckets: int | None = None):
    """``df`` as a table in the shared folder, bucketed and sorted by ``keys``, a file a bucket.

    The catalog entry (named after the folder) is the session's; the files
    outlive it.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bucketed_{uuid.uuid4().hex}"
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys) \
        .option("path", f"{checkpoint_dir(spark).rstrip('/')}/{name}").format("parquet").saveAsTable(name)
    return spark.table(name)


def cluster_conf(input_bytes: int, executor_cores: int, executors: int,
                 target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Settings sized for a job reading ``input_bytes`` on a cluster.

    * file splits of ``target_partition_bytes`` (one scan task per split);
    * initial shuffle partitions ~ input / target, at least twice the task
      slots, so a partition of the largest shuffle fits in an executor's
      share of memory; AQE then coalesces the small ones to the advisory size;
    * skew-join splitting for partitions 5x the median and above 1 GB;
    * checkpoints and streaming state go to ``spark.checkpoint.dir``, which
      the cluster must point at shared storage.
    """
    slots = max(executor_cores * executors, 1)
    partitions = max(2 * slots, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
    }
