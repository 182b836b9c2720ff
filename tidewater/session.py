"""Session helpers.

The library never creates its own cluster settings in library code paths; it only
builds a local session for tests and the bench, and reads shared settings such as
``spark.checkpoint.dir`` from whatever session the caller hands in.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every local run uses. On a cluster these come from the deployment.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of frames that are gone are removed (pinned copies are per query)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Scans read only the columns a plan touches; the files are small row groups.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidewater") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TIDEWATER_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Only a local-mode session without
    it (a bare test session) gets a private folder; on a cluster a machine-local folder
    would not survive the loss of an executor, so the setting is required there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
        configured = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows that one task is given; the working set of a row (tree points, hash tables) is some hundred bytes.
TASK_ROWS = 1 << 17
#: Tasks for each core up to which small frames may be cut (Spark's tuning guide: two or three).
TASKS_PER_CORE = 3


def tasks_for(rows: int, per_task: int | None = None) -> int:
    """How many tasks ``rows`` rows are cut into, so that a task's share does not grow with the input."""
    return max(1, -(-rows // (per_task or TASK_ROWS)))


def sized(df: DataFrame, *keys: str, per_task: int | None = None, all_cores: bool = False) -> DataFrame:
    """``df`` (a scan or a pinned frame: it is counted) in partitions that hold ``per_task`` rows or so at most.

    Too few partitions (with ``all_cores`` also for the cores, as long as each gets a sixteenth of a full task) are cut
    by hash of ``keys``, by turns without. More than both the rows and the cores need are put together, since each step of a tree fit
    sends its statistics once per partition. Others stay as they are.
    """
    per_task = per_task or TASK_ROWS
    cores = df.sparkSession.sparkContext.defaultParallelism
    have, rows = df.rdd.getNumPartitions(), df.count()
    wanted = tasks_for(rows, per_task)
    if all_cores:
        wanted = max(wanted, min(cores, tasks_for(rows, max(1, per_task // 16))))
    if have < wanted:
        return df.repartition(wanted, *keys)
    most = max(wanted, TASKS_PER_CORE * cores)
    return df.coalesce(most) if have > most else df
