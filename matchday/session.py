"""SparkSession construction and cluster-wide settings.

The session is configured for a large cluster first (AQE with partition
coalescing and skew-join splitting, a bounded broadcast threshold, UTC
session time zone); tests and the bench only change master and shuffle
partition count.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from real map-output
# sizes (so a side is only broadcast once its measured size is under the
# threshold), coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # static planner threshold (estimated size) and AQE threshold (measured)
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    # checkpoint files are removed by Spark once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    master: str | None = None,
    app_name: str = "matchday",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with :data:`DEFAULT_CONF` applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system folder and is read
    as is.  Only where it is unset (tests, a laptop) a private scratch folder
    is created and registered, so ``DataFrame.checkpoint()`` works.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a folder that the driver and all executors share"
            )
        # one JVM: the driver's own folder is every task's
        configured = tempfile.mkdtemp(prefix="matchday-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables,
    streams and models of this run; removed when the driver ends."""
    path = checkpoint_dir(spark).rstrip("/") + "/" + name
    _SCRATCH.add(path)
    return path


_SCRATCH: set[str] = set()


#: rows of a task that holds a hash table or a sort of them (:func:`spread`)
TASK_ROWS = 400_000


def task_count(df) -> int:
    """Number of tasks of about ``TASK_ROWS`` rows each that ``df`` asks for.
    The rows are counted: give a scan, whose files know their row counts."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))


def spread(df, *keys, tasks: int | None = None):
    """``df`` dealt by ``keys`` to tasks of about ``TASK_ROWS`` rows.  For
    aggregates by (nearly) unique keys: a partial aggregate before the
    shuffle would hold a whole file split in memory and merge nothing, and
    after it AQE would merge partitions up to its advisory size, which for
    rows that compress well is a hundred times as much in a hash table.  A
    number of partitions that is given stays as it is.  ``tasks`` when
    several tables are dealt alike."""
    return df.repartition(task_count(df) if tasks is None else tasks, *keys)


def materialize(df):
    """Parquet table in the shared checkpoint folder: computed once, read
    back by later branches with column pruning, filters and statistics; its
    lineage is cut (a lost executor re-reads the files instead of recomputing
    the upstream plan).  The table goes when the driver ends.  Used where one
    derived table feeds several branches."""
    return written(df)[0]


def written(df):
    """:func:`materialize`, and the table's folder for :func:`discard`."""
    spark = df.sparkSession
    path = scratch_path(spark, f"table-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Removes a written table that nothing reads any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    _SCRATCH.discard(path)


@atexit.register
def _drop_scratch() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    for path in _SCRATCH:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
