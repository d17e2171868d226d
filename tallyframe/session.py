"""Session construction and cluster-wide settings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings every query in this package relies on.  Adaptive execution
# re-plans joins from runtime sizes, coalesces small shuffle partitions and
# splits skewed ones; the session time zone pins timestamp arithmetic.
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tallyframe", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the package's base settings.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them unset so the submit-time configuration wins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    submitted = SparkConf()  # what spark-submit and spark-defaults.conf set
    for key, value in _BASE_CONF.items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a folder every executor can reach and is
    used as is.  Only a local master may leave it unset: a fresh scratch
    folder is then created for this process.  Any other master without the
    setting raises, since a node's own disk is lost with the node.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # e.g. a remote (Connect) session: the server owns the setting
        return configured
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tallyframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", configured)
        except Exception:  # some deployments refuse runtime changes of core settings
            pass
    try:
        already = sc._jsc.sc().getCheckpointDir().isDefined()
    except Exception:
        already = False
    if not already:  # each call would otherwise open a new sub-folder
        sc.setCheckpointDir(configured)
    return configured


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, gone when the application ends."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(where)  # only what exists is marked for deletion
    fs.deleteOnExit(where)
    return path


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of parquet.

    - scan splits and post-shuffle partitions target ``partition_bytes`` so a
      task's sort / aggregation buffer fits executor memory (spill otherwise);
    - the shuffle partition count is an upper bound sized for the largest
      shuffle (about the input size); AQE coalesces small partitions at run
      time and splits skewed ones (a hot key holding a third of the rows is
      cut into advisory-size pieces on the sort-merge join side);
    - the broadcast threshold is a checked size: AQE broadcasts a join side
      only when its measured runtime size is below it, and sort-merges otherwise.
    Pass the result as ``extra`` to ``get_session`` or as spark-submit ``--conf``.
    """
    parts = max(total_cores * 2, -(-input_bytes // partition_bytes))
    mb = f"{partition_bytes >> 20}m"
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": mb,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": mb,
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{(partition_bytes * 2) >> 20}m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.parquet.aggregatePushdown": "true",
    }
