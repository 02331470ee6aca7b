"""Session construction and the shared checkpoint folder.

The caller normally owns the session (on a cluster it comes from
``spark-submit``).  ``build_session`` is for tests, the bench and local runs:
it keeps the UI off, turns AQE on and pins the session time zone to UTC.

``checkpoint_root`` returns the shared folder named by ``spark.checkpoint.dir``
(the cluster sets it).  Only when it is unset -- as in local tests -- do we
create a scratch folder and register it.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

#: scratch tables written by this process and not yet dropped
_SCRATCH: list[str] = []

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a third of all rows may sit on one key: let AQE split oversized partitions
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove Dataset.checkpoint() files once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "reelpath", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the engine defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    conf["spark.driver.memory"] = os.environ.get("REELPATH_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and table bundles.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Where
    neither is set a local scratch folder is made, on a local master only: on a
    cluster the executors would each write to a disk of their own."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        root = tempfile.mkdtemp(prefix="reelpath-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder, for tables that
    outlive a call; :func:`drop_scratch` removes what a session wrote there."""
    path = f"{checkpoint_root(spark).rstrip('/')}/reelpath/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete scratch tables (all of this session's by default); returns how many."""
    gone = 0
    for path in list(_SCRATCH if paths is None else paths):
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
        gone += bool(fs.delete(where, True))
        if path in _SCRATCH:
            _SCRATCH.remove(path)
    return gone


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 * 1024 ** 2,
                 min_partitions: int = 200) -> dict[str, str]:
    """Shuffle sizing for a cluster run over ``input_bytes`` of Parquet.

    The initial shuffle partition count is chosen so a partition of the
    widest shuffle (at most the input) holds about ``target_partition_bytes``;
    AQE then coalesces small partitions and splits skewed ones.  For 100 TB and
    256 MB this gives ~400k initial partitions, coalesced at run time to the
    advisory 128 MB."""
    n = max(min_partitions, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "128m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
