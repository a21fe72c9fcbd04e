"""Session construction and shared-folder resolution.

Everything that must survive an executor loss is written under the folder the
cluster names in ``spark.checkpoint.dir``; we only set one when it is unset
(tests, laptops).
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings a production job wants regardless of size; shuffle partitions are
# sized by the caller (local tests: cores; cluster: ~input_bytes / 128 MiB).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Planner-side size check for dimensions we do not hint: anything the
    # optimizer estimates below this is broadcast, anything above is joined by
    # shuffle (sort-merge / shuffled hash).  AQE re-checks with runtime sizes.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "ledgerlake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        # A machine-local folder is shared only if there is one machine.
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerlake/{purpose}/{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, purpose: str = "") -> bool:
    """Delete the scratch tables of this application (of one purpose, or all) once no result that reads them is needed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerlake/{purpose}".rstrip("/"))
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes begun within remove their shuffle files when they end.  Otherwise the files stay until the driver's garbage
    collector finds their plan, and those of many large writes add up.  It is a setting of the session: not for threads."""
    was = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, was)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that must touch the local filesystem."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path
