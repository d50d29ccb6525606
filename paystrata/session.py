"""Session settings and the shared folder for derived tables."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

MIB = 1024 * 1024
# More shuffle partitions than this cost more in blocks and bookkeeping than they save.
MOST_PARTITIONS = 20_000
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
STATE_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Derived tables are written once and are large: smaller files for some more work.
TABLE_OPTIONS = {"compression": "zstd"}
SCAN_BYTES = "spark.sql.files.maxPartitionBytes"
_local_folders: dict[str, str] = {}


def scale_conf(input_bytes: int, cores: int, partition_bytes: int = 128 * MIB) -> dict[str, str]:
    """Settings that keep a shuffle partition near ``partition_bytes``.

    Adaptive execution can merge partitions but cannot make more of them than
    the plan starts with, so the starting number follows the input size, up to
    ``MOST_PARTITIONS``; beyond that the partitions grow.
    """
    partitions = max(cores, min(MOST_PARTITIONS, math.ceil(input_bytes / partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        STATE_STORE: STATE_ON_DISK,
    }


def build_session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """A session without a fixed master: the submitter names it."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bytes_at(spark: SparkSession, path: str) -> int:
    """Bytes stored below a path of any file system; 0 where there is none."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(context._jsc.hadoopConfiguration())
    return system.getContentSummary(place).getLength() if system.exists(place) else 0


def apply_scale(spark: SparkSession, input_bytes: int) -> None:
    """``scale_conf`` on a running session; what the submitter has set stays.

    With an input of unknown size (0) the session's own partition number stays too.
    """
    given = spark.sparkContext.getConf()
    for key, value in scale_conf(input_bytes, spark.sparkContext.defaultParallelism).items():
        unknown = key == "spark.sql.shuffle.partitions" and not input_bytes
        if not given.contains(key) and not unknown:
            spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one named in ``spark.checkpoint.dir``. Only a local master may go
    without that setting; it then gets one temporary folder per application.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = context.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="paystrata-")
    return _local_folders[application]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/paystrata/{purpose}-{uuid.uuid4().hex}"


def _scan_bytes(spark: SparkSession, stored: int, size_bytes: int, task_bytes: int) -> int:
    """Stored bytes of about ``task_bytes`` of rows; the session's own limit where it is lower."""
    parsed = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    own = parsed(spark.conf.get(SCAN_BYTES))
    return min(own, max(MIB, stored * task_bytes // max(1, size_bytes)))


@contextmanager
def scans_of(
    spark: SparkSession, stored: int, size_bytes: int, task_bytes: int = 128 * MIB
) -> Iterator[None]:
    """Jobs run within read ``task_bytes`` of rows in a task, as they are in memory.

    By itself Spark counts stored bytes, and rows that are ``stored`` small, of ``size_bytes``,
    then fill a task that shuffles or sorts them until it spills. The session's own limit
    stays where it is lower.
    """
    before = spark.conf.get(SCAN_BYTES, None)
    spark.conf.set(SCAN_BYTES, _scan_bytes(spark, stored, size_bytes, task_bytes))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SCAN_BYTES)
        else:
            spark.conf.set(SCAN_BYTES, before)


def scan_session(
    spark: SparkSession, stored: int, size_bytes: int, task_bytes: int = 128 * MIB
) -> SparkSession:
    """A session like this one whose reads are cut as ``scans_of`` cuts them, whenever they run.

    For frames that are handed on: a read keeps the scan size of the session that made it.
    """
    sibling = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if sibling.conf.isModifiable(key):
            sibling.conf.set(key, value)
    sibling.conf.set(SCAN_BYTES, _scan_bytes(spark, stored, size_bytes, task_bytes))
    return sibling


def partitions_for(spark: SparkSession, size_bytes: int, partition_bytes: int = 128 * MIB) -> int:
    """Write tasks for ``size_bytes``: one per core, more for large and fewer for tiny inputs."""
    worthwhile = math.ceil(size_bytes / (MIB // 4))
    per_core = min(spark.sparkContext.defaultParallelism, worthwhile)
    return max(1, per_core, min(MOST_PARTITIONS, math.ceil(size_bytes / partition_bytes)))
