"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the job relies on; pass them to the session builder or spark-submit.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A map task that is run again after a lost executor and yields other rows
    # makes Spark redo the stages that already read its first output.
    "spark.sql.shuffle.orderIndependentChecksum.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch": "true",
}


def build_session(app_name: str = "tallyhouse") -> SparkSession:
    """A session for spark-submit: master and resources come from the launcher."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Dates and hours are taken in the session's zone; in any other they would be off."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "+00:00", "Z"):
        raise RuntimeError(f"the session time zone is {zone}: set spark.sql.session.timeZone to UTC")


def require_ansi(spark: SparkSession) -> None:
    """Without ANSI arithmetic an overflowing sum wraps around and yields a wrong total."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise RuntimeError("set spark.sql.ansi.enabled to true: sums of money must not wrap around")


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_PARTITION_BYTES = 256 << 20
UNKNOWN_BYTES = 1 << 62  # Spark's stand-in for "size not known" is the largest bigint


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables ``df`` reads, as the optimizer knows them; starts no job.

    An input of unknown size, such as rows sent from the driver, counts as nothing.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


def size_shuffles(df: DataFrame) -> int:
    """Let the number of shuffle partitions grow with the input of ``df``.

    Adaptive execution merges partitions that turn out small but never splits large
    ones, so the count it starts from has to suit the data: one partition per 256 MB
    read, and at least the session's own setting. Call it before an action; it holds for
    the session until it is called again. Returns the count.
    """
    spark = df.sparkSession
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-input_bytes(df) // SHUFFLE_PARTITION_BYTES)
    if wanted > floor:
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
        return wanted
    spark.conf.unset(INITIAL_PARTITIONS)
    return floor


@contextmanager
def sized_shuffles(df: DataFrame) -> Iterator[int]:
    """``size_shuffles`` for one action; the session gets its own setting back."""
    spark = df.sparkSession
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    try:
        yield size_shuffles(df)
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables, reachable from every executor.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, whose
    executors share this machine, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    active = spark.sparkContext.getCheckpointDir()
    if active:
        return active.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tallyhouse-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table, below a folder of this application.

    The folder goes when the driver's JVM ends, with whatever was not dropped before.
    """
    folder = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"
    file_system, path = hadoop_path(spark, folder)
    file_system.mkdirs(path)
    file_system.deleteOnExit(path)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, uri: str):
    """The file system that holds ``uri``, and its path object."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path
