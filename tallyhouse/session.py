"""Session settings, the session's time zone, and the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# What the plans in this package count on. AQE sizes shuffles from what the map
# side really wrote, splits a skewed join partition or a day that holds a large
# share of the rows, and turns a sorted join into a broadcast once a side proves
# small, or into a hashed one once every partition of a side does.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128m",
}


# How tables are stored: timestamps with statistics, which the old 96-bit form
# lacks, and files about a third smaller than by default.
TABLE_SETTINGS = {
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(app_name: str = "tallyhouse", **settings: str) -> SparkSession:
    """A session with this module's settings, then the caller's."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **TABLE_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def child_session(spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    """A session of its own with the caller's settings and then `settings`.

    Two runs that overlap each have one, so neither sees what the other has set,
    and the caller's session is never touched.
    """
    made = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if made.conf.isModifiable(key):
            made.conf.set(key, value)
    return made


def for_tables(spark: SparkSession, zone: str = "UTC") -> SparkSession:
    """A session that writes tables as `TABLE_SETTINGS` say, and reads times in `zone`.

    Both feeds write local times without a zone, and the day a row belongs to
    follows from it: the same file read under two zones gives different rows.
    """
    return child_session(spark, {**TABLE_SETTINGS, "spark.sql.session.timeZone": zone})


# What one task should take of a shuffle.
TASK_BYTES = 128 * 1024 * 1024


def size_shuffles(own: SparkSession, caller: SparkSession, read: int) -> None:
    """Give a run's own session shuffle partitions for a plan that reads `read` bytes.

    AQE joins small shuffle partitions and splits skewed ones, but cannot split
    those of an aggregate that are all too large, so there must be enough of
    them to begin with. The number follows from what this plan reads and is
    never less than the caller's.
    """
    name = "spark.sql.shuffle.partitions"
    own.conf.set(name, str(max(int(caller.conf.get(name)), -(-read // TASK_BYTES))))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as `spark.checkpoint.dir` names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, removed when the application ends."""
    path = f"{shared_folder(spark)}/tallyhouse-{uuid.uuid4().hex}/{name}"
    parent = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    fs = parent.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(parent)
    fs.deleteOnExit(parent)
    return path


def snapshot(df: DataFrame) -> DataFrame:
    """`df` as it is now, kept in the shared folder and cut from its sources.

    Use the returned DataFrame: the one passed in still reads its old files. The copy is
    a table, so it outlives executors, and Spark knows its size when it plans with it. It
    goes when the application ends.
    """
    path = scratch_path(df.sparkSession, "snapshot")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
