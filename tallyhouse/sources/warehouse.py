"""Day-partitioned Parquet tables."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyhouse.sinks.publish import swap_is_open, version_folders, what_counts


def _scan(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    """The files that count below `path`, a table or a version of one."""

    def reader():
        return spark.read if schema is None else spark.read.schema(schema)

    folders = version_folders(spark, path)
    if folders is None:
        counted = what_counts(spark, path)
        df = reader().parquet(path)
        if counted is None and (counted := what_counts(spark, path)):
            # The first delivery began while the files were listed.
            df = reader().parquet(path)
        return counted(df) if counted else df
    scans = [reader().option("basePath", base).parquet(*days) for base, days in folders.items()]
    if not scans:
        return spark.createDataFrame([], schema or T.StructType())
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table with its declared columns in order; an absent table is empty.

    `path` may also be a version of a table. Appends that have not ended are left out. A
    table whose replacement is under way or was cut off is an error, not empty:
    `restore_interrupted` brings it back.
    """
    if swap_is_open(spark, path):
        raise RuntimeError(f"a replacement of {path} is not finished; see restore_interrupted")
    try:
        df = _scan(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return df.select(*schema.fieldNames())


def discover_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as its files and directories describe it, partitions last."""
    df = _scan(spark, path, None)
    return df.drop("write") if version_folders(spark, path) is not None else df
