"""What the operators share: tables in the shared folder, and columns nobody else has."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.session import TASK_BYTES, scratch_path

# A task takes texts into Python a few at a time, so a batch of very long ones stays small.
BATCH_BYTES = 8 * 1024 * 1024


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder.

    It cuts the lineage, survives lost executors, and Spark knows the size of what it rereads.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` is called that."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def dealt(df: DataFrame, total: int, *keys: str) -> DataFrame:
    """`df`, of some `total` bytes, by `keys` over as many tasks as bound what each of them reads.

    Groups that enter Python cannot be split after a shuffle. So where the session has too few
    partitions for these bytes they are dealt out beforehand, and grouping moves nothing again;
    otherwise the session's number stands, and Spark joins small ones.
    """
    tasks = total // TASK_BYTES + 1
    if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(tasks, *keys)


def slices(
    batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that `column` (of text) holds `most` bytes in each, or is one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)
