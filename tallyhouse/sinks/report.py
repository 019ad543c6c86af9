from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tallyhouse.folders import Folder
from tallyhouse.sinks.lease import writing
from tallyhouse.sinks.publish import replace_folder, restore_interrupted


def write_report(
    df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False, **options: str
) -> None:
    """Replace the report at `path`, by default as CSV with a header line.

    The new report is written beside the old one and takes its place when it is
    complete, so a failed write leaves the old one as it was. `single_file` runs
    the last step in one task: ask for it only where the number of rows is
    bounded, as in a top-k. A sorted report is written in order over as many
    files as its size needs, and a small one is one file anyway, since AQE joins
    small partitions.
    """
    spark = df.sparkSession
    if single_file:
        df = df.coalesce(1)
    with writing(spark, path):
        restore_interrupted(spark, path)
        staging = Folder(spark, path).beside(f"staged-{uuid.uuid4().hex}")
        staged = staging.within("report")
        try:
            df.write.format(fmt).options(**{"header": "true", **options}).save(staged.path)
            replace_folder(spark, path, staged)
        finally:
            staging.delete()
