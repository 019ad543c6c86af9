"""Delimited text with a header line."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyhouse.operators.project import keep
from tallyhouse.schemas import FEED_TIMESTAMP, Feed

# Holds the text of a line with a cell that is not of its declared type.
RAW_LINE = "_raw_line"

# The name Spark's reader gives a column whose header is blank.
_BLANK = re.compile(r"_c\d+")


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None,
    sep: str = ",",
    timestamps: str = FEED_TIMESTAMP,
    raw_line: bool = False,
) -> DataFrame:
    """Read files of one declared shape.

    Each file's header is checked against `schema`, so a file with its columns
    in another order fails instead of loading into the wrong ones. Columns with
    a blank header are listed in `schema` as `_c0`, `_c2`, ... after their
    position; they are skipped by the parser and absent from the result. A cell
    that is not of its type becomes NULL; `raw_line` then adds the line's text.

    With `schema=None` types are inferred, at the price of another pass over
    the files, and one bad cell turns its column into text.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("timestampFormat", timestamps)
        .option("timestampNTZFormat", timestamps)
    )
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    named = [f.name for f in schema.fields if not _BLANK.fullmatch(f.name)]
    if raw_line:
        schema = T.StructType([*schema.fields, T.StructField(RAW_LINE, T.StringType())])
        named.append(RAW_LINE)
        reader = reader.option("columnNameOfCorruptRecord", RAW_LINE)
    return keep(reader.schema(schema).option("enforceSchema", False).csv(path), named)


def read_feed(spark: SparkSession, feed: Feed, path: str) -> DataFrame:
    """Read a feed's files under its own headers, plus the text of bad lines."""
    return read_delimited(spark, path, feed.source_schema, feed.sep, raw_line=True)
