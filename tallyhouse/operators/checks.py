"""Checks on schemas, keys and whole tables, all done where the data is."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.project import fresh


def schema_diff(
    left: T.StructType, right: T.StructType, nullable: bool = False, ordered: bool = True
) -> list[str]:
    """What sets two schemas apart, one line each; empty when they agree."""

    def described(field: T.StructField) -> str:
        text = f"{field.name} {field.dataType.simpleString()}"
        return text + (" not null" if nullable and not field.nullable else "")

    ours, theirs = ([described(f) for f in s.fields] for s in (left, right))
    spare = list(theirs)
    found = []
    for text in ours:
        if text in spare:
            spare.remove(text)
        else:
            found.append(f"only left: {text}")
    found += [f"only right: {text}" for text in spare]
    if not found and ordered and ours != theirs:
        found = [f"order: {', '.join(ours)} / {', '.join(theirs)}"]
    return found


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that do not occur equally often on both sides, with both counts.

    Empty when the tables hold the same rows the same number of times. Copies
    are counted, never paired or repeated, in one shuffle for both directions.
    The counts are `left_count` and `right_count`, or longer names where the
    tables have such columns themselves.
    """
    columns = left.columns
    ours, theirs = (fresh(name, columns) for name in ("left_count", "right_count"))
    both = left.withColumns({ours: F.lit(1), theirs: F.lit(0)}).unionByName(
        right.withColumns({ours: F.lit(0), theirs: F.lit(1)})
    )
    counted = both.groupBy(*columns).agg(F.sum(ours).alias(ours), F.sum(theirs).alias(theirs))
    return counted.where(F.col(ours) != F.col(theirs))


def split_invalid_keys(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every required column set, rows where one is NULL)."""
    broken = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in required))
    return df.where(~broken), df.where(broken)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on more than one row, with the number of rows: `copies`, or longer if a key is that."""
    copies = fresh("copies", keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(copies)).where(F.col(copies) > 1)


def unmatched(facts: DataFrame, entities: DataFrame, key: str) -> DataFrame:
    """Keys of `facts` without an entity, with the rows an inner join leaves out.

    Facts are counted per key first, so a key with very many rows is one row by
    the time it is joined. NULL keys match nothing and are listed too. The count
    is `rows`, or longer if the key is called that.
    """
    counted = facts.groupBy(key).agg(F.count(F.lit(1)).alias(fresh("rows", [key])))
    return counted.join(entities.select(key), key, "left_anti")
