"""Bringing a batch into a table. Pure DataFrame work: nothing is written here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.functions.dates import day_code
from tallyhouse.operators.project import fresh


def union_all(table: DataFrame, batch: DataFrame) -> DataFrame:
    """All rows of both, copies included. Columns are matched by name."""
    return table.unionByName(batch)


def distinct_rows(df: DataFrame) -> DataFrame:
    """One of each row, over all columns; NULLs are equal to each other.

    Copies are dropped within each map task before the shuffle, so a row
    repeated very often is not sent very often.
    """
    return df.distinct()


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: str, ties: Sequence[str] | None = None
) -> DataFrame:
    """The row with the greatest `newest` per key; NULL counts as oldest.

    Equal times are settled by `ties` descending, by default every other
    column, so the choice is the same in every run. Spark keeps one row per key
    in each map task ahead of the shuffle, which bounds what a hot key ships.
    """
    if ties is None:
        ties = [c for c in df.columns if c not in (*keys, newest)]
    order = [F.col(c).desc() for c in (newest, *ties)]
    return _first(df, keys, order)


def _first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row in `order` of each key."""
    rank = fresh("rank", df.columns)
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) == 1).drop(rank)


def _marked(table: DataFrame, batch: DataFrame, mark: str) -> DataFrame:
    return union_all(table.withColumn(mark, F.lit(False)), batch.withColumn(mark, F.lit(True)))


def upsert_latest(
    table: DataFrame, batch: DataFrame, keys: Sequence[str], newest: str
) -> DataFrame:
    """Table and batch merged to the latest version of every key.

    An older version that arrives late loses. At the same time the batch beats
    the table, and then the remaining columns decide.
    """
    rest = [c for c in table.columns if c not in (*keys, newest)]
    late = fresh("from_batch", table.columns)
    merged = latest_per_key(_marked(table, batch, late), keys, newest, [late, *rest])
    return merged.drop(late)


def append_distinct(
    table: DataFrame, batch: DataFrame, keys: Sequence[str] | None = None
) -> DataFrame:
    """Table and batch without copies, so merging the same batch twice is harmless.

    A row is identified by all its columns, or by `keys` if the caller has a
    real identifier: then the table's row stays, else the least of the rows.
    """
    if keys is None:
        return distinct_rows(union_all(table, batch))
    rest = [c for c in table.columns if c not in keys]
    late = fresh("from_batch", table.columns)
    order = [F.col(c).asc() for c in (late, *rest)]
    return _first(_marked(table, batch, late), keys, order).drop(late)


def rows_to_append(
    table: DataFrame, batch: DataFrame, keys: Sequence[str] | None = None
) -> DataFrame:
    """The distinct rows of `batch` that `table` does not hold yet.

    For a table that is free of copies, as `append_distinct` leaves it, adding
    these rows gives the same as merging everything, and no stored row is
    written again. Stored rows are first narrowed to those with the hash of a
    batch row; Spark sends these hashes around only if their size allows it. A
    row let through by chance does no harm: whole rows are compared after, as
    groups within tasks first, not as pairs.

    With `keys` a row is identified by them: what the table has is not added,
    and of batch rows with one key the least is. NULL keys are equal.
    """
    columns = table.columns
    if keys is None:
        mark, late = fresh("mark", columns), fresh("from_batch", columns)
        wanted = batch.select(F.xxhash64(*columns).alias(mark)).distinct()
        near = table.join(wanted, F.xxhash64(*columns) == F.col(mark), "left_semi")
        seen = _marked(near, batch, late).groupBy(*columns).agg(F.min(late).alias(late))
        return seen.where(F.col(late)).select(*columns)
    theirs = {k: fresh(f"held_{k}", columns, keys) for k in keys}
    held = table.select(*[F.col(k).alias(name) for k, name in theirs.items()])
    order = [F.col(c).asc() for c in columns if c not in keys] or [F.lit(0)]
    least = _first(batch, keys, order)
    same = [F.col(k).eqNullSafe(F.col(name)) for k, name in theirs.items()]
    return least.join(held, same, "left_anti").select(*columns)


def change_columns(table: DataFrame) -> tuple[str, str]:
    """What `ranked_changes` calls the columns it adds: names that the table does not have."""
    return fresh("from_batch", table.columns), fresh("rank", table.columns)


def ranked_changes(
    table: DataFrame, batch: DataFrame, keys: Sequence[str], newest: str
) -> DataFrame:
    """Batch rows, and table rows of the same keys, with where they are from and their rank.

    The columns that `change_columns` names are added: whether a row is from the batch,
    and its rank, of which 1 is the row that `upsert_latest` keeps. Rows of other keys,
    which an upsert leaves as they are, are not here.
    """
    late, rank = change_columns(table)
    near = table.join(batch.select(*keys).distinct(), list(keys), "left_semi").select(*table.columns)
    rest = [c for c in table.columns if c not in (*keys, newest)]
    order = [F.col(c).desc() for c in (newest, late, *rest)]
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return _marked(near, batch, late).withColumn(rank, ranked)


def day_codes(df: DataFrame) -> list[int]:
    """The days that `df` has rows in, as 20220207; no more than a calendar has."""
    rows = df.select(day_code().alias("code")).where("code IS NOT NULL").distinct().collect()
    return sorted(row.code for row in rows)


def on_days(codes: Sequence[int]) -> Column:
    """A filter for day partitions, listed one by one."""
    return day_code().isin(list(codes))


def touched_days(batch: DataFrame) -> Column | None:
    """A filter for the day partitions `batch` has rows in; None for an empty batch.

    Equal rows share their day, so only these partitions can hold a copy of a
    batch row.
    """
    codes = day_codes(batch)
    return on_days(codes) if codes else None
