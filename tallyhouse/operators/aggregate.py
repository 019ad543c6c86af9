"""Counts, sums and the top of a ranking.

Counts and sums are combined within each map task before the shuffle, so a key
that holds most of the rows arrives as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.schemas import MONEY


def count_per(df: DataFrame, keys: Sequence[str | Column], name: str = "count") -> DataFrame:
    """Rows per distinct combination of `keys`; NULL is a value of its own."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_per(
    df: DataFrame, keys: Sequence[str | Column], amount: str, name: str, money=MONEY
) -> DataFrame:
    """Exact sum of `amount` per combination of `keys`, whatever order rows are added in.

    Amounts are added as decimals of 38 digits with the places of `money`. What
    no such decimal can hold, NULL, NaN or infinity, counts as nothing, and a
    total beyond 38 digits is NULL: no single row stops the report.
    """
    wide = T.DecimalType(38, money.scale)
    total = F.try_sum(F.col(amount).try_cast(wide)).cast(wide)
    return df.groupBy(*keys).agg(total.alias(name))


# A ranking is put together in one task and in the driver; a longer one is a sorted report.
MOST_RANKED = 100_000


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """The `k` largest by `by`, in order, with ties settled by `ties` ascending.

    Spark keeps the best k of every task and merges those: no full sort. For
    more than `MOST_RANKED` sort all, which needs no task to hold them.
    """
    if k > MOST_RANKED:
        raise ValueError(f"a ranking has {MOST_RANKED} rows at most; sort the sums instead")
    return df.orderBy(F.col(by).desc(), *[F.col(t).asc() for t in ties]).limit(k)
