"""Spellings of a name -> the one name to use for it."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _folded(text: str) -> str:
    return text.strip(" ").lower()


def canonical_value(column: Column, names: Mapping[str, str], fold: bool = False) -> Column:
    """`column` with each listed spelling replaced; other values, and NULL, stay.

    Spellings match exactly. With `fold`, letter case and outer spaces of both
    sides are ignored.
    """
    spellings: dict[str, set[str]] = defaultdict(set)
    for spelling, name in names.items():
        spellings[name].add(_folded(spelling) if fold else spelling)
    if not spellings:
        return column
    total = sum(len(group) for group in spellings.values())
    if len(set().union(*spellings.values())) < total:
        raise ValueError("two names share a spelling that differs only in case or spaces")
    seen = F.lower(F.trim(column)) if fold else column
    chosen = F
    for name, group in spellings.items():
        chosen = chosen.when(seen.isin(sorted(group)), F.lit(name))
    return chosen.otherwise(column)


def canonicalize(
    df: DataFrame, column: str, names: Mapping[str, str], fold: bool = False
) -> DataFrame:
    """Replace `column` by its canonical value. For a short map that fits a plan."""
    return df.withColumn(column, canonical_value(F.col(column), names, fold))


def canonicalize_from_table(
    df: DataFrame, column: str, names: DataFrame, spelling: str, name: str, fold: bool = False
) -> DataFrame:
    """Replace `column` by looking it up in a table of any size.

    Spellings match exactly, or, with `fold`, but for letter case and outer spaces.

    No broadcast is asked for. Spark sends the table out only if it proves small
    enough; else it shuffles both sides, and AQE splits the partition of a
    spelling that very many rows carry. A spelling listed with two names fails
    the query instead of doubling rows.
    """
    # AQE splits a partition only if both sides of the join come straight from a
    # shuffle. Grouping by a second column, which follows from the first, makes
    # Spark shuffle the finished lookup by the spelling alone for the join.
    def folded(text: str) -> Column:
        return F.lower(F.trim(F.col(text))) if fold else F.col(text)

    lookup = (
        names.where(F.col(spelling).isNotNull())
        .groupBy(folded(spelling).alias("__spelling"), F.hash(folded(spelling)).alias("__hash"))
        .agg(F.min(name).alias("__name"), F.max(name).alias("__other"))
        .select(
            "__spelling",
            F.when(
                F.col("__name") != F.col("__other"),
                F.raise_error(F.concat(F.lit("more than one name for "), "__spelling")),
            ).otherwise(F.col("__name")).alias("__name"),
        )
    )
    found = df.join(lookup, folded(column) == F.col("__spelling"), "left")
    replaced = F.coalesce("__name", column).alias(column)
    return found.select(*[replaced if c == column else F.col(c) for c in df.columns])
