"""Which columns go on, and under which names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fresh(name: str, *columns: Iterable[str]) -> str:
    """`name`, lengthened until none of `columns` is called that."""
    taken = {column.lower() for some in columns for column in some}
    while name.lower() in taken:
        name += "_"
    return name


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def keep(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Exactly `columns`, in that order. A missing one is an error."""
    return df.select(*[_quoted(c) for c in columns])


def conform_names(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by an explicit old -> new map; columns not in it keep their name."""
    missing = set(names) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return df.select(*[F.col(_quoted(c)).alias(names.get(c, c)) for c in df.columns])
