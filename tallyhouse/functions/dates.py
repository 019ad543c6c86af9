"""Calendar parts of a timestamp, and filters on the columns they become."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.schemas import DAY_PARTS


def add_date_parts(df: DataFrame, moment: str) -> DataFrame:
    """Add int columns year, month and day of `moment`; NULL stays NULL."""
    parts = [F.year(moment), F.month(moment), F.dayofmonth(moment)]
    return df.withColumns(dict(zip(DAY_PARTS, parts, strict=True)))


def day_text(moment: Column | str) -> Column:
    """The day of `moment` as text, such as 2022-02-07."""
    return F.date_format(moment, "yyyy-MM-dd")


def day_code() -> Column:
    """The partition columns as one int, 20220207, which sorts as the days do.

    It refers to partition columns only, so a filter on it skips directories.
    """
    year, month, day = (F.col(p) for p in DAY_PARTS)
    return year * 10000 + month * 100 + day


def between_days(first: dt.date | None = None, last: dt.date | None = None) -> Column:
    """Rows of a day-partitioned table from `first` to `last`, both included."""
    keep = F.lit(True)
    for day, reached in ((first, day_code().__ge__), (last, day_code().__le__)):
        if day is not None:
            keep = keep & reached(F.lit(day.year * 10000 + day.month * 100 + day.day))
    return keep
