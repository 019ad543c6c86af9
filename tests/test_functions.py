from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import (
    add_date_parts,
    between_days,
    canonicalize,
    canonicalize_from_table,
    day_text,
)
from tallyhouse.schemas import MERCHANT_NAMES


def _column(df, name):
    return [row[name] for row in df.collect()]


def test_every_listed_spelling_becomes_its_merchant(spark):
    raw = list(MERCHANT_NAMES)
    df = spark.createDataFrame([(i, m) for i, m in enumerate(raw)], "i int, merchant_name string")
    done = canonicalize(df, "merchant_name", MERCHANT_NAMES).orderBy("i")
    assert _column(done, "merchant_name") == [
        "walmart", "walmart", "walmart", "target", "target", "google",
        "amazon", "amazon", "walgreens", "home_depot", "cvs",
    ]


def test_unlisted_spellings_and_null_stay(spark):
    raw = ["Walmart", "Amazon", "CVS", "walgreens ", "corner shop", "", None]
    df = spark.createDataFrame([(m,) for m in raw], "merchant_name string")
    assert _column(canonicalize(df, "merchant_name", MERCHANT_NAMES), "merchant_name") == raw


def test_folding_ignores_case_and_outer_spaces(spark):
    df = spark.createDataFrame([(" AMZN ",), ("Amzn",), ("am zn",), (None,)], "m string")
    done = canonicalize(df, "m", {"amzn": "amazon", " Amazon": "amazon"}, fold=True)
    assert _column(done, "m") == ["amazon", "amazon", "am zn", None]


def test_folding_refuses_two_names_for_one_spelling(spark):
    df = spark.createDataFrame([("a",)], "m string")
    with pytest.raises(ValueError, match="share a spelling"):
        canonicalize(df, "m", {"a": "x", "A": "y"}, fold=True)


def test_empty_map_changes_nothing(spark):
    df = spark.createDataFrame([("a",)], "m string")
    assert _column(canonicalize(df, "m", {}), "m") == ["a"]


def test_lookup_table_agrees_with_the_map(spark):
    raw = [*MERCHANT_NAMES, "Walmart", "corner shop", None]
    df = spark.createDataFrame([(i, m, -i) for i, m in enumerate(raw)], "i int, m string, j int")
    # A spelling listed twice with the same name must not double any row.
    listed = [*MERCHANT_NAMES.items(), ("amzn", "amazon"), (None, "nothing")]
    names = spark.createDataFrame(listed, "spelling string, name string")
    by_table = canonicalize_from_table(df, "m", names, "spelling", "name")
    assert by_table.columns == ["i", "m", "j"]
    assert sorted(by_table.collect()) == sorted(canonicalize(df, "m", MERCHANT_NAMES).collect())


def test_lookup_table_with_two_names_for_one_spelling_fails(spark):
    df = spark.createDataFrame([("a",)], "m string")
    names = spark.createDataFrame([("a", "x"), ("a", "y")], "spelling string, name string")
    with pytest.raises(Exception, match="more than one name for a"):
        canonicalize_from_table(df, "m", names, "spelling", "name").collect()


def test_date_parts(spark):
    moments = [
        dt.datetime(2022, 2, 7, 2, 20, 30),
        dt.datetime(2020, 2, 29, 23, 59, 59),
        dt.datetime(1999, 12, 31),
        dt.datetime(2021, 10, 9, 0, 0, 1),
        None,
    ]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp")
    done = add_date_parts(df, "t")
    assert [f.dataType.simpleString() for f in done.schema][1:] == ["int", "int", "int"]
    assert [tuple(r)[1:] for r in done.collect()] == [
        (2022, 2, 7), (2020, 2, 29), (1999, 12, 31), (2021, 10, 9), (None, None, None)
    ]


def test_day_text_is_padded(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 2, 7, 23, 59, 59),), (None,)], "t timestamp")
    assert _column(df.select(day_text("t").alias("d")), "d") == ["2022-02-07", None]


def test_between_days_includes_both_ends_and_open_ends(spark):
    days = spark.sql("SELECT explode(sequence(date'2021-12-30', date'2022-01-03')) AS t")
    parts = add_date_parts(days.withColumn("t", F.col("t").cast("timestamp")), "t")
    first, last = dt.date(2021, 12, 31), dt.date(2022, 1, 2)

    def kept(*ends):
        return sorted(r.t.day for r in parts.where(between_days(*ends)).collect())

    assert kept(first, last) == [1, 2, 31]
    assert kept(None, last) == [1, 2, 30, 31]
    assert kept(first, None) == [1, 2, 3, 31]
    assert kept() == [1, 2, 3, 30, 31]
