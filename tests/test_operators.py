from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import types as T

from tallyhouse import operators as op
from tallyhouse import plans
from tallyhouse.plans import daily_activity, top_k_by_sum
from tallyhouse.schemas import ACCOUNTS, AUTHS


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def day(n, hour=0):
    return dt.datetime(2022, 2, n, hour)


# ---- projections ----------------------------------------------------------------


def test_keep_drops_everything_else_and_keeps_the_order(spark):
    df = spark.createDataFrame([(1, "x", 2, "y")], "a int, `b c` string, extra int, d string")
    kept = op.keep(df, ["d", "b c"])
    assert kept.columns == ["d", "b c"] and rows(kept) == Counter([("y", "x")])


def test_keep_of_a_missing_column_is_an_error(spark):
    with pytest.raises(Exception, match="nowhere"):
        op.keep(spark.range(1), ["nowhere"])


@pytest.mark.parametrize("feed", [ACCOUNTS, AUTHS], ids=lambda f: f.name)
def test_conform_names_gives_the_table_columns(spark, feed):
    named = T.StructType([f for f in feed.source_schema if f.name in feed.names])
    done = op.conform_names(spark.createDataFrame([], named), feed.names)
    assert done.columns == feed.table_schema.fieldNames()[: len(feed.names)]


def test_conform_names_can_swap_and_checks_its_map(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert op.conform_names(df, {"a": "b", "b": "a"}).columns == ["b", "a"]
    with pytest.raises(ValueError, match="nowhere"):
        op.conform_names(df, {"nowhere": "a"})


# ---- union and distinct -----------------------------------------------------------


def test_union_all_keeps_copies_and_goes_by_name(spark):
    table = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "v int, k string")
    assert rows(op.union_all(table, batch)) == Counter(
        {("a", 1): 2, ("b", 2): 1, ("c", 3): 1}
    )


def test_distinct_rows_compares_every_column_and_nulls_as_equal(spark):
    data = [("a", 1.5, None), ("a", 1.5, None), ("a", 1.5, "x"), ("a", 2.5, None)]
    df = spark.createDataFrame(data, "k string, v double, n string")
    assert rows(op.distinct_rows(df)) == Counter(set(data))


def test_append_distinct_by_rows(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = spark.createDataFrame([("a", 1), ("a", 9), ("a", 9), ("c", 3)], "k string, v int")
    merged = op.append_distinct(table, batch)
    assert rows(merged) == Counter([("a", 1), ("b", 2), ("a", 9), ("c", 3)])
    assert rows(op.append_distinct(merged, batch)) == rows(merged)


def test_append_distinct_by_key_keeps_the_table_row(spark):
    table = spark.createDataFrame([("a", 5)], "k string, v int")
    batch = spark.createDataFrame([("a", 1), ("b", 8), ("b", 7)], "k string, v int")
    assert rows(op.append_distinct(table, batch, ["k"])) == Counter([("a", 5), ("b", 7)])


def test_rows_to_append_is_what_is_missing(spark):
    schema = "k string, v double"
    table = spark.createDataFrame([("a", 1.0), (None, None)], schema)
    new = [("a", 1.0), ("b", 2.0), ("b", 2.0), (None, None), ("a", None)]
    batch = spark.createDataFrame(new, schema)
    assert rows(op.rows_to_append(table, batch)) == Counter([("b", 2.0), ("a", None)])
    assert op.rows_to_append(op.append_distinct(table, batch), batch).isEmpty()


def test_rows_to_append_by_key(spark):
    schema = "k string, v int"
    table = spark.createDataFrame([("a", 5), (None, 1)], schema)
    batch = spark.createDataFrame([("a", 1), ("b", 8), ("b", 7), ("b", 7), (None, 2)], schema)
    assert rows(op.rows_to_append(table, batch, ["k"])) == Counter([("b", 7)])
    assert rows(op.rows_to_append(table.limit(0), batch, ["k"])) == Counter([("a", 1), ("b", 7), (None, 2)])


def test_touched_days_covers_every_day_of_the_batch(spark):
    stored = spark.createDataFrame(
        [(2021, 12, 31), (2022, 1, 1), (2022, 1, 2), (2022, 2, 1), (None, None, None)],
        "year int, month int, day int",
    )
    batch = stored.where("year = 2021 OR month = 2").union(stored.where("day = 2"))
    found = rows(stored.where(op.touched_days(batch)))
    assert found == Counter([(2021, 12, 31), (2022, 1, 2), (2022, 2, 1)])


def test_however_many_days_are_listed_one_by_one(spark):
    days = spark.sql("SELECT explode(sequence(date'2000-01-01', date'2009-12-31', interval 2 days)) AS d")
    parts = days.selectExpr("year(d) AS year", "month(d) AS month", "day(d) AS day")
    assert len(op.day_codes(parts)) == parts.count() > 1800
    other = spark.createDataFrame([(2000, 1, 2)], parts.schema)
    assert other.where(op.touched_days(parts)).isEmpty()


def test_touched_days_of_an_empty_batch(spark):
    empty = spark.createDataFrame([], "year int, month int, day int")
    assert op.touched_days(empty) is None


# ---- latest -----------------------------------------------------------------------

VERSIONS = "account_id string, updated_date timestamp, name string"


def test_latest_per_key(spark):
    data = [
        ("a", day(9), "old"), ("a", day(10), "new"),
        ("b", day(1), "only"),
        ("c", None, "undated"), ("c", day(1), "dated"),
        ("d", None, "undated"),
    ]
    done = op.latest_per_key(
        spark.createDataFrame(data, VERSIONS), ["account_id"], "updated_date"
    )
    assert rows(done) == Counter([data[1], data[2], data[4], data[5]])


def test_latest_per_key_settles_ties_the_same_way_in_any_order(spark):
    data = [("a", day(1), "x"), ("a", day(1), "z"), ("a", day(1), "y"), ("a", day(1), None)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, VERSIONS).repartition(4)
        assert rows(op.latest_per_key(df, ["account_id"], "updated_date")) == Counter([data[1]])


def test_upsert_updates_inserts_and_ignores_late_versions(spark):
    table = spark.createDataFrame(
        [("a", day(5), "t"), ("b", day(5), "t"), ("c", day(5), "t"), ("e", day(5), "t")], VERSIONS
    )
    batch = spark.createDataFrame(
        [("a", day(6), "b"), ("b", day(4), "b"), ("c", day(5), "b"), ("d", day(1), "b")], VERSIONS
    )
    done = op.upsert_latest(table, batch, ["account_id"], "updated_date")
    assert done.columns == table.columns
    assert rows(done) == Counter([
        ("a", day(6), "b"), ("b", day(5), "t"), ("c", day(5), "b"),  # a tie goes to the batch
        ("d", day(1), "b"), ("e", day(5), "t"),
    ])


def test_upsert_keeps_a_table_row_that_would_win_the_tie_by_value(spark):
    table = spark.createDataFrame([("a", day(5), "zzz")], VERSIONS)
    batch = spark.createDataFrame([("a", day(5), "aaa")], VERSIONS)
    done = op.upsert_latest(table, batch, ["account_id"], "updated_date")
    assert rows(done) == Counter([("a", day(5), "aaa")])


# ---- aggregates, join, sort ---------------------------------------------------------


def test_count_and_sum_per_key(spark):
    df = spark.createDataFrame(
        [("a", 0.1), ("a", 0.2), (None, 5.0), ("b", None), ("a", None)], "k string, v double"
    )
    assert rows(op.count_per(df, ["k"])) == Counter([("a", 3), (None, 1), ("b", 1)])
    summed = {k: v for k, v in op.sum_per(df, ["k"], "v", "total").collect()}
    assert {k: str(v) for k, v in summed.items()} == {"a": "0.30", None: "5.00", "b": "None"}


def test_sums_of_other_types_than_double(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    for amount in ("int", "decimal(10,3)", "float", "bigint"):
        cast = df.withColumn("v", df.v.cast(amount))
        assert str(op.sum_per(cast, ["k"], "v", "total").first().total) == "3.00"


def test_no_amount_stops_a_sum(spark):
    data = [("a", 1e30), ("a", 0.25), ("a", float("nan")), ("b", float("inf")), ("b", 2.0), ("c", 1e300)]
    df = spark.createDataFrame(data, "k string, v double")
    summed = {k: str(v) for k, v in op.sum_per(df, ["k"], "v", "total").collect()}
    assert summed == {"a": "1000000000000000000000000000000.25", "b": "2.00", "c": "None"}
    wide = spark.sql("SELECT 'a' AS k, CAST('100000000000000000.50' AS DECIMAL(28,2)) AS v")
    assert str(op.sum_per(wide, ["k"], "v", "total").first().total) == "100000000000000000.50"
    most = spark.sql("SELECT 'a' AS k, CAST('9e35' AS DECIMAL(38,2)) AS v").unionAll(
        spark.sql("SELECT 'a' AS k, CAST('9e35' AS DECIMAL(38,2)) AS v"))
    assert op.sum_per(most, ["k"], "v", "total").first().total is None


def test_a_ranking_is_bounded(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(ValueError, match="sort the sums"):
        op.top_k(df, "v", 50_000_000)


def test_a_repeated_entity_counts_once(spark):
    facts = spark.createDataFrame(
        [("a", dt.datetime(2022, 2, 1))] * 3, "account_id string, transmit_time timestamp"
    )
    entities = spark.createDataFrame(
        [("a", "B", "Y"), ("a", "A", "Z"), ("a", "A", "Z")], "account_id string, first_name string, last_name string"
    )
    assert [tuple(r) for r in plans.daily_activity(facts, entities).collect()] == [("A", "Z", "2022-02-01", 3)]


def test_top_k_by_sum_in_order_with_ties_by_name(spark):
    df = spark.createDataFrame(
        [("b", 2.0), ("a", 1.5), ("a", 0.5), ("c", 9.0), ("d", 1.0), ("e", None)],
        "merchant_name string, amount double",
    )
    top = [tuple(map(str, r)) for r in top_k_by_sum(df).collect()]
    assert top == [("c", "9.00"), ("a", "2.00"), ("b", "2.00")]
    everything = [r.merchant_name for r in top_k_by_sum(df, k=10).collect()]
    assert everything == ["c", "a", "b", "d", "e"]


def test_matching_leaves_out_facts_without_an_entity(spark):
    facts = spark.createDataFrame([("a", 1), ("a", 2), ("x", 3), (None, 4)], "k string, v int")
    entities = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, n string")
    assert rows(op.matching(facts, entities, "k")) == Counter([("a", 1, "A"), ("a", 2, "A")])
    assert rows(op.unmatched(facts, entities, "k")) == Counter([("x", 1), (None, 1)])


def test_daily_activity_grain_order_and_unmatched(spark):
    facts = spark.createDataFrame(
        [("2", day(2, 1)), ("1", day(2, 2)), ("1", day(2, 23)), ("1", day(1)), ("9", day(1)),
         ("2", day(10))],
        "account_id string, transmit_time timestamp",
    )
    entities = spark.createDataFrame(
        [("1", "A", "B"), ("2", "A", "B"), ("3", "C", "D")],
        "account_id string, first_name string, last_name string",
    )
    report = daily_activity(facts, entities)
    assert report.columns == ["first_name", "last_name", "transmit_time", "num_transactions"]
    assert [tuple(r) for r in report.collect()] == [
        ("A", "B", "2022-02-01", 1),
        ("A", "B", "2022-02-02", 2),  # two accounts of one name keep a row each
        ("A", "B", "2022-02-02", 1),
        ("A", "B", "2022-02-10", 1),
    ]


# ---- checks -----------------------------------------------------------------------


def schema(text):
    return T.StructType.fromDDL(text)


def test_schema_diff():
    assert op.schema_diff(schema("a int, b string"), schema("a int, b string")) == []
    assert op.schema_diff(schema("a int"), schema("a bigint, b int")) == [
        "only left: a int", "only right: a bigint", "only right: b int"
    ]
    swapped = schema("a int, b string"), schema("b string, a int")
    assert op.schema_diff(*swapped)[0].startswith("order: ")
    assert op.schema_diff(*swapped, ordered=False) == []
    strict = schema("a int NOT NULL")
    assert op.schema_diff(strict, schema("a int")) == []
    assert len(op.schema_diff(strict, schema("a int"), nullable=True)) == 2


def test_schema_diff_sees_a_repeated_column():
    twice = T.StructType([T.StructField("a", T.IntegerType())] * 2)
    assert op.schema_diff(twice, schema("a int")) == ["only left: a int"]


def test_table_diff_counts_copies(spark):
    left = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "a int, b string")
    right = spark.createDataFrame([("x", 1), (None, 2), ("y", 4)], "b string, a int")
    assert rows(op.table_diff(left, right)) == Counter(
        [(1, "x", 2, 1), (3, "z", 1, 0), (4, "y", 0, 1)]
    )
    assert op.table_diff(left, left.repartition(3)).isEmpty()


def test_split_invalid_keys_loses_nothing(spark):
    data = [("a", 1), (None, 2), ("b", None), (None, None)]
    good, bad = op.split_invalid_keys(spark.createDataFrame(data, "k string, v int"), ["k", "v"])
    assert rows(good) == Counter(data[:1]) and rows(bad) == Counter(data[1:])


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2)], "k string, v int")
    assert rows(op.duplicate_keys(df, ["k"])) == Counter([("a", 2), (None, 2)])


# ---- names the operators use themselves ---------------------------------------------


def test_columns_named_as_the_operators_name_theirs_come_through(spark):
    schema = "k string, t int, rank int, from_batch int, mark int, held_k string, RANK_ int"
    table = spark.createDataFrame([("a", 1, 77, 88, 5, "x", 1), ("b", 1, 7, 8, 5, "x", 1)], schema)
    batch = spark.createDataFrame([("a", 2, 70, 80, 5, "y", 2), ("c", 1, 6, 9, 5, "z", 3)], schema)
    kept = [("a", 2, 70, 80, 5, "y", 2), ("b", 1, 7, 8, 5, "x", 1), ("c", 1, 6, 9, 5, "z", 3)]
    assert rows(op.upsert_latest(table, batch, ["k"], "t")) == Counter(kept)
    late, rank = op.change_columns(table)
    assert (late, rank) == ("from_batch_", "rank__")
    changes = op.ranked_changes(table, batch, ["k"], "t")
    assert rows(changes.select(*table.columns, late, rank)) == Counter([
        (*kept[0], True, 1), ("a", 1, 77, 88, 5, "x", 1, False, 2), (*kept[2], True, 1),
    ])
    assert rows(op.rows_to_append(table, batch, ["k"])) == Counter(kept[2:])
    assert rows(op.rows_to_append(table, batch)) == rows(batch)
    assert rows(op.append_distinct(table, batch, ["k"])) == rows(table) + Counter(kept[2:])


def test_counts_beside_columns_of_their_names(spark):
    schema = "left_count int, right_count int, copies int, rows int"
    left = spark.createDataFrame([(1, 2, 3, 4), (1, 2, 3, 4), (5, 6, 7, 8)], schema)
    right = spark.createDataFrame([(1, 2, 3, 4), (5, 6, 7, 8)], schema)
    assert op.table_diff(left, right).columns == [*left.columns, "left_count_", "right_count_"]
    assert rows(op.table_diff(left, right)) == Counter([(1, 2, 3, 4, 2, 1)])
    assert rows(op.duplicate_keys(left, ["copies"])) == Counter([(3, 2)])
    assert op.duplicate_keys(left, ["copies"]).columns == ["copies", "copies_"]
    assert rows(op.unmatched(left, right.where("rows = 8"), "rows")) == Counter([(4, 2)])
