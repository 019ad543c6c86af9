"""What must hold for any table and batch."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import operators as op
from tallyhouse.functions import add_date_parts
from tallyhouse.plans import daily_activity, top_k_by_sum

few = settings(
    max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

keys = st.sampled_from(["a", "b", "c", None])
days = st.one_of(st.none(), st.integers(1, 4).map(lambda d: dt.datetime(2022, 1, d, 12)))
cents = st.one_of(st.none(), st.integers(-500, 500).map(lambda c: c / 100))
facts = st.lists(st.tuples(keys, days, cents, st.sampled_from(["x", "y", None])), max_size=12)
SCHEMA = "account_id string, transmit_time timestamp, amount double, merchant_name string"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def oldest_first(value):
    return (value is not None, value if value is not None else 0)


@few
@given(facts, facts)
def test_append_distinct_is_a_set_union_and_idempotent(spark, table, batch):
    t, b = (spark.createDataFrame(x, SCHEMA) for x in (table, batch))
    merged = op.append_distinct(t, b)
    assert rows(merged) == Counter(set(table) | set(batch))
    assert rows(op.append_distinct(merged, b)) == rows(merged)
    assert rows(op.rows_to_append(t, b)) == Counter(set(batch) - set(table))
    assert rows(op.rows_to_append(t, b, t.columns)) == Counter(set(batch) - set(table))


@few
@given(facts)
def test_touched_days_lose_no_possible_copy(spark, batch):
    b = add_date_parts(spark.createDataFrame(batch, SCHEMA), "transmit_time")
    dated = b.where("transmit_time IS NOT NULL")
    found = op.touched_days(dated)
    if found is None:
        assert dated.isEmpty()
    else:
        assert rows(dated.where(found)) == rows(dated)


@few
@given(facts, facts)
def test_upsert_keeps_the_newest_and_prefers_the_batch(spark, table, batch):
    t, b = (spark.createDataFrame(x, SCHEMA) for x in (table, batch))
    done = op.upsert_latest(t, b, ["account_id"], "transmit_time").collect()
    found = {tuple(r)[0]: tuple(r) for r in done}
    assert len(found) == len(done)
    assert set(found) == {r[0] for r in table + batch}
    for key, row in found.items():
        ours = [r for r in table + batch if r[0] == key]
        newest = max(oldest_first(r[1] and r[1].timestamp()) for r in ours)
        assert oldest_first(row[1] and row[1].timestamp()) == newest
        tied = [r for r in batch if r[0] == key and r[1] == row[1]]
        assert row in tied if tied else row in table


@few
@given(st.permutations([(k, d, c / 100, "x") for k in "ab" for c, d in enumerate(
    dt.datetime(2022, 1, n, 12) for n in (1, 2, 3))]), st.integers(0, 6))
def test_upserts_in_any_order_give_the_same_table(spark, versions, cut):
    df = spark.createDataFrame(versions, SCHEMA)
    parts = [spark.createDataFrame(x, SCHEMA) for x in (versions[:cut], versions[cut:])]
    empty = spark.createDataFrame([], SCHEMA)
    key, newest = ["account_id"], "transmit_time"
    stepwise = empty
    for part in parts:
        stepwise = op.upsert_latest(stepwise, part, key, newest)
    assert rows(stepwise) == rows(op.latest_per_key(df, key, newest))


@few
@given(facts)
def test_report_counts_are_the_matched_rows(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    entities = spark.createDataFrame(
        [("a", "A", "A"), ("b", "A", "A"), ("z", "Z", "Z")],
        "account_id string, first_name string, last_name string",
    )
    report = daily_activity(df, entities).collect()
    missed = op.unmatched(df, entities, "account_id").agg(F.sum("rows")).first()[0] or 0
    assert sum(r.num_transactions for r in report) + missed == len(data)
    texts = [r.transmit_time or "" for r in report]
    assert texts == sorted(texts)


@few
@given(facts, st.integers(1, 3))
def test_top_k_is_the_start_of_the_whole_ranking(spark, data, k):
    df = spark.createDataFrame(data, SCHEMA)
    ranking = top_k_by_sum(df, k=100).collect()
    assert top_k_by_sum(df, k=k).collect() == ranking[:k]
    exact = {}
    for _, _, amount, merchant in data:
        exact.setdefault(merchant, []).extend([] if amount is None else [round(amount * 100)])
    assert {r.merchant_name: None if r.dollars_spent is None else int(r.dollars_spent * 100)
            for r in ranking} == {m: sum(c) if c else None for m, c in exact.items()}


odd = st.one_of(
    st.none(),
    st.integers(-(10**13), 10**13).map(lambda c: c / 100),
    st.integers(-(10**7), 10**7).map(lambda c: c / 1000),  # halves of a cent among them
    st.floats(-1e12, 1e12, allow_nan=False),
    st.sampled_from([1.005, -1.005, 2.675, 0.0, -0.0, 1e-9, 9999999999999.99, 0.1 + 0.2]),
)


@few
@given(st.lists(st.tuples(st.sampled_from("ab"), odd), max_size=30), st.sampled_from([0, 2, 4]))
def test_a_sum_is_the_sum_of_decimals(spark, data, scale):
    df = spark.createDataFrame(data, "k string, v double")
    money = T.DecimalType(18, scale)
    total = op.sum_per(df, ["k"], "v", "total", money)
    plain = df.groupBy("k").agg(F.sum(F.col("v").cast(money)).alias("total"))
    assert rows(total) == rows(plain)


@few
@given(facts, facts)
def test_table_diff_is_empty_only_for_equal_multisets(spark, left, right):
    a, b = (spark.createDataFrame(x, SCHEMA) for x in (left, right))
    ours, theirs = Counter(left), Counter(right)
    wanted = {r: (ours[r], theirs[r]) for r in ours | theirs if ours[r] != theirs[r]}
    assert {tuple(r)[:4]: tuple(r)[4:] for r in op.table_diff(a, b).collect()} == wanted


@few
@given(facts)
def test_invalid_and_valid_rows_are_everything(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    good, bad = op.split_invalid_keys(df, ["account_id", "transmit_time"])
    assert rows(good) + rows(bad) == Counter(data)
    assert rows(good) == Counter(r for r in data if r[0] is not None and r[1] is not None)
