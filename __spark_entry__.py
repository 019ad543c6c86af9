"""

Each query reads whole tables. Where an operator takes two inputs, a table and
a batch, both are cut from one driver table by a column value, overlap, and
together cover all of it. Queries that write go to a fresh path below the
cluster's shared folder.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tallyhouse import functions, operators, plans, session, sinks, sources  # noqa: E402
from tallyhouse.schemas import ACCOUNTS, AUTHS, FEED_TIMESTAMP  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def _query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its own name, with the SQL that must agree with it."""

    def register(query: Query) -> Query:
        _QUERIES[query.__name__] = query
        _ORACLES[query.__name__] = sql
        return query

    return register


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_types(df: DataFrame, *types: str) -> DataFrame:
    return df.where(F.col("event_type").isin(list(types)))


_STORED_TYPES = ("view", "click", "purchase")
_BATCH_TYPES = ("purchase", "error", "signup")


# ---- projections, conditionals, scalar functions -------------------------------


@_query("""
    SELECT c_custkey AS account_id, c_name AS full_name, c_acctbal AS balance FROM customer
""")
def conform_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = operators.keep(_load(spark, sf_dir, "customer"), ["c_custkey", "c_name", "c_acctbal"])
    names = {"c_custkey": "account_id", "c_name": "full_name", "c_acctbal": "balance"}
    return operators.conform_names(kept, names)


@_query("""
    SELECT event_id,
           CASE WHEN event_type IN ('click', 'view') THEN 'visit'
                WHEN event_type = 'purchase' THEN 'sale'
                WHEN event_type = 'signup' THEN 'account'
                ELSE event_type END AS event_type
    FROM events
""")
def canonicalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"click": "visit", "view": "visit", "purchase": "sale", "signup": "account"}
    events = _load(spark, sf_dir, "events").select("event_id", "event_type")
    return functions.canonicalize(events, "event_type", names)


@_query("""
    SELECT c_custkey,
           CASE WHEN lower(trim(c_mktsegment)) IN ('building', 'machinery') THEN 'industry'
                WHEN lower(trim(c_mktsegment)) = 'household' THEN 'home'
                ELSE c_mktsegment END AS c_mktsegment
    FROM customer
""")
def canonicalize_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"Building ": "industry", "machinery": "industry", " HouseHold": "home"}
    customer = _load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return functions.canonicalize(customer, "c_mktsegment", names, fold=True)


@_query("""
    SELECT c_custkey, CASE WHEN r_regionkey > 0 THEN r_name ELSE n_name END AS place
    FROM customer JOIN nation ON c_nationkey = n_nationkey
                  JOIN region ON n_regionkey = r_regionkey
""")
def canonicalize_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _load(spark, sf_dir, "nation"), _load(spark, sf_dir, "region")
    placed = _load(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    names = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).where(
        "r_regionkey > 0"
    )
    return functions.canonicalize_from_table(
        placed.select("c_custkey", F.col("n_name").alias("place")),
        "place", names, "n_name", "r_name",
    )


@_query("""
    SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
           CAST(day(ts) AS INTEGER) AS day
    FROM events
""")
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = functions.add_date_parts(_load(spark, sf_dir, "events"), "ts")
    return dated.select("event_id", "year", "month", "day")


@_query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders")
def format_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _load(spark, sf_dir, "orders")
    return orders.select("o_orderkey", functions.day_text("o_orderdate").alias("order_day"))


# ---- join, aggregates, sort, top-k ---------------------------------------------


@_query("""
    SELECT o_orderkey, o_totalprice, c_custkey, c_name, c_mktsegment
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _load(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    joined = operators.matching(orders, _load(spark, sf_dir, "customer"), "c_custkey")
    return joined.select("o_orderkey", "o_totalprice", "c_custkey", "c_name", "c_mktsegment")


@_query("""
    SELECT user_id, event_type, count(*) AS num_events FROM events GROUP BY user_id, event_type
""")
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.count_per(
        _load(spark, sf_dir, "events"), ["user_id", "event_type"], "num_events"
    )


@_query("""
    SELECT o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM orders GROUP BY o_orderstatus
""")
def group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _load(spark, sf_dir, "orders")
    summed = operators.sum_per(orders, ["o_orderstatus"], "o_totalprice", "total")
    return summed.withColumn("total", F.col("total").cast("double"))


@_query("""
    SELECT l_returnflag,
           CAST(sum(CAST(l_orderkey AS HUGEINT) * 10000000000000000) AS VARCHAR) || '.00' AS total
    FROM lineitem GROUP BY l_returnflag
""")
def wide_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Single amounts beyond 18 digits, which are summed to the last one.
    wide = F.col("l_orderkey").cast("decimal(38,0)") * F.lit(10**16).cast("decimal(17,0)")
    lineitem = _load(spark, sf_dir, "lineitem").select("l_returnflag", wide.alias("amount"))
    summed = operators.sum_per(lineitem, ["l_returnflag"], "amount", "total")
    return summed.withColumn("total", F.col("total").cast("string"))


@_query("""
    SELECT n_name, s_name, s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey
    ORDER BY n_name, s_name
""")
def sort_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _load(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    joined = operators.matching(supplier, _load(spark, sf_dir, "nation"), "n_nationkey")
    return joined.select("n_name", "s_name", "s_acctbal").orderBy("n_name", "s_name")


@_query("""
    SELECT c_name, strftime(ts, '%Y-%m-%d') AS ts, count(*) AS num_transactions
    FROM events JOIN customer ON user_id = c_custkey
    GROUP BY user_id, c_name, strftime(ts, '%Y-%m-%d')
    ORDER BY ts, c_name
""")
def daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _load(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "user_id")
    return plans.daily_activity(
        _load(spark, sf_dir, "events"), customer, "user_id", "ts", ["c_name"], unique=True
    )


@_query("""
    SELECT s_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS dollars_spent
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY s_name
    ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18, 2))) DESC, s_name LIMIT 3
""")
def top_k_by_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Summed by supplier number first, so the join sees a row per supplier.
    supplier = _load(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    spent = operators.sum_per(
        _load(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice", "spent"
    )
    named = operators.matching(spent, supplier, "l_suppkey")
    top = plans.top_k_by_sum(named, "s_name", "spent", 3)
    return top.withColumn("dollars_spent", F.col("dollars_spent").cast("double"))


# ---- latest, merge, set operations ---------------------------------------------


@_query("""
    SELECT * FROM orders
    QUALIFY row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.latest_per_key(_load(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate")


@_query("""
    WITH merged AS (
        SELECT *, false AS late FROM orders WHERE o_orderstatus IN ('F', 'O')
        UNION ALL
        SELECT * REPLACE (o_totalprice + 1 AS o_totalprice), true AS late
        FROM orders WHERE o_orderstatus IN ('O', 'P'))
    SELECT * EXCLUDE (late) FROM merged
    QUALIFY row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, late DESC, o_orderkey DESC) = 1
""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Both sides span all dates, so many batch rows are older than the table's,
    # and orders of status O are in both with another price.
    orders = _load(spark, sf_dir, "orders")
    table = orders.where(F.col("o_orderstatus").isin("F", "O"))
    batch = orders.where(F.col("o_orderstatus").isin("O", "P"))
    batch = batch.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return operators.upsert_latest(table, batch, ["o_custkey"], "o_orderdate")


@_query("""
    SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O')
    UNION ALL SELECT * FROM orders WHERE o_orderstatus IN ('O', 'P')
""")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _load(spark, sf_dir, "orders")
    table = orders.where(F.col("o_orderstatus").isin("F", "O"))
    batch = orders.where(F.col("o_orderstatus").isin("O", "P"))
    return operators.union_all(table, batch.select(*reversed(orders.columns)))


@_query("SELECT DISTINCT * FROM (SELECT * FROM events UNION ALL SELECT * FROM events) AS twice")
def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _load(spark, sf_dir, "events")
    return operators.distinct_rows(operators.union_all(events, events))


@_query("""
    SELECT * FROM events WHERE event_type IN ('view', 'click', 'purchase')
    UNION SELECT * FROM events WHERE event_type IN ('purchase', 'error', 'signup')
""")
def append_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _load(spark, sf_dir, "events")
    return operators.append_distinct(
        _with_types(events, *_STORED_TYPES), _with_types(events, *_BATCH_TYPES)
    )


@_query("""
    SELECT event_id, user_id, event_type,
           CASE WHEN event_type IN ('error', 'signup') THEN value + 1 ELSE value END AS value
    FROM events
""")
def append_distinct_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The batch changes every value; an id the table already has keeps its row.
    events = _load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    batch = _with_types(events, *_BATCH_TYPES).withColumn("value", F.col("value") + 1)
    return operators.append_distinct(_with_types(events, *_STORED_TYPES), batch, ["event_id"])


@_query("""
    SELECT * FROM events WHERE event_type IN ('purchase', 'error', 'signup')
    EXCEPT SELECT * FROM events WHERE event_type IN ('view', 'click', 'purchase')
""")
def rows_to_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _load(spark, sf_dir, "events")
    return operators.rows_to_append(
        _with_types(events, *_STORED_TYPES), _with_types(events, *_BATCH_TYPES)
    )


# ---- files and tables ----------------------------------------------------------


@_query("SELECT * FROM orders")
def delimited_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.scratch_path(spark, "orders.tsv")
    orders = _load(spark, sf_dir, "orders")
    text = orders.write.option("sep", "\t").option("header", True)
    text.option("timestampNTZFormat", FEED_TIMESTAMP).csv(path)
    return sources.read_delimited(spark, path, orders.schema, "\t")


@_query("SELECT * FROM orders")
def blank_header_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.scratch_path(spark, "orders.csv")
    orders = _load(spark, sf_dir, "orders")
    _write_csv_with_blanks(orders, path)
    fields = list(orders.schema.fields)
    for at in (0, 2):
        fields.insert(at, T.StructField(f"_c{at}", T.StringType()))
    return sources.read_delimited(spark, path, T.StructType(fields))


def _write_csv_with_blanks(df: DataFrame, path: str) -> None:
    """CSV whose first and third columns are empty and have a blank header."""
    first, *rest = [F.col(f"`{c}`") for c in df.columns]
    empty = F.lit(None).cast("string")
    # The writer trims names, so both of these come out blank.
    blank = df.select(empty.alias(""), first, empty.alias(" "), *rest)
    text = blank.write.option("header", True).option("timestampNTZFormat", FEED_TIMESTAMP)
    text.option("emptyValue", "").csv(path)


@_query("""
    SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
    FROM customer
""")
def inferred_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.scratch_path(spark, "customer.csv")
    _load(spark, sf_dir, "customer").write.option("header", True).csv(path)
    found = sources.read_delimited(spark, path, None)
    # An inferred integer is int or bigint depending on the values present.
    return found.withColumns({c: F.col(c).cast("bigint") for c in ("c_custkey", "c_nationkey")})


_EVENTS_BY_DAY = """
    SELECT *, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
           CAST(day(ts) AS INTEGER) AS day
    FROM events
"""


def _events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return functions.add_date_parts(_load(spark, sf_dir, "events"), "ts")


@_query(_EVENTS_BY_DAY)
def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.scratch_path(spark, "events")
    events = _events_by_day(spark, sf_dir)
    sinks.publish_partitioned(events, path, events.schema)
    return sources.read_table(spark, path, events.schema)


@_query(_EVENTS_BY_DAY)
def discovered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.scratch_path(spark, "events")
    sinks.publish_partitioned(_events_by_day(spark, sf_dir), path)
    return sources.discover_table(spark, path)


@_query(f"""
    SELECT event_type, count(*) AS num_events FROM ({_EVENTS_BY_DAY}) AS by_day
    WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22' GROUP BY event_type
""")
def pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A report over a range of days: directories outside it are not listed for reading.
    path = session.scratch_path(spark, "events")
    events = _events_by_day(spark, sf_dir)
    sinks.publish_partitioned(events, path, events.schema)
    days = functions.between_days(dt.date(2024, 1, 8), dt.date(2024, 1, 21))
    stored = sources.read_table(spark, path, events.schema).where(days)
    return operators.count_per(stored, ["event_type"], "num_events")


@_query("""
    SELECT * FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def published_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Only the days that lose or gain a row are replaced, in the very table the plan reads.
    path = session.scratch_path(spark, "latest")
    events = _events_by_day(spark, sf_dir)
    stored = operators.latest_per_key(_with_types(events, *_STORED_TYPES), ["user_id"], "ts")
    sinks.publish_partitioned(stored, path, events.schema)
    table = sources.read_table(spark, path, events.schema)
    plans.upsert_days(table, _with_types(events, *_BATCH_TYPES), path, ["user_id"], "ts")
    return sources.read_table(spark, path, events.schema).drop("year", "month", "day")


@_query("SELECT * FROM events")
def published_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Only the day partitions the batch touches are read, and only new rows written.
    path = session.scratch_path(spark, "events")
    events = _events_by_day(spark, sf_dir)
    sinks.publish_partitioned(_with_types(events, *_STORED_TYPES), path, events.schema)
    batch = _with_types(events, *_BATCH_TYPES)
    stored = sources.read_table(spark, path, events.schema).where(operators.touched_days(batch))
    sinks.append_partitioned(operators.rows_to_append(stored, batch), path, events.schema)
    return sources.read_table(spark, path, events.schema).drop("year", "month", "day")


@_query("""
    SELECT event_id, ts, user_id, event_type,
           CASE WHEN event_type IN ('error', 'signup') THEN value + 1 ELSE value END AS value
    FROM events
""")
def published_append_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The batch changes every value; a row whose key its day already has is not added.
    path = session.scratch_path(spark, "events")
    events = _events_by_day(spark, sf_dir)
    sinks.publish_partitioned(_with_types(events, *_STORED_TYPES), path, events.schema)
    batch = _with_types(events, *_BATCH_TYPES).withColumn("value", F.col("value") + 1)
    stored = sources.read_table(spark, path, events.schema).where(operators.touched_days(batch))
    new = operators.rows_to_append(stored, batch, ["event_id", "ts"])
    sinks.append_partitioned(new, path, events.schema)
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    return sources.read_table(spark, path, events.schema).select(columns)


@_query("""
    SELECT event_id, user_id, event_type,
           CASE WHEN event_type IN ('error', 'signup') THEN value + 1 ELSE value END AS value,
           CASE WHEN event_type IN ('error', 'signup') THEN ts + INTERVAL 3 DAY ELSE ts END AS ts
    FROM events
""")
def published_append_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The batch comes three days later, so an id may be stored on any day; an index beside
    # the table says on which, and only those days are read.
    path = session.scratch_path(spark, "events")
    events = _events_by_day(spark, sf_dir)
    sinks.publish_partitioned(_with_types(events, *_STORED_TYPES), path, events.schema)
    later = _load(spark, sf_dir, "events").withColumns(
        {"value": F.col("value") + 1, "ts": F.col("ts") + F.expr("INTERVAL 3 DAY")}
    )
    batch = functions.add_date_parts(_with_types(later, *_BATCH_TYPES), "ts")
    for types in (("purchase", "error"), ("purchase", "error", "signup")):
        some = _with_types(batch, *types)
        _, on_them = sinks.days_with_keys(spark, path, events.schema, some, ["event_id"])
        stored = sources.read_table(spark, path, events.schema).where(on_them)
        new = operators.rows_to_append(stored, some, ["event_id"])
        sinks.append_partitioned(new, path, events.schema)
    columns = ["event_id", "user_id", "event_type", "value", "ts"]
    return sources.read_table(spark, path, events.schema).select(columns)


@_query("""
    SELECT * FROM events
    UNION ALL SELECT * FROM events WHERE event_type = 'click' AND ts < TIMESTAMP '2024-01-15'
""")
def tidied_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Clicks are stored twice; from the 15th on the copies go, before they stay.
    path = session.scratch_path(spark, "events")
    events = _events_by_day(spark, sf_dir)
    sinks.publish_partitioned(events, path, events.schema)
    sinks.append_partitioned(_with_types(events, "click"), path, events.schema)
    plans.tidy_days(spark, path, events.schema, first_day=dt.date(2024, 1, 15))
    return sources.read_table(spark, path, events.schema).drop("year", "month", "day")


@_query("SELECT * FROM events")
def versioned_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = session.scratch_path(spark, "events")
    events = _events_by_day(spark, sf_dir)
    first = sinks.publish_version(_with_types(events, *_STORED_TYPES), root)
    stored = sources.read_table(spark, first, events.schema)
    sinks.publish_version(
        operators.append_distinct(stored, _with_types(events, *_BATCH_TYPES)), root
    )
    newest = sinks.latest_version(spark, root)
    return sources.read_table(spark, newest, events.schema).drop("year", "month", "day")


@_query("""
    SELECT * FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def versioned_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Each version writes only the days it changes and shares the files of all others.
    root = session.scratch_path(spark, "latest")
    events = _events_by_day(spark, sf_dir)
    stored = operators.latest_per_key(_with_types(events, *_STORED_TYPES), ["user_id"], "ts")
    sinks.publish_version(stored, root, events.schema)
    for event_type in _BATCH_TYPES:
        newest = sinks.latest_version(spark, root)
        table = sources.read_table(spark, newest, events.schema)
        batch = _with_types(events, event_type)
        plans.upsert_days(table, batch, root, ["user_id"], "ts", versioned=True)
    newest = sinks.latest_version(spark, root)
    return sources.read_table(spark, newest, events.schema).drop("year", "month", "day")


@_query("""
    SELECT event_id AS rank, user_id, event_type AS from_batch, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def published_upsert_of_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table has columns of its own that are called what an upsert would call its own.
    path = session.scratch_path(spark, "latest")
    events = _events_by_day(spark, sf_dir).select(
        F.col("event_id").alias("rank"), "user_id", F.col("event_type").alias("from_batch"), "ts",
        "year", "month", "day",
    )
    stored, batch = (
        events.where(F.col("from_batch").isin(list(types))) for types in (_STORED_TYPES, _BATCH_TYPES)
    )
    sinks.publish_partitioned(operators.latest_per_key(stored, ["user_id"], "ts"), path, events.schema)
    table = sources.read_table(spark, path, events.schema)
    plans.upsert_days(table, batch, path, ["user_id"], "ts")
    return sources.read_table(spark, path, events.schema).drop("year", "month", "day")


@_query("""
    SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS dollars_spent
    FROM events GROUP BY event_type
    ORDER BY sum(CAST(value AS DECIMAL(18, 2))) DESC, event_type LIMIT 3
""")
def csv_report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.scratch_path(spark, "top_report")
    report = plans.top_k_by_sum(_load(spark, sf_dir, "events"), "event_type", "value", 3)
    sinks.write_report(report, path, "com.databricks.spark.csv", single_file=True)
    back = sources.read_delimited(spark, path, report.schema)
    return back.withColumn("dollars_spent", F.col("dollars_spent").cast("double"))


@_query("""
    SELECT o_orderstatus, count(*) AS num_orders FROM orders GROUP BY o_orderstatus
""")
def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = session.snapshot(_load(spark, sf_dir, "orders").select("o_orderstatus"))
    return operators.count_per(kept, ["o_orderstatus"], "num_orders")


# ---- checks --------------------------------------------------------------------


@_query("""
    WITH altered AS (
        SELECT * REPLACE (CASE WHEN c_mktsegment = 'FURNITURE' THEN c_acctbal + 1
                               ELSE c_acctbal END AS c_acctbal)
        FROM customer WHERE c_mktsegment <> 'BUILDING'
        UNION ALL SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY'),
    both_sides AS (
        SELECT *, 1 AS l, 0 AS r FROM customer
        UNION ALL SELECT *, 0 AS l, 1 AS r FROM altered)
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
           CAST(sum(l) AS BIGINT) AS left_count, CAST(sum(r) AS BIGINT) AS right_count
    FROM both_sides GROUP BY ALL HAVING sum(l) <> sum(r)
""")
def table_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _load(spark, sf_dir, "customer")
    segment = F.col("c_mktsegment")
    changed = F.when(segment == "FURNITURE", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    altered = customer.where(segment != "BUILDING").withColumn("c_acctbal", changed)
    altered = altered.unionByName(customer.where(segment == "MACHINERY"))
    return operators.table_diff(customer, altered)


@_query("""
    SELECT left_count, right_count, CAST(count(*) AS BIGINT) AS left_count_,
           CAST(0 AS BIGINT) AS right_count_
    FROM (SELECT l_linenumber AS left_count, CAST(l_quantity AS BIGINT) AS right_count FROM lineitem)
    WHERE right_count > 40 GROUP BY ALL
""")
def table_diff_of_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The tables have columns of their own that are called what the counts are called.
    lines = _load(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("left_count"), F.col("l_quantity").cast("bigint").alias("right_count")
    )
    return operators.table_diff(lines, lines.where("right_count <= 40"))


@_query("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id,
           event_type <> 'error' AS valid
    FROM events
""")
def null_key_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(F.col("event_type") != "error", F.col("user_id"))
    events = _load(spark, sf_dir, "events").select("event_id", known.alias("user_id"))
    good, bad = operators.split_invalid_keys(events, ["user_id"])
    return good.withColumn("valid", F.lit(True)).unionByName(bad.withColumn("valid", F.lit(False)))


@_query("""
    SELECT o_custkey, o_orderdate, count(*) AS copies FROM orders
    GROUP BY o_custkey, o_orderdate HAVING count(*) > 1
""")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.duplicate_keys(_load(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"])


@_query("""
    SELECT o_custkey, count(*) AS rows FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
    GROUP BY o_custkey
""")
def unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    solvent = _load(spark, sf_dir, "customer").where("c_acctbal >= 0")
    entities = solvent.withColumnRenamed("c_custkey", "o_custkey")
    return operators.unmatched(_load(spark, sf_dir, "orders"), entities, "o_custkey")


# ---- the whole run, from delivered files to written reports ---------------------

_SPELLINGS = {"click": "amzn", "view": "Walmrt", "purchase": "Home depot", "error": "Cvs"}


def _deliver(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Both feeds written from driver tables: events as auths, customers as accounts.

    Each customer comes in two versions, of which the older has another name.
    """
    auths = session.scratch_path(spark, "auths.csv")
    spelling = F.col("event_type")
    for event_type, merchant in _SPELLINGS.items():
        spelling = F.when(F.col("event_type") == event_type, merchant).otherwise(spelling)
    events = _load(spark, sf_dir, "events").select(
        F.concat(F.lit("A"), "user_id"), "ts", "event_type", F.lit("USA"), "value", spelling
    )
    _write_csv_with_blanks(events.toDF(*AUTHS.names), auths)

    accounts = session.scratch_path(spark, "accounts.tsv")
    customer = _load(spark, sf_dir, "customer")
    updated = F.date_add(F.lit(dt.date(2021, 1, 1)), F.col("c_nationkey")).cast("timestamp_ntz")
    versions = [
        customer.select(
            F.concat(F.lit("A"), "c_custkey"), name, "c_mktsegment",
            F.lit(dt.date(2020, 1, 1)).cast("timestamp_ntz"), moment,
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0"), F.lit("USA"), F.lit("active"),
        ).toDF(*ACCOUNTS.names)
        for name, moment in (
            (F.col("c_name"), updated),
            (F.lit("former"), updated - F.expr("INTERVAL 1 DAY")),
        )
    ]
    text = versions[0].unionByName(versions[1]).write.option("sep", "\t").option("header", True)
    text.option("timestampNTZFormat", FEED_TIMESTAMP).csv(accounts)
    return auths, accounts


def _run_twice(spark: SparkSession, sf_dir: str) -> plans.PipelineResult:
    """The same delivery merged twice, as after a failure; it must count once."""
    auths, accounts = _deliver(spark, sf_dir)
    warehouse = session.scratch_path(spark, "warehouse")
    reports = session.scratch_path(spark, "reports")
    plans.run(spark, auths, accounts, warehouse, reports)
    return plans.run(spark, auths, accounts, warehouse, reports)


# The feed has whole seconds, and a row is identified by all its columns.
_DELIVERED = """
    SELECT DISTINCT user_id, date_trunc('second', ts) AS ts, event_type, value FROM events
"""


@_query(f"""
    SELECT c_name AS first_name, c_mktsegment AS last_name,
           strftime(ts, '%Y-%m-%d') AS transmit_time, count(*) AS num_transactions
    FROM ({_DELIVERED}) AS delivered JOIN customer ON user_id = c_custkey
    GROUP BY user_id, c_name, c_mktsegment, strftime(ts, '%Y-%m-%d')
""")
def full_run_daily_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = _run_twice(spark, sf_dir).daily_report
    schema = "first_name string, last_name string, transmit_time string, num_transactions bigint"
    return sources.read_delimited(spark, written, T.StructType.fromDDL(schema))


@_query(f"""
    SELECT CASE event_type WHEN 'click' THEN 'amazon' WHEN 'view' THEN 'walmart'
                           WHEN 'purchase' THEN 'home_depot' WHEN 'error' THEN 'cvs'
                           ELSE event_type END AS merchant_name,
           CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS dollars_spent
    FROM ({_DELIVERED}) AS delivered GROUP BY event_type
    ORDER BY sum(CAST(value AS DECIMAL(18, 2))) DESC, merchant_name LIMIT 3
""")
def full_run_merchant_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = _run_twice(spark, sf_dir).merchant_report
    schema = T.StructType.fromDDL("merchant_name string, dollars_spent double")
    return sources.read_delimited(spark, written, schema)


# The operators for training text, where their subpackage is installed.
try:
    import corpus_pipeline
    from tallyhouse.llm import queries as llm_queries
except ImportError:
    pass
else:
    _QUERIES.update(llm_queries.QUERIES)
    _QUERIES["pipeline"] = corpus_pipeline.run
    _ORACLES.update(llm_queries.ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        _ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: events per customer and day."""
    return daily_activity(spark, "/root/testdata/sf0.001")


def _ready(query: Query) -> Query:
    """`query` in a session whose Python workers find this folder and that has a shared one.

    A local session without `spark.checkpoint.dir` is given a folder of its own.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers = spark.sparkContext.environment
        paths = workers.get("PYTHONPATH", "").split(os.pathsep)
        if _HERE not in paths:
            workers["PYTHONPATH"] = os.pathsep.join([_HERE, *filter(None, paths)])
        local = spark.sparkContext.master.split("[")[0] == "local"
        if local and not spark.conf.get("spark.checkpoint.dir", None):
            spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tallyhouse-"))
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _ready(query) for name, query in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
