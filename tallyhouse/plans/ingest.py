"""From a delivered file to a merged table."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.folders import Folder
from tallyhouse.functions.dates import add_date_parts, between_days, day_code
from tallyhouse.functions.names import canonicalize, canonicalize_from_table
from tallyhouse.operators.merge import (
    change_columns,
    day_codes,
    on_days,
    ranked_changes,
    rows_to_append,
    upsert_latest,
)
from tallyhouse.operators.project import conform_names, fresh, keep
from tallyhouse.schemas import ACCOUNTS, AUTHS, DAY_PARTS, MERCHANT_NAMES, MONEY, Feed
from tallyhouse.session import TASK_BYTES, for_tables, size_shuffles
from tallyhouse.sinks.key_index import days_with_keys
from tallyhouse.sinks.lease import writing
from tallyhouse.sinks.publish import (
    append_partitioned,
    day_folder,
    latest_version,
    publish_days,
    publish_partitioned,
    publish_version,
    publish_version_days,
    restore_interrupted,
    swap_is_open,
    sweep_deliveries,
)
from tallyhouse.sources.delimited import RAW_LINE, read_feed
from tallyhouse.sources.warehouse import read_table

# Spelling -> name, as a short map or as a table with these two columns.
Merchants = Mapping[str, str] | DataFrame
SPELLING, NAME = "spelling", "name"


class Ingested(NamedTuple):
    """What became of one batch."""

    table: str
    rows_read: int
    rows_quarantined: int
    quarantine: str | None
    rows_doubtful: int = 0
    doubtful: str | None = None
    bytes_landed: int = 0


def conform_accounts(raw: DataFrame) -> DataFrame:
    """Account rows under the table's names, with their day."""
    return add_date_parts(conform_names(raw, ACCOUNTS.names), ACCOUNTS.moment)


def conform_auths(
    raw: DataFrame, merchants: Merchants = MERCHANT_NAMES, fold: bool = False
) -> DataFrame:
    """Authorization rows under the table's names, merchants in one spelling, with their day."""
    wanted = [*AUTHS.names, *(c for c in raw.columns if c == RAW_LINE)]
    named = conform_names(keep(raw, wanted), AUTHS.names)
    if isinstance(merchants, DataFrame):
        # The table belongs to the caller's session; it is planned with the batch's.
        listed = canonicalize_from_table(named, "merchant_name", merchants, SPELLING, NAME, fold)
    else:
        listed = canonicalize(named, "merchant_name", merchants, fold)
    return add_date_parts(listed, AUTHS.moment)


def delivery_name(spark: SparkSession, source: str) -> str:
    """A name that follows from the delivered files: where they are, their sizes and times.

    The same delivery has the same name each time it is merged. Files are listed, not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    mark = F.xxhash64("path", "length", "modificationTime")
    sums = files.agg(F.sum(mark.cast("decimal(38,0)")), F.count(F.lit(1))).first()
    return f"{int(sums[0] or 0) % 2**64:016x}-{sums[1]}"


def stored_bytes(spark: SparkSession, table: str, codes: Sequence[int] | None = None) -> int:
    """Bytes of a table's files, or of some days' files: what a plan that reads them reads."""
    if codes is None:
        return Folder(spark, table).size()
    return sum(Folder(spark, f"{table}/{_folder_of(code)}").size() for code in codes)


def _folder_of(code: int) -> str:
    return day_folder(code // 10000, code // 100 % 100, code % 100)


def _broken(feed: Feed) -> Column:
    return F.col(feed.key).isNull() | F.col(feed.moment).isNull()


def _doubtful(df: DataFrame, feed: Feed) -> Column:
    """A cell that was not of its type, or an amount that is no amount of money."""
    out = F.col(RAW_LINE).isNotNull() if RAW_LINE in df.columns else F.lit(False)
    for field in feed.table_schema.fields:
        if isinstance(field.dataType, T.DoubleType):
            value = F.col(field.name)
            out = out | (value.isNotNull() & value.try_cast(MONEY).isNull())
    return out & ~_broken(feed)


@contextmanager
def _landed(
    df: DataFrame, feed: Feed, table: str, quarantine: str, batch_id: str
) -> Iterator[tuple[DataFrame, Ingested]]:
    """The batch's rows with key and day, once the others are set aside.

    The merge reads its batch more than once, so the text is parsed a single
    time into columns beside the table, where the copy also outlives any
    executor, and counted on the way. It is removed at the end. Rows kept
    though a cell of theirs is not are put down with their text as well.
    """
    spark = df.sparkSession
    landing = Folder(spark, table).beside(f"landed-{uuid.uuid4().hex}")
    try:
        seen = Observation()
        broken, doubtful = _broken(feed), _doubtful(df, feed)
        df.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count_if(broken).alias("broken"),
            F.count_if(doubtful).alias("doubtful"),
        ).write.parquet(landing.within("rows").path)
        counts = seen.get
        landed = spark.read.schema(df.schema).parquet(landing.within("rows").path)
        places = {}
        for kind, name, rows in (("broken", feed.name, broken), ("doubtful", f"{feed.name}_doubtful", doubtful)):
            if counts[kind]:
                places[kind] = f"{quarantine.rstrip('/')}/{name}/batch={batch_id}"
                landed.where(rows).write.mode("overwrite").parquet(places[kind])
        yield (
            keep(landed.where(~broken), feed.table_schema.fieldNames()),
            Ingested(
                table, counts["rows"], counts["broken"], places.get("broken"),
                counts["doubtful"], places.get("doubtful"), landing.size(),
            ),
        )
    finally:
        landing.delete()


def ingest_auths(
    spark: SparkSession,
    source: str,
    table: str,
    quarantine: str,
    batch_id: str | None = None,
    merchants: Merchants = MERCHANT_NAMES,
    zone: str = "UTC",
    fold: bool = False,
    keys: Sequence[str] | None = None,
) -> Ingested:
    """Add a delivery of authorizations to the table; exact copies are stored once.

    Only the day partitions the batch touches are read, and only new rows are
    written, so the cost follows the batch and not the table. With `keys` rows
    are the same if these columns are; unless the time is among them a copy may
    lie on any day, and an index beside the table says which days can hold one.
    One delivery at a time: two at once could both store a row they share, so
    another that begins meanwhile raises `TableBusy`.
    """
    own = for_tables(spark, zone)
    batch_id = batch_id or delivery_name(own, source)
    rows = conform_auths(read_feed(own, AUTHS, source), merchants, fold)
    with _landed(rows, AUTHS, table, quarantine, batch_id) as (batch, summary):
        with writing(own, table):
            restore_interrupted(own, table)
            days = day_codes(batch)
            if days:
                schema = AUTHS.table_schema
                if keys is None or AUTHS.moment in keys:
                    on_them = on_days(days)
                else:
                    size_shuffles(own, spark, stored_bytes(own, table) + summary.bytes_landed)
                    days, on_them = days_with_keys(own, table, schema, batch, keys)
                size_shuffles(own, spark, stored_bytes(own, table, days) + summary.bytes_landed)
                stored = read_table(own, table, schema).where(on_them)
                append_partitioned(rows_to_append(stored, batch, keys), table, schema)
    return summary


def tidy_auths(
    spark: SparkSession, table: str, first_day: dt.date | None = None,
    last_day: dt.date | None = None, version_root: str | None = None,
) -> int:
    """`tidy_days` of the authorizations.

    `ingest_auths` stores no copies and never rewrites. This is for a table that
    something else filled, or that many small deliveries have left in many small
    files.
    """
    return tidy_days(spark, table, AUTHS.table_schema, first_day, last_day, version_root)


def tidy_days(
    spark: SparkSession, table: str, schema: T.StructType, first_day: dt.date | None = None,
    last_day: dt.date | None = None, version_root: str | None = None,
) -> int:
    """Rewrite the days from `first_day` to `last_day` without copies, in a few large files each.

    Other days keep their files. One shuffle: by day and a hash of the row, which
    brings copies together and cuts a large day into several files. With
    `version_root` the result, then of the whole table, becomes a version there,
    for object stores. Returns the number of rows written.
    """
    own = for_tables(spark)
    if not (Folder(own, table).exists() or swap_is_open(own, table)):
        raise FileNotFoundError(f"there is no table at {table}")
    if version_root and (first_day or last_day):
        raise ValueError("a version holds all days")
    with writing(own, table):
        restore_interrupted(own, table)
        rows = _tidied(own, table, schema, first_day, last_day, version_root)
        sweep_deliveries(own, table)
    return rows


def _tidied(
    own: SparkSession, table: str, schema: T.StructType, first_day: dt.date | None,
    last_day: dt.date | None, version_root: str | None,
) -> int:
    some = read_table(own, table, schema).where(between_days(first_day, last_day))
    # The days are those of the folders; no column is read.
    per_day = some.select(*DAY_PARTS).distinct().collect()
    if not per_day:
        return 0
    sizes = {tuple(row): Folder(own, f"{table}/{day_folder(*row)}").size() for row in per_day}
    pieces = {day: size // TASK_BYTES + 1 for day, size in sizes.items()}
    large = {y * 10000 + m * 100 + d: n for (y, m, d), n in pieces.items() if n > 1}
    of_day = F.lit(1)
    if large:
        known = F.create_map(*[F.lit(x) for pair in sorted(large.items()) for x in pair])
        of_day = F.coalesce(F.element_at(known, day_code()), of_day)
    piece = fresh("piece", some.columns)
    marked = some.withColumn(piece, F.pmod(F.xxhash64(*some.columns), of_day))
    dealt = marked.repartition(sum(pieces.values()), *DAY_PARTS, piece)
    rows = dealt.distinct().drop(piece)
    if version_root:
        path = publish_version(rows, version_root, schema, at_least=len(pieces))
        return read_table(own, path, schema).count()
    folders = [day_folder(*day) for day in sorted(pieces)]
    return publish_days(rows, table, folders, schema, at_least=len(pieces), rebalance=False)


def read_accounts(spark: SparkSession, table: str, versioned: bool = False) -> DataFrame:
    """The accounts as last put in place; empty before the first delivery."""
    path = latest_version(spark, table) if versioned else table
    if path is None:
        return spark.createDataFrame([], ACCOUNTS.table_schema)
    return read_table(spark, path, ACCOUNTS.table_schema)


def ingest_accounts(
    spark: SparkSession,
    source: str,
    table: str,
    quarantine: str,
    batch_id: str | None = None,
    zone: str = "UTC",
    versioned: bool = False,
) -> Ingested:
    """Bring a delivery of accounts into the table; the latest version of each stays.

    An account moves to another day with an update, and a day it leaves must lose
    it. So the stored rows of the batch's accounts are found, and only the days
    that lose or gain a row are written anew, beside the table, and put in place.
    `versioned`, for object stores, writes them beside each other instead, and a
    new version below `table` names the folder of each day. Read it with
    `read_accounts`.
    """
    own = for_tables(spark, zone)
    batch_id = batch_id or delivery_name(own, source)
    rows = conform_accounts(read_feed(own, ACCOUNTS, source))
    with _landed(rows, ACCOUNTS, table, quarantine, batch_id) as (batch, summary):
        with writing(own, table):
            if not versioned:
                restore_interrupted(own, table)
            there = latest_version(own, table) if versioned else Folder(own, table).exists()
            stored = read_accounts(own, table, versioned)
            size_shuffles(own, spark, stored_bytes(own, table) + summary.bytes_landed)
            if there:
                upsert_days(stored, batch, table, [ACCOUNTS.key], ACCOUNTS.moment, versioned)
            else:
                merged = upsert_latest(stored, batch, [ACCOUNTS.key], ACCOUNTS.moment)
                publish = publish_version if versioned else publish_partitioned
                publish(merged, table, ACCOUNTS.table_schema)
    return summary


def upsert_days(
    stored: DataFrame, batch: DataFrame, table: str, keys: Sequence[str], newest: str,
    versioned: bool = False,
) -> None:
    """Bring `batch` into the table that `stored` reads, one row per key, the latest.

    Only days that lose or gain a row are written anew; files of others stay. A
    day left without rows goes away. With `versioned` `stored` is the newest
    version below `table`, and the result a version that shares the other days.
    """
    spark = stored.sparkSession
    late, rank = change_columns(stored)
    kept = Folder(spark, table).beside(f"changes-{uuid.uuid4().hex}")
    with writing(spark, table):
        try:
            found = ranked_changes(stored, batch, keys, newest)
            found.write.parquet(kept.within("rows").path)
            changes = spark.read.schema(found.schema).parquet(kept.within("rows").path)
            is_first = F.col(rank) == 1
            # A stored row that stays first changes nothing.
            per_day = changes.groupBy(day_code().alias("code")).agg(
                F.bool_or(F.col(late) == is_first).alias("touched"),
                F.count_if(~F.col(late)).alias("old"), F.count_if(is_first).alias("first"),
            ).where("touched AND code IS NOT NULL").collect()
            codes = sorted(row["code"] for row in per_day)
            if not codes:
                return
            there = stored.where(on_days(codes))
            first = changes.where(is_first & on_days(codes)).select(*stored.columns)
            rest = there.join(batch.select(*keys).distinct(), list(keys), "left_anti")
            rows = rest.select(*stored.columns).unionByName(first)
            exactly = there.count() + sum(row["first"] - row["old"] for row in per_day)
            publish = publish_version_days if versioned else publish_days
            folders = [_folder_of(code) for code in codes]
            publish(rows, table, folders, stored.schema, exactly=exactly)
        finally:
            kept.delete()
