"""Both deliveries in, both reports out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.dates import between_days
from tallyhouse.operators.checks import unmatched
from tallyhouse.plans.ingest import (
    Ingested,
    Merchants,
    ingest_accounts,
    ingest_auths,
    read_accounts,
    stored_bytes,
)
from tallyhouse.plans.reports import daily_activity, top_k_by_sum
from tallyhouse.schemas import ACCOUNTS, AUTHS, MERCHANT_NAMES
from tallyhouse.session import for_tables, size_shuffles
from tallyhouse.sinks.report import write_report
from tallyhouse.sources.warehouse import read_table

# The folders the two reports go to.
DAILY_REPORT = "amount_of_transactions_report"
MERCHANT_REPORT = "top_3_merchants_report"


class PipelineResult(NamedTuple):
    auths: Ingested
    accounts: Ingested
    daily_report: str
    merchant_report: str
    rows_unmatched: int


def run(
    spark: SparkSession,
    auths: str,
    accounts: str,
    warehouse: str,
    reports: str,
    k: int = 3,
    first_day: dt.date | None = None,
    last_day: dt.date | None = None,
    batch_id: str | None = None,
    zone: str = "UTC",
    report_format: str = "csv",
    versioned: bool = False,
    merchants: Merchants = MERCHANT_NAMES,
    fold: bool = False,
    auth_keys: Sequence[str] | None = None,
) -> PipelineResult:
    """Merge one delivery of each feed into the warehouse and write the reports.

    All paths may be on any file system Spark can reach. The reports cover the
    whole table, or the days given; then other days' files are not read. On an
    object store ask for `versioned` accounts, since it cannot rename a folder.
    `merchants`, `fold` and `auth_keys` are those of `ingest_auths`. The result
    counts the transactions of unknown accounts, which the daily report leaves
    out. The caller's session is not changed: each step has its own.
    """
    warehouse, reports = warehouse.rstrip("/"), reports.rstrip("/")
    tables = {feed.name: f"{warehouse}/{feed.name}" for feed in (AUTHS, ACCOUNTS)}
    quarantine = f"{warehouse}/quarantine"
    daily, ranking = f"{reports}/{DAILY_REPORT}", f"{reports}/{MERCHANT_REPORT}"
    with ThreadPoolExecutor(3) as pool:

        def start(work, *args, **kwargs):
            return pool.submit(inheritable_thread_target(spark)(work), *args, **kwargs)

        # The two merges share no table, so their jobs overlap on the cluster.
        jobs = [
            start(
                ingest_auths, spark, auths, tables["auths"], quarantine, batch_id, merchants,
                zone, fold, auth_keys,
            ),
            start(
                ingest_accounts, spark, accounts, tables["accounts"], quarantine, batch_id,
                zone=zone, versioned=versioned,
            ),
        ]
        done = [job.result() for job in jobs]

        own = for_tables(spark, zone)
        facts = read_table(own, tables["auths"], AUTHS.table_schema)
        facts = facts.where(between_days(first_day, last_day))
        entities = read_accounts(own, tables["accounts"], versioned)
        size_shuffles(own, spark, sum(stored_bytes(own, table) for table in tables.values()))
        activity = daily_activity(facts, entities, by_partition=True, unique=True)
        left_out = unmatched(facts, entities, AUTHS.key).agg(F.coalesce(F.sum("rows"), F.lit(0)))
        written = [
            start(write_report, activity, daily, report_format),
            start(write_report, top_k_by_sum(facts, k=k), ranking, report_format, True),
        ]
        counted = start(left_out.first)
        for job in written:
            job.result()
    return PipelineResult(*done, daily, ranking, counted.result()[0])
