"""spark-submit entry: one delivery of each feed into the warehouse, then the reports."""

from __future__ import annotations

import argparse
import datetime as dt

from tallyhouse.plans.pipeline import run
from tallyhouse.session import get_session


def main(argv: list[str] | None = None) -> None:
    ask = argparse.ArgumentParser(prog="tallyhouse", description=__doc__)
    ask.add_argument("--auths", required=True, help="delivered authorizations (CSV)")
    ask.add_argument("--accounts", required=True, help="delivered accounts (TSV)")
    ask.add_argument("--warehouse", required=True, help="folder of the tables")
    ask.add_argument("--reports", required=True, help="folder of the reports")
    ask.add_argument("--k", type=int, default=3, help="merchants in the ranking")
    ask.add_argument("--first-day", type=dt.date.fromisoformat)
    ask.add_argument("--last-day", type=dt.date.fromisoformat)
    ask.add_argument("--batch-id", help="names the quarantine folder of this delivery")
    ask.add_argument("--zone", default="UTC", help="time zone the feeds are written in")
    ask.add_argument("--report-format", default="csv")
    ask.add_argument(
        "--versioned", action="store_true", help="accounts as new folders, for object stores"
    )
    ask.add_argument("--merchants", help="CSV of merchant spellings: columns spelling, name")
    ask.add_argument(
        "--fold", action="store_true", help="ignore case and outer spaces of merchant spellings"
    )
    ask.add_argument(
        "--auth-key", action="append", dest="auth_keys", metavar="COLUMN",
        help="a column of an authorization's identity, once for each; all columns by default",
    )
    given = vars(ask.parse_args(argv))
    spark = get_session()
    if given["merchants"] is None:
        del given["merchants"]
    else:
        given["merchants"] = spark.read.csv(given["merchants"], header=True)
    print(run(spark, **given))


if __name__ == "__main__":
    main()
