"""Both feeds through the whole run."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest

from samples import ACCOUNTS_TSV, AUTHS_CSV
from tallyhouse import plans, sources
from tallyhouse.__main__ import main
from tallyhouse.operators import table_diff
from tallyhouse.schemas import ACCOUNTS, AUTHS


class Place:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.warehouse, self.reports = str(folder / "warehouse"), str(folder / "reports")

    def run(self, auths=AUTHS_CSV, accounts=ACCOUNTS_TSV, **options):
        (self.folder / "auths.csv").write_text(auths)
        (self.folder / "accounts.tsv").write_text(accounts)
        return plans.run(
            self.spark, str(self.folder / "auths.csv"), str(self.folder / "accounts.tsv"),
            self.warehouse, self.reports, **options,
        )

    def table(self, feed):
        return sources.read_table(self.spark, f"{self.warehouse}/{feed.name}", feed.table_schema)

    def report(self, path):
        (file,) = (self.folder / "reports" / path).glob("part-*.csv")
        return file.read_text().splitlines()


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path)


DAILY = "amount_of_transactions_report"
TOP = "top_3_merchants_report"


def with_auths(*lines):
    return AUTHS_CSV + "".join(line + "\n" for line in lines)


def with_accounts(*lines):
    return ACCOUNTS_TSV + "".join("\t".join(line) + "\n" for line in lines)


def test_known_results_from_nothing_and_again(place):
    for _ in range(2):
        result = place.run()
        assert (result.auths.rows_read, result.auths.rows_quarantined) == (27, 0)
        assert (result.accounts.rows_read, result.accounts.rows_quarantined) == (9, 0)
        assert place.table(AUTHS).count() == 27
        accounts = place.table(ACCOUNTS).collect()
        assert len(accounts) == len({a.account_id for a in accounts}) == 7
        updated = {a.first_name: (a.year, a.month, a.day) for a in accounts}
        assert updated["Jane"] == (2022, 1, 7) and updated["John"] == (2022, 2, 7)
        assert place.report(TOP) == [
            "merchant_name,dollars_spent", "amazon,1046.66", "home_depot,469.09", "walmart,162.47"
        ]
        daily = place.report(DAILY)
        assert daily[0] == "first_name,last_name,transmit_time,num_transactions"
        assert daily[1:] == sorted(daily[1:], key=lambda x: x.split(",")[2])
        counts = Counter(int(x.rsplit(",", 1)[1]) for x in daily[1:])
        assert counts == {1: 20, 2: 2, 3: 1}
        assert "Mary,Sue,2022-02-03,3" in daily


def test_the_whole_ranking(place):
    result = place.run(k=100)
    rest = ["walgreens,80.44", "cvs,46.65", "target,35.47", "google,21.77"]
    assert place.report(result.merchant_report)[4:] == rest


def test_result_does_not_depend_on_the_session_zone(place, spark):
    place.run()
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        place.run()
        assert spark.conf.get("spark.sql.session.timeZone") == "America/Chicago"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert place.table(AUTHS).count() == 27


def test_rows_without_key_or_time_are_set_aside_whole(place, spark):
    result = place.run(
        with_auths(",,,2/1/2022 2:20:30,debit,USA,1.00,amazon", ",x,,bad,debit,USA,1.00,amazon",
                   ",y,,2/1/2022 2:20:30,debit,USA,,corner shop"),
        with_accounts(("", "No", "Body", "2/7/2021 2:20:30", "2/7/2021 2:20:30", "1", "USA", "active")),
        batch_id="b1",
    )
    assert result.auths.rows_quarantined == 2 and result.auths.rows_read == 30
    held = spark.read.parquet(result.auths.quarantine)
    assert result.auths.quarantine.endswith("/quarantine/auths/batch=b1")
    assert {(r.account_id, r._raw_line) for r in held.collect()} == {
        (None, None), ("x", ",x,,bad,debit,USA,1.00,amazon")
    }
    assert result.accounts.rows_quarantined == 1
    assert place.table(AUTHS).count() == 28  # a missing amount is not a reason to hold a row
    assert place.table(AUTHS).where("account_id = 'y'").first().amount is None
    assert place.table(ACCOUNTS).count() == 7


def test_a_batch_with_nothing_valid_changes_nothing(place):
    place.run()
    header = AUTHS_CSV.splitlines()[0] + "\n"
    result = place.run(header + ",,,2/1/2022 2:20:30,debit,USA,1.00,amazon\n",
                       ACCOUNTS_TSV.splitlines()[0] + "\n")
    assert (result.auths.rows_read, result.auths.rows_quarantined) == (1, 1)
    assert place.table(AUTHS).count() == 27 and place.table(ACCOUNTS).count() == 7


def test_empty_feeds_from_nothing(place):
    place.run(AUTHS_CSV.splitlines()[0] + "\n", ACCOUNTS_TSV.splitlines()[0] + "\n")
    assert place.table(AUTHS).isEmpty() and place.table(ACCOUNTS).isEmpty()
    place.run()
    assert place.table(AUTHS).count() == 27 and place.table(ACCOUNTS).count() == 7


def test_spellings_of_one_merchant_are_one_purchase(place):
    row = ",3fd41ae8-2d94-4b2b-94da-7677c67a6b00,,2/7/2022 2:20:30,debit,USA,44.33,"
    place.run(with_auths(row + "amzn"))  # the sample has it as amazon
    assert place.table(AUTHS).count() == 27


def test_new_rows_arrive_in_old_and_new_days(place):
    place.run()
    kept = set((place.folder / "warehouse" / "auths").rglob("*.parquet"))
    header = AUTHS_CSV.splitlines()[0] + "\n"
    place.run(header + ",x,,2/7/2022 2:20:30,debit,USA,1.00,amazon\n"
              + ",x,,3/1/2022 2:20:30,debit,USA,1.00,amazon\n" + AUTHS_CSV.splitlines()[1] + "\n")
    assert place.table(AUTHS).count() == 29
    # What was stored has not been written again.
    now = set((place.folder / "warehouse" / "auths").rglob("*.parquet"))
    assert kept < now and len(now - kept) == 2


def test_an_account_moves_and_a_late_version_loses(place):
    place.run()
    line = "{}\tJane\t{}\t5/7/2021 9:16:05\t{}\t02134\tUSA\tactive\n"
    header, jane = ACCOUNTS_TSV.splitlines()[0] + "\n", "76ed7880-1f89-40b0-92a9-de8e31a1cf06"
    place.run(accounts=header + line.format(jane, "Roe", "3/1/2022 1:0:0"))
    place.run(accounts=header + line.format(jane, "Late", "2/1/2022 1:0:0"))
    (row,) = place.table(ACCOUNTS).where(f"account_id = '{jane}'").collect()
    assert (row.last_name, row.postal_code, row.month, row.day) == ("Roe", "02134", 3, 1)
    days = place.folder / "warehouse" / "accounts" / "year=2022"
    assert not (days / "month=1" / "day=7").exists()
    assert any("Jane,Roe" in x for x in place.report(DAILY))


def test_batches_in_any_order_give_the_same_accounts(place, spark, tmp_path):
    header, *lines = ACCOUNTS_TSV.splitlines(keepends=True)
    other = Place(spark, tmp_path / "other")
    other.folder.mkdir()
    for at, batches in ((place, (lines[:5], lines[5:])), (other, (lines[5:], lines[:5]))):
        for batch in batches:
            at.run(accounts=header + "".join(batch))
    assert table_diff(place.table(ACCOUNTS), other.table(ACCOUNTS)).isEmpty()


def test_reports_over_some_days(place):
    place.run(first_day=dt.date(2022, 2, 8), last_day=dt.date(2022, 2, 9))
    days = {x.split(",")[2] for x in place.report(DAILY)[1:]}
    assert days == {"2022-02-08", "2022-02-09"}
    assert place.report(TOP)[1:] == ["target,24.34", "amazon,16.22", "cvs,3.67"]
    assert place.table(AUTHS).count() == 27


def test_transactions_of_unknown_accounts_are_stored_but_not_reported(place):
    place.run(with_auths(",nobody,,2/1/2022 2:20:30,debit,USA,5000.00,corner shop"))
    assert place.table(AUTHS).count() == 28
    assert sum(int(x.rsplit(",", 1)[1]) for x in place.report(DAILY)[1:]) == 27
    assert place.report(TOP)[1] == "corner shop,5000.00"
    assert place.run().rows_unmatched == 1


def test_command_line(place):
    (place.folder / "a.csv").write_text(AUTHS_CSV)
    (place.folder / "a.tsv").write_text(ACCOUNTS_TSV)
    main(["--auths", str(place.folder / "a.csv"), "--accounts", str(place.folder / "a.tsv"),
          "--warehouse", place.warehouse, "--reports", place.reports, "--k", "1"])
    assert place.report(TOP) == ["merchant_name,dollars_spent", "amazon,1046.66"]


def test_command_line_with_merchants_and_keys(place):
    (place.folder / "a.csv").write_text(with_auths(",x,,2/7/2022 2:20:30,debit,USA,9000.00, AMAZON.com "))
    (place.folder / "a.tsv").write_text(ACCOUNTS_TSV)
    (place.folder / "m.csv").write_text("spelling,name\namazon.com,river\namazon,river\namzn,river\n")
    main(["--auths", str(place.folder / "a.csv"), "--accounts", str(place.folder / "a.tsv"),
          "--warehouse", place.warehouse, "--reports", place.reports, "--k", "1", "--fold",
          "--merchants", str(place.folder / "m.csv"), "--auth-key", "account_id", "--auth-key", "transmit_time"])
    # Of two rows of one account and second the lesser stays; the other has 44.33.
    assert place.report(TOP) == ["merchant_name,dollars_spent", "river,10002.33"]


def test_identity_by_key_finds_the_row_on_another_day(place, spark):
    place.run()
    account = "3fd41ae8-2d94-4b2b-94da-7677c67a6b00"
    line = f",{account},,9/9/2023 2:20:30,debit,USA,1.00,amazon\n"
    header = AUTHS_CSV.splitlines()[0] + "\n"
    place.run(header + line, auth_keys=["account_id"])
    assert place.table(AUTHS).count() == 27
    place.run(header + line, auth_keys=["account_id", "transmit_time"])
    assert place.table(AUTHS).count() == 28


def test_doubtful_amounts_are_kept_counted_and_put_down(place, spark):
    lines = [",x,,2/7/2022 2:20:30,debit,USA," + a + ",shop" for a in ("1e30", "NaN", "Infinity", "4x", "5.00")]
    result = place.run(with_auths(*lines), batch_id="b1")
    assert (result.auths.rows_quarantined, result.auths.rows_doubtful) == (0, 4)
    held = spark.read.parquet(result.auths.doubtful)
    assert result.auths.doubtful.endswith("/quarantine/auths_doubtful/batch=b1")
    assert sorted(str(r.amount) if r.amount is not None else r._raw_line.split(",")[6] for r in held.collect()) \
        == ["1e+30", "4x", "inf", "nan"]
    assert place.report(TOP)[1] == "shop,1000000000000000000000000000005.00"
    place.run()  # a clean delivery after it gives both reports, too
    assert place.report(TOP)[1].startswith("shop,") and len(place.report(DAILY)) == 24


def test_quarantine_is_the_same_for_the_same_delivery(place, spark):
    bad = with_auths(",,,2/1/2022 2:20:30,debit,USA,1.00,amazon")
    result = place.run(bad)
    again = plans.ingest_auths(
        spark, str(place.folder / "auths.csv"), f"{place.warehouse}/auths", f"{place.warehouse}/quarantine"
    )
    assert again.quarantine == result.auths.quarantine
    assert spark.read.parquet(f"{place.warehouse}/quarantine/auths").count() == 1


def test_overlapping_runs_in_other_zones_do_not_mix(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    zones = ["Asia/Tokyo", "America/Chicago", "UTC"]
    before = spark.conf.get("spark.sql.session.timeZone")
    places = []
    for n in range(len(zones)):
        (tmp_path / str(n)).mkdir()
        places.append(Place(spark, tmp_path / str(n)))
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda at, zone: at.run(zone=zone), places, zones))
    assert spark.conf.get("spark.sql.session.timeZone") == before
    for at in places:
        days = {(r.account_id, r.merchant_name, r.amount): (r.month, r.day) for r in at.table(AUTHS).collect()}
        assert days == {(r.account_id, r.merchant_name, r.amount): (r.month, r.day)
                        for r in places[2].table(AUTHS).collect()}
    moments = [at.table(AUTHS).agg({"transmit_time": "min"}).first()[0] for at in places]
    assert moments[0] < moments[2] < moments[1]


def test_files_of_days_an_upsert_does_not_touch_stay(place):
    place.run()
    accounts = place.folder / "warehouse" / "accounts"
    before = {f: f.stat().st_mtime_ns for f in accounts.rglob("*.parquet")}
    header, jane = ACCOUNTS_TSV.splitlines()[0] + "\n", "76ed7880-1f89-40b0-92a9-de8e31a1cf06"
    place.run(accounts=header + f"{jane}\tJane\tRoe\t5/7/2021 9:16:05\t3/1/2022 1:0:0\t02134\tUSA\tactive\n")
    after = {f: f.stat().st_mtime_ns for f in accounts.rglob("*.parquet")}
    gone = {f for f in before if f not in after}
    assert gone and all("month=1/day=7" in str(f) for f in gone)
    assert all(after[f] == t for f, t in before.items() if f in after)
    assert not (accounts / "year=2022" / "month=1" / "day=7").exists()
    place.run(accounts=header)
    assert {f: f.stat().st_mtime_ns for f in accounts.rglob("*.parquet")} == after


def test_landing_folders_are_removed(place):
    place.run()
    left = {p.name for p in (place.folder / "warehouse").iterdir()}
    assert left == {"auths", "accounts"}


def test_tidying_what_is_not_there_is_an_error(place, spark):
    with pytest.raises(FileNotFoundError):
        plans.tidy_auths(spark, f"{place.warehouse}/none")
    assert not (place.folder / "warehouse").exists()


def test_tidying_a_range_leaves_other_days_alone(place, spark):
    place.run()
    path = f"{place.warehouse}/auths"
    stored = place.table(AUTHS)
    stored.write.partitionBy("year", "month", "day").mode("append").parquet(path)
    days = place.folder / "warehouse" / "auths"
    before = {f for f in days.rglob("*.parquet") if "day=8" not in str(f)}
    once = stored.where("month = 2 AND day = 8").count()
    plans.tidy_auths(spark, path, dt.date(2022, 2, 8), dt.date(2022, 2, 8))
    assert {f for f in days.rglob("*.parquet") if "day=8" not in str(f)} == before
    assert place.table(AUTHS).where("month = 2 AND day = 8").count() == once > 0
    assert place.table(AUTHS).count() == 54 - once
    root = f"{place.warehouse}/versions"
    assert plans.tidy_auths(spark, path, version_root=root) == 27


def test_tidying_drops_copies_and_small_files(place, spark):
    place.run()
    path = f"{place.warehouse}/auths"
    stored = place.table(AUTHS)
    stored.unionByName(stored).write.partitionBy("year", "month", "day").mode("append").parquet(path)
    assert place.table(AUTHS).count() == 81
    assert plans.tidy_auths(spark, path) == 27
    assert place.table(AUTHS).count() == 27
    days = list((place.folder / "warehouse" / "auths").glob("year=*/month=*/day=*"))
    assert all(len(list(d.glob("*.parquet"))) == 1 for d in days)


def test_versioned_accounts_give_the_same(place, spark):
    table = f"{place.warehouse}/accounts"
    assert plans.read_accounts(spark, table, versioned=True).isEmpty()
    for n in (1, 2):
        place.run(versioned=True)
        versions = sorted((place.folder / "warehouse" / "accounts").glob("version-*"))
        assert len(versions) == n
        assert plans.read_accounts(spark, table, versioned=True).count() == 7
    # A version whose writing stopped does not count.
    (versions[-1] / "_SUCCESS").unlink()
    place.run(versioned=True, accounts=ACCOUNTS_TSV.splitlines()[0] + "\n")
    assert plans.read_accounts(spark, table, versioned=True).count() == 7
    assert place.report(TOP)[1] == "amazon,1046.66" and len(place.report(DAILY)) == 24
