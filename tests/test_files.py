"""Reading and writing: feeds, tables, publishing and reports."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samples import ACCOUNTS_TSV, AUTHS_CSV
from tallyhouse import operators as op
from tallyhouse import session, sinks, sources
from tallyhouse.folders import Folder, hidden_sibling
from tallyhouse.functions import add_date_parts
from tallyhouse.schemas import ACCOUNTS, AUTHS
from tallyhouse.sinks import publish
from tallyhouse.sources import RAW_LINE


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def put(folder, name, text):
    file = folder / name
    file.write_text(text)
    return str(file)


# ---- delimited ----------------------------------------------------------------------


def test_accounts_feed_is_typed(spark, tmp_path):
    df = sources.read_feed(spark, ACCOUNTS, put(tmp_path, "a.tsv", ACCOUNTS_TSV))
    assert df.columns == [*ACCOUNTS.names, RAW_LINE]
    assert df.count() == 9
    first = df.where("first_name = 'Amy'").first()
    assert first.updated_date == dt.datetime(2021, 10, 9, 2, 20, 30)
    assert first.Postal_Code == "36984" and first[RAW_LINE] is None


def test_auths_feed_without_its_blank_columns(spark, tmp_path):
    df = sources.read_feed(spark, AUTHS, put(tmp_path, "a.csv", AUTHS_CSV))
    assert df.columns == [*AUTHS.names, RAW_LINE]
    found = df.agg(F.count("*"), F.sum("Amount"), F.max("Transmit Time")).first()
    assert found[0] == 27 and round(found[1], 2) == 1862.55
    assert found[2] == dt.datetime(2022, 2, 9, 2, 20, 30)


def test_padded_and_unpadded_times_and_text_ids(spark, tmp_path):
    text = "account_id\tfirst_name\tlast_name\tcreation_date\tupdated_date\tPostal_Code\tCardholder_Country\tCard_status\n"
    text += "007\tA\tB\t02/07/2022 02:05:09\t2/7/2022 2:5:9\t02134\tUSA\tactive\n"
    row = sources.read_feed(spark, ACCOUNTS, put(tmp_path, "a.tsv", text)).first()
    assert row.account_id == "007" and row.Postal_Code == "02134"
    assert row.creation_date == row.updated_date == dt.datetime(2022, 2, 7, 2, 5, 9)


def test_bad_cell_becomes_null_and_its_line_is_kept(spark, tmp_path):
    text = AUTHS_CSV + ",x,,bad,debit,USA,1.00,amazon\n,y,,2/1/2022 2:20:30,debit,USA,4x,amazon\n"
    df = sources.read_feed(spark, AUTHS, put(tmp_path, "a.csv", text))
    x, y = (df.where(F.col("account_id") == k).first() for k in "xy")
    assert x["Transmit Time"] is None and x[RAW_LINE] == ",x,,bad,debit,USA,1.00,amazon"
    assert y.Amount is None and y[RAW_LINE].endswith("4x,amazon")
    assert sum(r[RAW_LINE] is None for r in df.collect()) == 27


def test_reordered_header_fails_in_any_file(spark, tmp_path):
    put(tmp_path, "a.csv", AUTHS_CSV)
    put(tmp_path, "b.csv", ",account_id,,Transmit Time,Merchant Country,Transaction Type,Amount,merchant_name\n"
        ",x,,2/1/2022 2:20:30,USA,debit,1.00,amazon\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE|header does not conform"):
        sources.read_feed(spark, AUTHS, str(tmp_path)).collect()


def test_inference_is_available_and_unstable(spark, tmp_path):
    whole = sources.read_delimited(spark, put(tmp_path, "a.csv", AUTHS_CSV), None)
    types = dict(whole.dtypes)
    assert types["Transmit Time"] == "timestamp" and types["Amount"] == "double"
    assert types["_c0"] == types["_c2"] == "string"
    bad = put(tmp_path, "b.csv", AUTHS_CSV + ",x,,2/1/2022 2:20:30,debit,USA,4x,amazon\n")
    assert dict(sources.read_delimited(spark, bad, None).dtypes)["Amount"] == "string"


# ---- tables -------------------------------------------------------------------------

EVENT = "id int, ts timestamp, note string"


def by_day(spark, data):
    return add_date_parts(spark.createDataFrame(data, EVENT), "ts")


def day(n):
    return dt.datetime(2022, 2, n, 12)


def test_absent_table_is_empty(spark, tmp_path):
    df = sources.read_table(spark, str(tmp_path / "none"), AUTHS.table_schema)
    assert df.schema == AUTHS.table_schema and df.isEmpty()


def test_other_read_errors_are_not_swallowed(spark, tmp_path):
    wrong = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("a", T.IntegerType())])
    with pytest.raises(Exception):
        sources.read_table(spark, str(tmp_path), wrong).collect()


def test_publish_lays_out_by_day_and_reads_back(spark, tmp_path):
    path = str(tmp_path / "t")
    df = by_day(spark, [(1, day(1), "a"), (2, day(1), None), (3, day(2), "c"), (4, None, "d")])
    assert sinks.publish_partitioned(df, path, df.schema) == 4
    assert (tmp_path / "t" / "year=2022" / "month=2" / "day=1").is_dir()
    assert (tmp_path / "t" / "year=__HIVE_DEFAULT_PARTITION__").is_dir()
    assert rows(sources.read_table(spark, path, df.schema)) == rows(df)
    found = sources.discover_table(spark, path)
    assert found.dtypes[-3:] == [("year", "int"), ("month", "int"), ("day", "int")]
    assert rows(found) == rows(df)


def test_publish_may_replace_what_its_plan_reads(spark, tmp_path):
    path = str(tmp_path / "t")
    df = by_day(spark, [(1, day(1), "a"), (2, day(2), "b")])
    sinks.publish_partitioned(df, path)
    for _ in range(3):
        old = sources.read_table(spark, path, df.schema)
        newer = old.withColumn("note", F.concat("note", F.lit("+")))  # no shuffle, no cache
        sinks.publish_partitioned(newer, path)
    table = sources.read_table(spark, path, df.schema)
    assert sorted(r.note for r in table.collect()) == ["a+++", "b+++"]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_publish_empties_a_day_an_account_left(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.publish_partitioned(by_day(spark, [(1, day(1), "a"), (2, day(2), "b")]), path)
    old = sources.discover_table(spark, path)
    moved = op.upsert_latest(old, by_day(spark, [(1, day(3), "a")]), ["id"], "ts")
    sinks.publish_partitioned(moved, path)
    assert not (tmp_path / "t" / "year=2022" / "month=2" / "day=1").exists()
    assert [tuple(r) for r in sources.discover_table(spark, path).select("id", "day").orderBy("id")
            .collect()] == [(1, 3), (2, 2)]


def test_failed_publish_leaves_the_table_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    df = by_day(spark, [(1, day(1), "a")])
    sinks.publish_partitioned(df, path)
    broken = sources.read_table(spark, path, df.schema).withColumn(
        "note", F.raise_error(F.lit("stop")).cast("string")
    )
    with pytest.raises(Exception, match="stop"):
        sinks.publish_partitioned(broken, path)
    with pytest.raises(ValueError, match="expected 2 or more"):
        sinks.publish_partitioned(df, path, at_least=2)
    with pytest.raises(ValueError, match="only left: note string"):
        sinks.publish_partitioned(df, path, df.drop("note").schema)
    assert rows(sources.read_table(spark, path, df.schema)) == rows(df)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


class Stopped(Exception):
    pass


def stop_at_move(monkeypatch, n, kill):
    """The n-th move of a folder fails; with `kill` nothing tidies up after it, as in a crash."""
    move, moves = Folder.move_to, []

    def moved(self, to):
        moves.append(to)
        if len(moves) == n:
            raise Stopped
        move(self, to)

    monkeypatch.setattr(Folder, "move_to", moved)
    if kill:
        monkeypatch.setattr(publish, "restore_interrupted", lambda *a: None)


@pytest.mark.parametrize("kill", [False, True])
@pytest.mark.parametrize("n", [1, 2])
def test_a_publish_cut_off_at_any_move_is_undone(spark, tmp_path, monkeypatch, n, kill):
    path = str(tmp_path / "t")
    df, new = by_day(spark, [(1, day(1), "a")]), by_day(spark, [(2, day(2), "b")])
    sinks.publish_partitioned(df, path)
    with monkeypatch.context() as m, pytest.raises(Stopped):
        stop_at_move(m, n, kill)
        sinks.publish_partitioned(new, path)
    if kill:
        with pytest.raises(RuntimeError, match="not finished"):
            sources.read_table(spark, path, df.schema)
        # Whoever writes next brings the table back first.
        sinks.append_partitioned(new, path)
        assert rows(sources.read_table(spark, path, df.schema)) == rows(df.unionByName(new))
    else:
        assert rows(sources.read_table(spark, path, df.schema)) == rows(df)
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


@pytest.mark.parametrize("n", range(1, 6))
def test_days_replaced_in_part_are_undone(spark, tmp_path, monkeypatch, n):
    path = str(tmp_path / "t")
    df = by_day(spark, [(1, day(1), "a"), (2, day(2), "b"), (3, day(3), "c")])
    sinks.publish_partitioned(df, path)
    new = by_day(spark, [(1, day(2), "x"), (2, day(4), "y"), (5, day(1), "z")])
    days = [sinks.day_folder(2022, 2, d) for d in (1, 2, 4)]
    with monkeypatch.context() as m, pytest.raises(Stopped):
        stop_at_move(m, n, kill=True)
        sinks.publish_days(new, path, days)
    with pytest.raises(RuntimeError, match="not finished"):
        sources.read_table(spark, path, df.schema)
    sinks.restore_interrupted(spark, path)
    assert rows(sources.read_table(spark, path, df.schema)) == rows(df)
    assert sinks.publish_days(new, path, days, exactly=3) == 3
    assert rows(sources.read_table(spark, path, df.schema)) == rows(new.unionByName(df.where("id = 3")))


def test_a_finished_swap_is_tidied_up_and_not_undone(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df, new = by_day(spark, [(1, day(1), "a")]), by_day(spark, [(2, day(2), "b")])
    sinks.publish_partitioned(df, path)
    with monkeypatch.context() as m:
        m.setattr(publish, "restore_interrupted", lambda *a: None)
        sinks.publish_partitioned(new, path)
    assert (tmp_path / ".t.previous" / "_done").exists()
    assert rows(sources.read_table(spark, path, df.schema)) == rows(new)
    sinks.restore_interrupted(spark, path)
    assert rows(sources.read_table(spark, path, df.schema)) == rows(new)
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_days_that_are_not_replaced_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = by_day(spark, [(1, day(1), "a"), (2, day(2), "b"), (3, day(3), "c")])
    sinks.publish_partitioned(df, path)
    kept = set((tmp_path / "t").rglob("day=3/*.parquet"))
    new = by_day(spark, [(1, day(2), "x")])
    days = [sinks.day_folder(2022, 2, d) for d in (1, 2)]
    with pytest.raises(ValueError, match="expected 2"):
        sinks.publish_days(new, path, days, exactly=2)
    with pytest.raises(ValueError, match="not to be replaced"):
        sinks.publish_days(new, path, days[:1])
    assert rows(sources.read_table(spark, path, df.schema)) == rows(df)
    sinks.publish_days(new, path, days)
    assert set((tmp_path / "t").rglob("day=3/*.parquet")) == kept
    assert not (tmp_path / "t" / "year=2022" / "month=2" / "day=1").exists()
    assert rows(sources.read_table(spark, path, df.schema)) == rows(new.unionByName(df.where("id = 3")))


@pytest.mark.parametrize("path, hidden", [
    ("/a/b/t", "/a/b/.t.x"), ("/t/", "/.t.x"), ("t", ".t.x"), ("hdfs://h:1/a/t", "hdfs://h:1/a/.t.x"),
])
def test_hidden_sibling(path, hidden):
    assert hidden_sibling(path, "x") == hidden


def test_append_adds_only_and_creates(spark, tmp_path):
    path = str(tmp_path / "t")
    df = by_day(spark, [(1, day(1), "a")])
    sinks.append_partitioned(df, path, df.schema)
    before = set((tmp_path / "t").rglob("*.parquet"))
    stored = sources.read_table(spark, path, df.schema)
    batch = by_day(spark, [(1, day(1), "a"), (2, day(1), "b")])
    for _ in range(2):
        stored = sources.read_table(spark, path, df.schema)
        sinks.append_partitioned(op.rows_to_append(stored, batch), path, df.schema)
    assert before < set((tmp_path / "t").rglob("*.parquet"))
    assert rows(sources.read_table(spark, path, df.schema)) == rows(batch)
    with pytest.raises(ValueError, match="do not fit"):
        sinks.append_partitioned(batch.drop("note"), path, df.schema)


def test_versions_and_an_unfinished_one(spark, tmp_path):
    root = str(tmp_path / "t")
    assert sinks.latest_version(spark, root) is None
    one = by_day(spark, [(1, day(1), "a")])
    first = sinks.publish_version(one, root)
    assert sinks.latest_version(spark, root) == first
    second = sinks.publish_version(by_day(spark, [(2, day(2), "b")]), root)
    (tmp_path / "t" / "version-99999999T000000000000-unfinished").mkdir()
    assert sinks.latest_version(spark, root) == second
    assert rows(sources.read_table(spark, first, one.schema)) == rows(one)


def test_old_versions_go_and_a_short_one_does_not_count(spark, tmp_path):
    root = str(tmp_path / "t")
    made = [sinks.publish_version(by_day(spark, [(n, day(n), "a")]), root) for n in (1, 2, 3)]
    with pytest.raises(ValueError, match="expected 2 or more"):
        sinks.publish_version(by_day(spark, [(9, day(9), "a")]), root, at_least=2)
    assert sinks.latest_version(spark, root) == made[-1]
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == [m.rsplit("/", 1)[1] for m in made[1:]]


def test_snapshot_outlives_its_source(spark, tmp_path):
    path = str(tmp_path / "t")
    df = by_day(spark, [(1, day(1), "a")])
    sinks.publish_partitioned(df, path)
    kept = session.snapshot(sources.read_table(spark, path, df.schema))
    kept.write.mode("overwrite").partitionBy("day").parquet(path)
    assert rows(kept) == rows(df)
    assert sources.discover_table(spark, path).count() == 1


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = (session.scratch_path(spark, "x") for _ in range(2))
    assert one.startswith(shared + "/") and one != two


def test_a_run_has_settings_of_its_own(spark):
    keys = ["spark.sql.session.timeZone", *session.TABLE_SETTINGS, "spark.sql.shuffle.partitions"]
    before = [spark.conf.get(k) for k in keys]
    tokyo, chicago = (session.for_tables(spark, z) for z in ("Asia/Tokyo", "America/Chicago"))
    assert [tokyo.conf.get(k) for k in keys] == ["Asia/Tokyo", "TIMESTAMP_MICROS", "zstd", "4"]
    assert chicago.conf.get(keys[0]) == "America/Chicago"
    session.size_shuffles(tokyo, spark, 100 * 2**30)
    assert tokyo.conf.get(keys[-1]) == "800" and chicago.conf.get(keys[-1]) == "4"
    session.size_shuffles(tokyo, spark, 100 * 2**40)
    assert tokyo.conf.get(keys[-1]) == "819200"
    session.size_shuffles(tokyo, spark, 10**6)
    assert tokyo.conf.get(keys[-1]) == "4"
    assert [spark.conf.get(k) for k in keys] == before


def test_without_a_shared_folder_there_is_an_error():
    class Bare:
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Bare)


# ---- reports ------------------------------------------------------------------------


def parts(folder, suffix):
    return sorted(folder.glob(f"part-*.{suffix}"))


def test_csv_report_has_a_header_and_is_replaced(spark, tmp_path):
    path = str(tmp_path / "r")
    for fmt in ("com.databricks.spark.csv", "csv"):
        df = spark.createDataFrame([("a, b", 1), (None, 2)], "n string, v int").repartition(2)
        sinks.write_report(df, path, fmt, single_file=True)
        (file,) = parts(tmp_path / "r", "csv")
        lines = file.read_text().splitlines()
        assert lines[0] == "n,v" and set(lines[1:]) == {'"a, b",1', ",2"}


def test_large_sorted_report_stays_sorted_over_several_files(spark, tmp_path):
    path = str(tmp_path / "r")
    key = "spark.sql.adaptive.enabled"
    spark.conf.set(key, "false")
    try:
        sinks.write_report(spark.range(10000).repartition(4).orderBy("id"), path)
    finally:
        spark.conf.set(key, "true")
    files = parts(tmp_path / "r", "csv")
    ids = [int(x) for f in files for x in f.read_text().splitlines()[1:]]
    assert len(files) > 1 and ids == list(range(10000))


def test_small_sorted_report_is_one_file(spark, tmp_path):
    sinks.write_report(spark.range(100).repartition(4).orderBy("id"), str(tmp_path / "r"))
    assert len(parts(tmp_path / "r", "csv")) == 1


def test_other_report_formats(spark, tmp_path):
    df = spark.range(3)
    for fmt in ("parquet", "json", "orc"):
        path = str(tmp_path / fmt)
        sinks.write_report(df, path, fmt)
        assert rows(spark.read.format(fmt).load(path)) == rows(df)


# ---- sizes and older tables -----------------------------------------------------------


def test_folder_size(spark, tmp_path):
    (tmp_path / "a").mkdir()
    put(tmp_path / "a", "x.csv", "12345")
    put(tmp_path / "a", "y.csv", "123")
    size = lambda name: Folder(spark, str(tmp_path / name)).size()
    assert (size("a"), size("a/x.csv"), size("none")) == (8, 5, 0)


def test_an_older_table_with_integer_postal_codes_can_be_taken_over(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    row = ("a", "A", "B", day(1), day(2), 2134, "USA", "active", 2022, 2, 2)
    types = [(f.name, "int" if f.name == "postal_code" else f.dataType.simpleString())
             for f in ACCOUNTS.table_schema]
    was = spark.createDataFrame([row], ", ".join(f"{n} {t}" for n, t in types))
    was.write.partitionBy("year", "month", "day").parquet(old)
    taken = sources.discover_table(spark, old).withColumn(
        "postal_code", F.col("postal_code").cast("string")
    )
    sinks.publish_partitioned(taken, new, ACCOUNTS.table_schema)
    assert sources.read_table(spark, new, ACCOUNTS.table_schema).first().postal_code == "2134"


def test_an_append_that_stops_half_way_is_run_again(spark, tmp_path):
    path = str(tmp_path / "t")
    stored = by_day(spark, [(1, day(1), "a")])
    sinks.append_partitioned(stored, path, stored.schema)
    batch = by_day(spark, [(n, day(n % 9 + 1), f"n{n}") for n in range(60)] + [(1, day(1), "a")])
    stops = F.when(F.col("id") == 42, F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        sinks.append_partitioned(
            batch.withColumn("note", stops.otherwise(F.col("note"))), path, stored.schema
        )
    # As if some files of the failed write had been left in the table all the same.
    sinks.append_partitioned(batch.where("id < 20 AND id <> 1"), path, stored.schema)
    table = sources.read_table(spark, path, stored.schema)
    sinks.append_partitioned(op.rows_to_append(table, batch), path, stored.schema)
    table = sources.read_table(spark, path, stored.schema)
    assert rows(table) == Counter({tuple(r) for r in batch.unionByName(stored).collect()})


def test_empty_and_header_only_files_among_the_delivered(spark, tmp_path):
    put(tmp_path, "a.csv", AUTHS_CSV)
    put(tmp_path, "b.csv", "")
    put(tmp_path, "c.csv", AUTHS_CSV.splitlines()[0] + "\n")
    assert sources.read_feed(spark, AUTHS, str(tmp_path)).count() == 27
