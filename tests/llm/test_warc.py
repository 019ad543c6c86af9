from __future__ import annotations

import base64
import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st

from llm_samples import words
from tallyhouse.llm import warc
from tallyhouse.session import scratch_path


def pages(spark, rows):
    schema = "page_id bigint, url string, html string, digest string, refers_to string, id string"
    return spark.createDataFrame([(*row, "x", "y", "z") for row in rows], schema)


def brute(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        least = first.get(html or "")
        revisit = least is not None and i != least
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if revisit else "response", least if revisit else None))
    return sorted(out, key=str)


def found(df):
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in df.select(columns).collect()), key=str)


def sample(seed, n=200):
    draw = random.Random(seed)
    bodies = [f"<p>{words(draw, draw.randint(0, 30))}</p>\r\n\r\nWARC/1.1\r\n" for _ in range(60)]
    hosts = ["a.org", "b.a.org", "hot.org", "hot.org", "hot.org"]
    return [(i, f"http://{draw.choice(hosts)}/{draw.randint(0, 30)}", draw.choice(bodies)) for i in range(n)]


def test_records_and_revisits(spark):
    rows = sample(1)
    assert found(warc.archive(pages(spark, rows))) == brute(rows)


def test_the_history_is_in_one_order(spark):
    rows = sample(2)
    got = warc.archive(pages(spark, rows).repartition(6), records_each=10, range_captures=30).collect()
    assert len({r["run"] for r in got}) > 6 and len({r["history_part"] for r in got}) > 3
    ordered = sorted(got, key=lambda r: (r["history_part"], r["history_place"]))
    keys = [(r["url_key"], r["captured"], r["page_id"]) for r in ordered]
    assert keys == sorted(keys) and len(keys) == len(rows)


def test_odd_rows(spark):
    odd = [
        (1, None, None), (2, "", ""), (3, "http://x.org/\r\nWARC-Type: response", "a"), (None, "http://x.org", "a"),
        (None, None, "b"), (None, None, "b"), (4, "http://x.org", "a"), (4, "http://x.org", "a"),
        (-7, "http://[bad", "é" * 200_000), (1 << 62, "http://É.org/ü", "\x00\n"),
    ]
    assert found(warc.archive(pages(spark, odd))) == brute(odd)


def test_short_payloads_revisit_nothing(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    got = {r["page_id"]: r["refers_to"] for r in warc.archive(pages(spark, rows), least_bytes=3).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}


def test_archives_are_plain_warc_files(spark):
    rows = sample(3, 30)
    path = scratch_path(spark, "archives")
    warc.write_archives(pages(spark, rows), path)
    files = spark.read.format("binaryFile").load(path).collect()
    seen = 0
    for file in files:
        at = 0
        for offset, size, headers, block in warc.read_records(bytes(file["content"])):
            assert offset == at and int(headers["Content-Length"]) == len(block)
            assert headers["WARC-Record-ID"].startswith("<urn:page:") and "WARC-Date" in headers
            at += size
            seen += 1
        assert at == len(file["content"])
    assert seen == 30


def test_archives_are_bounded_by_bytes(spark):
    draw = random.Random(5)
    rows = [(i, f"http://a.org/{i}", "é" * draw.choice([10, 300, 9_000, 50_000, 400_000])) for i in range(60)]
    path, bound = scratch_path(spark, "bounded"), 300_000
    warc.write_archives(pages(spark, rows).coalesce(1), path, archive_bytes=bound)
    files = spark.read.format("binaryFile").load(path).select("length", "content").collect()
    counts = [sum(1 for _ in warc.read_records(bytes(f["content"]))) for f in files]
    assert sum(counts) == 60
    assert all(f["length"] <= bound or n == 1 for f, n in zip(files, counts))
    assert len(files) < 60 and max(counts) > 3
    assert found(warc.archive(pages(spark, rows), archive_bytes=bound)) == brute(rows)


def test_times_do_not_depend_on_the_session_zone(spark):
    # The clocks of New York go back in November and forward in March.
    year = 86_400 * 365
    rows = [(i, "http://a.org", f"p{i}") for at in (0, 5_961_600, 26_524_800, year) for i in range(at, at + 18_000, 1_700)]
    seen = []
    for zone in ("UTC", "America/New_York", "Asia/Kathmandu"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            seen.append(sorted((r["page_id"], r["captured"], r["history_place"])
                               for r in warc.archive(pages(spark, rows)).collect()))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seen[0] == seen[1] == seen[2]
    assert seen[0][0] == (0, "2024-01-01T00:00:00Z", 0)
    assert [place for _, _, place in seen[0]] == list(range(len(rows)))


def test_no_rows(spark):
    assert warc.archive(pages(spark, [])).collect() == []


@given(st.lists(st.lists(st.integers(0, 20)), max_size=12))
def test_loser_tree_merges(runs):
    rows = [sorted((value, n, k) for k, value in enumerate(run)) for n, run in enumerate(runs)]
    merged = list(warc.LoserTree(rows, lambda row: row[0]))
    assert [r[0] for r in merged] == sorted(r[0] for run in rows for r in run)
    assert sorted(merged) == sorted(r for run in rows for r in run)
