"""WARC archives with an external merge of their capture index.

Pages become WARC records, written as text files: Spark's line separator is the
blank line that ends a record, so a file is a plain, uncompressed archive. Of
records with equal payloads (by SHA-1 and length) the one with the smallest id
holds the payload and the others revisit it, if the payload is long enough.

An archive has at most `ARCHIVE_BYTES`, or one record: records are written by classes
of size, and a class has as many in an archive as that allows. So each is read back in
one piece, and yields its captures ordered by URL key, time and id: a run. Runs are stored; each range of keys then gets its part
of every run, and a loser tree merges these k sorted parts into one history.
Ranges are chosen over key, time and id, so even a single URL's captures are
spread over tasks.

A null payload is empty. A null id is never the smallest; a null URL has an empty
key. Rows of one id and payload are the same capture and none revisits another.
Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored
from tallyhouse.session import scratch_path

LEAST_BYTES = 0
# Captures and bytes in one archive, and captures in one range of the merged index, at most or so.
RECORDS_EACH = 8192
ARCHIVE_BYTES = 32 * 1024 * 1024
RANGE_CAPTURES = 250_000

_CRLF = "\r\n"
# Records of one class have at most so many bytes, or 16, 256, ... times as many.
_SMALL = 4096
# Without a column of times, page n was captured n seconds after this one.
_EPOCH = 1_704_067_200
_YEARS = 10 * 365 * 86_400

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def _sha1_base32(payload: Column) -> Column:
    """Every ten hexadecimal digits of the digest are eight of base 32."""
    hexed = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(hexed, start, 10), 16, 32), 8, "0") for start in (1, 11, 21, 31)
    ]
    return F.translate(F.concat(*parts), _CONV32, _BASE32)


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF)), F.lit(""))


def _urn(id_: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(id_.cast("string"), F.lit("none")), F.lit(">"))


def _utc(seconds: Column) -> Column:
    """A moment as text, whatever the session's zone: no timestamp with a zone is made."""
    since = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    moment = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + since
    return F.concat(F.translate(moment.cast("string"), " ", "T"), F.lit("Z"))


def _class() -> Column:
    """How many times a record's bytes, less than 1024 of them in headers but for the URL, have
    to be divided by 16 to be small."""
    size = F.octet_length("payload") + 3 * F.octet_length(F.coalesce("url", F.lit(""))) + 1024
    return sum((size > _SMALL * 16**n).cast("int") for n in range(6))


def _record(least_bytes: int) -> Column:
    """A page as the text of its WARC record, without the blank line after it."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "),
        F.octet_length("payload").cast("string"), F.lit(_CRLF * 2),
    )
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    seconds = F.lit(_EPOCH) + F.pmod(F.coalesce("id", F.lit(0)), F.lit(_YEARS))
    # A URL keeps to its line: what would end the line is percent-encoded.
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    return F.concat(
        F.lit(f"WARC/1.1{_CRLF}"),
        _header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", _urn(F.col("id"))),
        _header("WARC-Date", _utc(seconds)),
        _header("WARC-Target-URI", url),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("WARC-Profile", F.when(
            revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _header("WARC-Refers-To", F.when(revisit, _urn(F.col("refers_to")))),
        F.lit(f"Content-Type: application/http; msgtype=response{_CRLF}"),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(_CRLF), block,
    )


def write_archives(
    pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url",
    payload_column: str = "html", least_bytes: int = LEAST_BYTES,
    records_each: int = RECORDS_EACH, archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Archives of `records_each` records and `archive_bytes` at most, or one record, below `path`.

    Payloads move only if the table of revisits is too large for Spark to send around: it is
    stored first, and so Spark knows its size.
    """
    captures = pages.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(url_column).alias("url"),
        F.coalesce(F.col(payload_column), F.lit("")).alias("payload"),
    ).withColumn("digest", _sha1_base32(F.col("payload").cast("binary")))
    every = stored(
        captures.select("id", "digest", F.octet_length("payload").alias("bytes"), _class().alias("class")),
        "payload-digests",
    )
    seen = every.where(F.col("bytes") >= least_bytes)
    firsts = stored(
        seen.groupBy("digest", "bytes").agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL").drop("n"), "first-captures",
    )
    revisits = stored(
        seen.join(firsts, ["digest", "bytes"]).where("id IS NULL OR id > first")
        .select("id", "digest", F.col("first").alias("refers_to")).distinct(), "revisits",
    )
    same = F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.digest") == F.col("b.digest"))
    records = captures.alias("a").join(revisits.alias("b"), same, "left").select("a.*", "refers_to")
    # There are a few classes at most, and one or two in most tables.
    classes = sorted(row[0] for row in every.select("class").distinct().collect())
    for n in classes or [0]:
        of_class = records if len(classes) < 2 else records.where(_class() == n)
        each = max(1, min(records_each, archive_bytes // (_SMALL * 16**n)))
        (
            of_class.select(_record(least_bytes).alias("value")).write.mode("append")
            .option("lineSep", _CRLF * 2).option("maxRecordsPerFile", each)
            .option("compression", "none").text(path)
        )


def read_records(raw: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, size, headers, block) of each record of an archive."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        version, *lines = raw[at:end].decode("utf-8").split(_CRLF)
        if not version.startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        stop = end + 4 + int(headers["Content-Length"])
        if raw[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has another length")
        yield at, stop + 4 - at, headers, raw[end + 4:stop]
        at = stop + 4


def url_key(url: str | None) -> str:
    """The URL with its host turned round, so that a host's captures adjoin: org,example)/path."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host = ",".join(reversed((parts.hostname or "").split(".")))
    except ValueError:
        return url.lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{host}){parts.path or '/'}{query}".lower()


_CAPTURE = (
    "url_key string, captured string, page_id bigint, run string, offset bigint, size bigint, "
    "payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
)
_FIELDS = [part.split()[0] for part in _CAPTURE.split(", ")]
_KINDS = [pa.string() if part.endswith("string") else pa.int64() for part in _CAPTURE.split(", ")]


def _of_urn(urn: str | None) -> int | None:
    name = (urn or "none>").removeprefix("<urn:page:").removesuffix(">")
    return None if name == "none" else int(name)


def _captures(run: str, raw: bytes) -> list[tuple]:
    out = []
    for offset, size, headers, block in read_records(raw):
        head, _, payload = block.partition(b"\r\n\r\n")
        length = int(head.rpartition(b"Content-Length: ")[2])
        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
        if headers["WARC-Type"] == "response":
            own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if own != digest or len(payload) != length:
                raise ValueError(f"{run}: the payload at byte {offset} is not what was written")
        out.append((
            url_key(headers.get("WARC-Target-URI")), headers["WARC-Date"],
            _of_urn(headers["WARC-Record-ID"]), run, offset, size, length, digest,
            headers["WARC-Type"], _of_urn(headers["WARC-Refers-To"]) if "WARC-Refers-To" in headers else None,
        ))
    return out


def _key(row: tuple) -> tuple:
    """URL key, time, id (null last), and then the record's place."""
    return row[0], row[1], row[2] is None, row[2] or 0, row[3], row[4]


def _batch(rows: list[tuple], extra: dict[str, pa.Array] | None = None) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_FIELDS)
    arrays = [pa.array(column, kind) for column, kind in zip(columns, _KINDS)]
    more = extra or {}
    return pa.RecordBatch.from_arrays([*arrays, *more.values()], [*_FIELDS, *more])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The captures of each archive, in order: one run."""
    for batch in batches:
        for path, raw in zip(batch.column("path"), batch.column("content")):
            name = path.as_py().rpartition("/")[2]
            yield _batch(sorted(_captures(name, raw.as_py()), key=_key))


def read_runs(spark, path: str) -> DataFrame:
    """A sorted run of captures for each archive below `path`."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_runs, _CAPTURE)


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the top the winner."""

    def __init__(self, runs: Iterable[Iterable[tuple]], key):
        self.key = key
        self.runs = [iter(run) for run in runs]
        self.heads = [self._next(i) for i in range(len(self.runs))]
        self.losers = [-1] * max(len(self.runs), 1)
        for i in range(len(self.runs)):
            self._play(i)

    def _next(self, run: int):
        row = next(self.runs[run], None)
        return None if row is None else (self.key(row), row)

    def _beats(self, a: int, b: int) -> bool:
        """Whether run a goes before run b; an ended run goes after all, ties go by number."""
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[b] is None and (self.heads[a] is not None or a < b)
        return (self.heads[a][0], a) < (self.heads[b][0], b)

    def _play(self, run: int) -> None:
        """Run `run` up the tree; an empty node keeps it until an opponent comes."""
        node = (run + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = run
                return
            if self._beats(other, run):
                self.losers[node], run = run, other
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator[tuple]:
        while self.runs:
            winner = self.losers[0]
            if self.heads[winner] is None:
                return
            yield self.heads[winner][1]
            self.heads[winner] = self._next(winner)
            self._play(winner)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A range's part of every run, merged; the place of each capture in the range is added."""
    runs: dict[str, list[tuple]] = {}
    for batch in batches:
        for row in zip(*(batch.column(name).to_pylist() for name in _FIELDS)):
            runs.setdefault(row[3], []).append(row)
    # A shuffle keeps the order within what one task sent; should it not, a run is put in order.
    parts = [sorted(run, key=_key) for _, run in sorted(runs.items())]
    part = TaskContext.get().partitionId()
    merged = list(LoserTree(parts, _key))
    for start in range(0, len(merged), 10_000):
        rows = merged[start:start + 10_000]
        yield _batch(rows, {
            "history_part": pa.array([part] * len(rows), pa.int64()),
            "history_place": pa.array(range(start, start + len(rows)), pa.int64()),
        })


def merged_history(runs: DataFrame, range_captures: int = RANGE_CAPTURES) -> DataFrame:
    """All captures in one order, by (history_part, history_place)."""
    kept = stored(runs, "capture-runs")
    ranges = kept.count() // range_captures + 1
    keys = ["url_key", "captured", F.col("page_id").asc_nulls_last(), "run", "offset"]
    return kept.repartitionByRange(ranges, *keys).mapInArrow(
        _merge, f"{_CAPTURE}, history_part bigint, history_place bigint"
    )


def archive(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url",
    payload_column: str = "html", least_bytes: int = LEAST_BYTES,
    records_each: int = RECORDS_EACH, range_captures: int = RANGE_CAPTURES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Pages written to archives and read back: a row for each capture, with its place in them
    and in the merged history."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(
        pages, path, id_column, url_column, payload_column, least_bytes, records_each, archive_bytes
    )
    history = merged_history(read_runs(pages.sparkSession, path), range_captures)
    return history.withColumnRenamed("page_id", id_column)
