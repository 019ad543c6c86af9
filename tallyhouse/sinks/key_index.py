"""Which days of a table can hold a key: hashes of the keys, in buckets beside the table.

The index is a hidden folder beside the table with rows (hash of the keys, day), filed
by bucket of the hash. It is brought up to date before it is asked: it knows what files
each day had when the day was read, so days that gained, lost or changed a file, by
whatever writer, are read again, keys only. Rows of keys that have gone only cost a day
that is read in vain. A part counts once the manifest that names it is in place.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.folders import Folder
from tallyhouse.functions.dates import day_code
from tallyhouse.operators.merge import on_days
from tallyhouse.sinks.lease import LeaseLost, writing
from tallyhouse.sources.warehouse import read_table

BUCKETS = 64
# With so many parts the index is made anew, in one part.
MOST_PARTS = 64

_ROWS = "hash bigint, code int, part string, bucket int"


def _bucket(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(BUCKETS)).cast("int")


def signatures(spark: SparkSession, table: str) -> dict[int, str]:
    """What files each day of a table has, day by day. Files are listed, not read."""
    if not Folder(spark, table).exists():
        return {}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(table)
    part = [
        F.regexp_extract("path", rf"/{name}=(\d+)/", 1).try_cast("int").alias(name)
        for name in ("year", "month", "day")
    ]
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    per_day = (
        files.select(*part, mark.alias("mark")).groupBy(day_code().alias("code"))
        .agg(F.sum("mark").cast("string").alias("sum"), F.count("*").alias("n"))
        .where("code IS NOT NULL").collect()
    )
    return {row["code"]: f"{row['n']}/{row['sum']}" for row in per_day}


class KeyIndex:
    """The index of one table by some of its columns."""

    def __init__(self, spark: SparkSession, table: str, schema: T.StructType, keys: Sequence[str]):
        self.spark, self.table, self.schema, self.keys = spark, table, schema, list(keys)
        name = f"keys-{zlib.crc32(json.dumps(self.keys).encode()):08x}"
        self.folder = Folder(spark, table).beside(name)

    def _newest(self) -> tuple[int, dict]:
        names = self.folder.names() if self.folder.exists() else []
        numbers = [int(n) for n in names if n.isdigit()]
        if not numbers:
            return 0, {"parts": [], "days": {}}
        return max(numbers), json.loads(self.folder.within(f"{max(numbers):010d}").text())

    def _hash(self) -> Column:
        # Equal values of two types would have two hashes.
        return F.xxhash64(*[F.col(k).cast(self.schema[k].dataType) for k in self.keys])

    def catch_up(self) -> list[int]:
        """Read the keys of days whose files have changed since; returns these days."""
        with writing(self.spark, self.table) as lease:
            number, known = self._newest()
            parts = [] if len(known["parts"]) >= MOST_PARTS else known["parts"]
            now = {str(code): mark for code, mark in signatures(self.spark, self.table).items()}
            had = known["days"] if parts else {}
            changed = sorted(int(code) for code, mark in now.items() if had.get(code) != mark)
            if not changed:
                return []
            stored = read_table(self.spark, self.table, self.schema).where(on_days(changed))
            rows = stored.select(self._hash().alias("hash"), day_code().alias("code")).distinct()
            rows = rows.withColumn("bucket", _bucket(F.col("hash")))
            part = uuid.uuid4().hex
            rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(
                f"{self.folder.path}/parts/part={part}"
            )
            lease.check()
            text = json.dumps({"parts": [*parts, part], "days": now})
            if not self.folder.within(f"{number + 1:010d}").create(text):
                raise LeaseLost(f"somebody else has brought {self.folder.path} up to date")
            self._drop_old(number, {*parts, part})
            return changed

    def _drop_old(self, number: int, parts: set[str]) -> None:
        """Only a writer who holds the lease reads the index, so nobody misses what goes."""
        self.folder.within(f"{number:010d}").delete()
        held = self.folder.within("parts")
        for name in held.names():
            if name.removeprefix("part=") not in parts:
                held.within(name).delete()

    def days_of(self, batch: DataFrame) -> list[int]:
        """The days that can hold a row with the keys of one of the batch's."""
        _, known = self._newest()
        if not known["parts"]:
            return []
        wanted = batch.select(self._hash().alias("hash")).distinct()
        buckets = [row[0] for row in wanted.select(_bucket(F.col("hash"))).distinct().collect()]
        base = f"{self.folder.path}/parts"
        reader = self.spark.read.schema(_ROWS).option("basePath", base)
        held = reader.parquet(*[f"{base}/part={part}" for part in known["parts"]])
        found = held.where(F.col("bucket").isin(buckets)).join(wanted, "hash", "left_semi")
        return sorted(row[0] for row in found.select("code").distinct().collect())


def days_with_keys(
    spark: SparkSession, table: str, schema: T.StructType, batch: DataFrame, keys: Sequence[str]
) -> tuple[list[int], Column]:
    """The days that can hold a batch row's `keys`, and a filter for them.

    A row without a day, which is in no day's folder, is let through.
    """
    index = KeyIndex(spark, table, schema, keys)
    with writing(spark, table):
        index.catch_up()
        codes = index.days_of(batch)
    return codes, on_days(codes) | day_code().isNull()
