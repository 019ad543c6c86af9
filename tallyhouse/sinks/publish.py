"""Writing tables so that no plan overwrites the files it reads, and no failure loses rows.

A replacement writes its rows beside the table and checks them. Then the old
folders move to a hidden folder, `.<table>.previous`, the new ones take their
places, and a mark says that it is done. A journal written before the first move
lists the folders, so a replacement cut off anywhere is undone by
`restore_interrupted`: every writer here begins with it, and `read_table` refuses
a table that needs it.

An append stages its files in the same way, gives them a name of its delivery, and
moves them to their days. A manifest below the table lists the deliveries that count;
a new one with the delivery's name is put in place last, and readers go by the newest.
So a delivery is seen whole or not at all, also where a rename is a copy.

Every writer holds the table's lease, from before it reads what it changes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.folders import Folder
from tallyhouse.operators.checks import schema_diff
from tallyhouse.schemas import DAY_PARTS
from tallyhouse.sinks.lease import LeaseLost, writing

_JOURNAL, _DONE = "_journal", "_done"
# In a journal, the table as a whole.
_WHOLE = "."
# Where a table's manifests lie, and how the names of delivered files begin.
_MANIFESTS, _DELIVERED = "_deliveries", "delivery-"


def _require_schema(df: DataFrame, schema: T.StructType | None) -> None:
    wrong = [] if schema is None else schema_diff(df.schema, schema)
    if wrong:
        raise ValueError(f"rows do not fit the table: {wrong}")


def _write(
    df: DataFrame, path: str, parts: Sequence[str], mode: str, rebalance: bool = True
) -> None:
    # One day's rows meet in few tasks, so a day gets few files. Rebalancing
    # lets AQE split a day that holds a large share of the rows over many tasks
    # and put small days together, which a plain repartition would not.
    if rebalance:
        df = df.hint("rebalance", *parts)
    df.write.partitionBy(*parts).mode(mode).parquet(path)


def day_folder(year: int, month: int, day: int) -> str:
    """Where a day's files lie below a table."""
    return f"year={year}/month={month}/day={day}"


def swap_is_open(spark: SparkSession, path: str) -> bool:
    """Whether a replacement of the table is under way or was cut off."""
    previous = Folder(spark, path).beside("previous")
    return previous.exists() and not previous.within(_DONE).exists()


def restore_interrupted(spark: SparkSession, path: str) -> None:
    """Undo a replacement of the table that was cut off; tidy up after a finished one.

    What had come in place of an old folder is set aside under a hidden name,
    never deleted. The swap of a writer who still holds the lease is not touched:
    then this raises.
    """
    if not Folder(spark, path).beside("previous").exists():
        return
    with writing(spark, path) as lease:
        lease.check()
        _restore(spark, path)


def _restore(spark: SparkSession, path: str) -> None:
    table = Folder(spark, path)
    previous = table.beside("previous")
    if not previous.within(_DONE).exists():
        aside = table.beside(f"undone-{uuid.uuid4().hex}")
        journal = previous.within(_JOURNAL)
        # Without a journal nothing had been moved.
        for line in journal.text().splitlines() if journal.exists() else []:
            existed, part = line.split(" ", 1)
            now, old = _places(table, previous, part)
            if old.exists() or existed == "0":
                if now.exists():
                    now.move_to(aside if part == _WHOLE else aside.within(part))
                if old.exists():
                    old.move_to(now)
    previous.delete()
    spark.catalog.refreshByPath(path)


def _places(table: Folder, previous: Folder, part: str) -> tuple[Folder, Folder]:
    if part == _WHOLE:
        return table, previous.within("table")
    return table.within(part), previous.within(part)


def _swap(spark: SparkSession, path: str, staged: Folder, parts: Iterable[str]) -> None:
    """Put the staged folders in the places of the table's; a part not staged goes away."""
    table = Folder(spark, path)
    previous = table.beside("previous")
    with writing(spark, path) as lease:
        lease.check()
    places = {part: _places(table, previous, part) for part in parts}
    lines = [f"{int(now.exists())} {part}" for part, (now, _) in places.items()]
    previous.within(_JOURNAL).put("\n".join(lines))
    try:
        for now, old in places.values():
            if now.exists():
                now.move_to(old)
        for part, (now, _) in places.items():
            new = staged if part == _WHOLE else staged.within(part)
            if new.exists():
                new.move_to(now)
    except Exception:
        restore_interrupted(spark, path)
        raise
    previous.within(_DONE).put("")
    restore_interrupted(spark, path)
    spark.catalog.refreshByPath(path)


def replace_folder(spark: SparkSession, path: str, staged: Folder) -> None:
    """Put a staged folder in the place of the one at `path`, or leave that as it was."""
    _swap(spark, path, staged, [_WHOLE])


def _replace(
    df: DataFrame, path: str, schema: T.StructType | None, parts: Sequence[str],
    days: Sequence[str] | None, at_least: int, exactly: int | None, rebalance: bool,
) -> int:
    spark = df.sparkSession
    _require_schema(df, schema)
    with writing(spark, path):
        return _replaced(df, path, parts, days, at_least, exactly, rebalance)


def _replaced(
    df: DataFrame, path: str, parts: Sequence[str], days: Sequence[str] | None,
    at_least: int, exactly: int | None, rebalance: bool,
) -> int:
    spark = df.sparkSession
    restore_interrupted(spark, path)
    # The folder is hidden, the table in it is not: Spark warns on reading that.
    staging = Folder(spark, path).beside(f"staged-{uuid.uuid4().hex}")
    staged = staging.within("table")
    try:
        _write(df, staged.path, parts, "errorifexists", rebalance)
        # Counting reads the file footers only.
        rows = spark.read.schema(df.schema).parquet(staged.path).count()
        if rows < at_least or (exactly is not None and rows != exactly):
            wanted = f"{at_least} or more" if exactly is None else f"{exactly}"
            raise ValueError(f"{rows} rows were staged for {path}, expected {wanted}")
        if days is not None:
            written = {file.rpartition("/")[0] for file in staged.files()}
            strange = sorted(written - set(days))
            if strange:
                raise ValueError(f"rows were staged for days not to be replaced: {strange[:3]}")
        _swap(spark, path, staged, [_WHOLE] if days is None else days)
    finally:
        staging.delete()
    return rows


def publish_partitioned(
    df: DataFrame,
    path: str,
    schema: T.StructType | None = None,
    parts: Sequence[str] = DAY_PARTS,
    at_least: int = 0,
) -> int:
    """Replace the table at `path` by `df`, which may read that table.

    Only if the rows fit `schema` and there are `at_least` so many do they take
    the table's place. Renames move whole folders on HDFS and local disks; on an
    object store use `publish_version`. Returns the number of rows.
    """
    return _replace(df, path, schema, parts, None, at_least, None, True)


def publish_days(
    df: DataFrame,
    path: str,
    days: Sequence[str],
    schema: T.StructType | None = None,
    exactly: int | None = None,
    at_least: int = 0,
    rebalance: bool = True,
) -> int:
    """Replace some days' folders of the table at `path` by the rows of `df`, all of those days.

    A day without a row goes away; files of other days are not touched.
    """
    return _replace(df, path, schema, DAY_PARTS, days, at_least, exactly, rebalance)


def append_partitioned(
    df: DataFrame,
    path: str,
    schema: T.StructType | None = None,
    parts: Sequence[str] = DAY_PARTS,
) -> None:
    """Add the rows of `df` to the table at `path`, creating it if absent.

    No stored file is touched, so `df` may read the table. The rows count all at
    once, when the manifest that names them is in place; a write that stops before
    changes nothing and can be run again.
    """
    spark = df.sparkSession
    _require_schema(df, schema)
    with writing(spark, path) as lease:
        restore_interrupted(spark, path)
        table = Folder(spark, path)
        staging = table.beside(f"staged-{uuid.uuid4().hex}")
        staged = staging.within("table")
        delivery, moved = uuid.uuid4().hex, []
        try:
            _write(df, staged.path, parts, "errorifexists")
            table.make()
            if _counted(spark, path)[1] is None:
                # Without a manifest every file would count.
                _count_in(spark, path, [])
            for file in staged.files():
                day, _, name = file.rpartition("/")
                to = table.within(f"{day}/{_DELIVERED}{delivery}-{name}")
                staged.within(file).move_to(to)
                moved.append(to)
            lease.check()
            if moved:
                _count_in(spark, path, [*(_counted(spark, path)[1] or ()), delivery])
        except Exception:
            # Nobody has seen them; those of a writer that dies here go when days are tidied.
            for file in moved:
                file.delete()
            raise
        finally:
            staging.delete()
        spark.catalog.refreshByPath(path)


def _counted(spark: SparkSession, path: str) -> tuple[int, list[str] | None]:
    """(number of the newest manifest, deliveries in it), or (0, None) without one."""
    folder = Folder(spark, path).within(_MANIFESTS)
    numbers = [int(n) for n in folder.names() if n.isdigit()] if folder.exists() else []
    if not numbers:
        return 0, None
    return max(numbers), folder.within(f"{max(numbers):010d}").text().split()


def _count_in(spark: SparkSession, path: str, deliveries: Iterable[str]) -> None:
    """Put a manifest in place: from now on these deliveries count, and no others."""
    folder = Folder(spark, path).within(_MANIFESTS)
    number = _counted(spark, path)[0] + 1
    if not folder.within(f"{number:010d}").create("\n".join(deliveries)):
        raise LeaseLost(f"somebody else has put manifest {number} of {path} in place")
    # The one before stays for those who are about to read it.
    for name in folder.names():
        if name.isdigit() and int(name) < number - 1:
            folder.within(name).delete()


def what_counts(spark: SparkSession, path: str) -> Callable[[DataFrame], DataFrame] | None:
    """The filter that leaves out files of deliveries that do not count (yet).

    Ask for it before the files are listed, so a delivery that ends meanwhile is not seen in
    part. The filter is on file names, which Spark settles while it plans. None if the table
    has no manifest, so that every file counts.
    """
    _, deliveries = _counted(spark, path)
    if deliveries is None:
        return None
    return lambda df: df.where(_counts(F.col("_metadata.file_name"), deliveries))


def _counts(name: Column, deliveries: Sequence[str]) -> Column:
    at = len(_DELIVERED) + 1
    return ~name.startswith(_DELIVERED) | F.substring(name, at, 32).isin(list(deliveries))


def sweep_deliveries(spark: SparkSession, path: str) -> int:
    """Remove files of deliveries that never came to count, and forget those without files.

    Returns the number of files removed.
    """
    with writing(spark, path) as lease:
        _, deliveries = _counted(spark, path)
        if deliveries is None:
            return 0
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        listed = files.option("pathGlobFilter", f"{_DELIVERED}*").load(path).select("path")
        name = F.substring_index("path", "/", -1)
        of = F.substring(name, len(_DELIVERED) + 1, 32)
        left = {row[0] for row in listed.select(of).distinct().collect()}
        lost = [row[0] for row in listed.where(~of.isin(deliveries)).collect()]
        lease.check()
        for file in lost:
            Folder(spark, file).delete()
        if not left.issuperset(deliveries):
            _count_in(spark, path, [d for d in deliveries if d in left])
        return len(lost)


# ---- versions ---------------------------------------------------------------------

# In a version: the folder of each of its days. Where days lie that were written alone.
_DAYS, _WRITES = "_days", "days"


def publish_version(
    df: DataFrame,
    root: str,
    schema: T.StructType | None = None,
    parts: Sequence[str] = DAY_PARTS,
    at_least: int = 0,
    keep: int = 2,
) -> str:
    """Write `df` as a new version folder below `root` and return its path.

    For object stores, where a folder cannot be renamed in one step: Spark's
    success marker, written last, is what makes a version count. One with fewer
    than `at_least` rows is removed again. The `keep` newest versions stay, so
    those who read the one before are not cut off.
    """
    spark = df.sparkSession
    _require_schema(df, schema)
    with writing(spark, root):
        path = _new_version(root)
        _write(df, path, parts, "errorifexists")
        rows = spark.read.schema(df.schema).parquet(path).count()
        if rows < at_least:
            Folder(spark, path).delete()
            raise ValueError(f"{rows} rows were written for {root}, expected {at_least} or more")
        _drop_old_versions(spark, root, keep)
    return path


def publish_version_days(
    df: DataFrame,
    root: str,
    days: Sequence[str],
    schema: T.StructType | None = None,
    exactly: int | None = None,
    keep: int = 2,
) -> str:
    """A new version in which `days` hold the rows of `df`, and other days are as they were.

    Only these days are written. The version is a manifest that names the folder of each
    day, those of earlier versions included, so both versions share the files of all other
    days. A day without a row goes away. Returns the path of the version.
    """
    spark = df.sparkSession
    _require_schema(df, schema)
    with writing(spark, root) as lease:
        path = _new_version(root)
        write = path.rpartition("/")[2].removeprefix("version-")
        base = Folder(spark, f"{root.rstrip('/')}/{_WRITES}/write={write}")
        before = latest_version(spark, root)
        kept = {} if before is None else _folders_of_days(spark, root, before)
        try:
            _write(df, base.path, DAY_PARTS, "errorifexists")
            rows = spark.read.schema(df.schema).parquet(base.path).count()
            if exactly is not None and rows != exactly:
                raise ValueError(f"{rows} rows were written for {root}, expected {exactly}")
            written = {file.rpartition("/")[0] for file in base.files()}
            if strange := sorted(written - set(days)):
                raise ValueError(f"rows were written for days not to be replaced: {strange[:3]}")
            kept = {day: folder for day, folder in kept.items() if day not in set(days)}
            kept |= {day: f"{_WRITES}/write={write}" for day in written}
            version = Folder(spark, path)
            version.within(_DAYS).put("\n".join(f"{kept[day]} {day}" for day in sorted(kept)))
            lease.check()
        except Exception:
            Folder(spark, path).delete()
            base.delete()
            raise
        version.within("_SUCCESS").put("")
        _drop_old_versions(spark, root, keep)
    return path


def _new_version(root: str) -> str:
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{root.rstrip('/')}/version-{stamp}-{uuid.uuid4().hex[:8]}"


def _folders_of_days(spark: SparkSession, root: str, version: str) -> dict[str, str]:
    """For each day of a version, the folder below `root` that has its files."""
    manifest = Folder(spark, version).within(_DAYS)
    if manifest.exists():
        lines = [line.split(" ", 1) for line in manifest.text().splitlines()]
        return {day: folder for folder, day in lines}
    days = {file.rpartition("/")[0] for file in Folder(spark, version).files()}
    return dict.fromkeys(days, version.rstrip("/").rpartition("/")[2])


def version_folders(spark: SparkSession, path: str) -> dict[str, list[str]] | None:
    """What to read for a version that is a manifest: base folder -> folders of days in it.

    Days that were written alone have one base, whichever version wrote them; None for a
    table, or a version, that has its days below it.
    """
    if not Folder(spark, path).within(_DAYS).exists():
        return None
    root = path.rstrip("/").rpartition("/")[0]
    found: dict[str, list[str]] = {}
    for day, folder in sorted(_folders_of_days(spark, root, path).items()):
        base = folder.split("/")[0]
        found.setdefault(f"{root}/{base}", []).append(f"{root}/{folder}/{day}")
    return found


def _drop_old_versions(spark: SparkSession, root: str, keep: int) -> None:
    """Remove versions but the `keep` newest, and what only those had."""
    versions = _versions(spark, root)
    kept, old = versions[:max(keep, 1)], versions[max(keep, 1):]
    folder = Folder(spark, root)
    used: dict[str, set[str]] = {}
    for version in kept:
        for day, of in _folders_of_days(spark, root, version).items():
            used.setdefault(of, set()).add(day)
    for version in old:
        if version.rpartition("/")[2] not in used:
            Folder(spark, version).delete()
    writes = folder.within(_WRITES)
    for name in writes.names() if writes.exists() else []:
        here, days = writes.within(name), used.get(f"{_WRITES}/{name}", set())
        if not days:
            here.delete()
        else:
            for day in {file.rpartition("/")[0] for file in here.files()} - days:
                here.within(day).delete()


def _versions(spark: SparkSession, root: str) -> list[str]:
    """Complete versions below `root`, newest first."""
    folder = Folder(spark, root)
    if not folder.exists():
        return []
    names = sorted((n for n in folder.names() if n.startswith("version-")), reverse=True)
    return [f"{folder.path}/{n}" for n in names if folder.within(f"{n}/_SUCCESS").exists()]


def latest_version(spark: SparkSession, root: str) -> str | None:
    """The newest complete version below `root`, or None."""
    return next(iter(_versions(spark, root)), None)
