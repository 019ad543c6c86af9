"""SimHash near-dedup by pigeonhole blocks.

A fingerprint has a bit set where more than half the shingle hashes have it.
The 64 bits are cut into b blocks; two fingerprints that differ in at most d bits
agree in b - d whole blocks, so each is filed under every choice of that many
blocks, and only fingerprints filed together are compared, by their Hamming
distance. The more fingerprints there are, the more blocks: every number of
blocks gives the same links, and files stay small.

Equal fingerprints are one before anything is compared, so a group of copies
costs as much as one document. Within a file, a search from fingerprint to
fingerprint gives the links that hold it together, never all pairs: what one
link has joined is not compared again. A file whose fingerprints are mostly far from
each other is filed again by blocks of its other bits, so that its cost stays far below
the square of its size. Linked files make components.

Null and empty texts have fingerprint zero and link like any other. Repeated
rows get a row each. A null id is never smallest; a component of null ids alone
has a null id. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import slices, stored
from tallyhouse.llm.components import components

SHINGLE = 4
MOST_BITS = 4
SEED = 42
# Fingerprints that a file should hold on average; more blocks make more and smaller files.
FILED_TOGETHER = 16
# Looks at all fingerprints of a file after which it is cut into files of its own.
SEARCHES = 256

_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text: A-Z in lower case, words apart at ASCII white space."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    # The words with one space between, and where each begins and ends in there.
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    last = max(len(words) - shingle, 0)
    hashed = xxhash.xxh64_intdigest
    pairs = zip(starts[: last + 1].tolist(), ends[len(ends) - last - 1:].tolist())
    n = last + 1
    hashes = np.fromiter((hashed(joined[a:b], SEED) for a, b in pairs), np.uint64, n)
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, n, 65_536):
        part = hashes[start:start + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << bit for bit in np.flatnonzero(2 * counts > n).tolist()))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def with_fingerprints(
    docs: DataFrame, id_column: str, text_column: str, shingle: int, digests: bool = False,
) -> DataFrame:
    """id and fingerprint (a bigint of the same bits) of each row, and the digest of its text."""
    kept = ["id", "digest"] if digests else ["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            prints = [_signed(fingerprint(x, shingle)) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, kept), pa.array(prints, pa.int64())], [*kept, "print"]
            )

    texts = docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text")
    )
    if digests:
        texts = texts.withColumn("digest", F.xxhash64("text"))
    return texts.mapInArrow(run, ", ".join(f"{name} bigint" for name in (*kept, "print")))


def blocks_for(count: int, most_bits: int) -> int:
    """The least number of blocks with which `count` even fingerprints make small files."""
    for blocks in range(most_bits + 2, 17):
        bits = 64 * (blocks - most_bits) // blocks
        if count >> bits <= FILED_TOGETHER:
            return blocks
    return 16


def _files(most_bits: int, blocks: int) -> list[tuple[int, int]]:
    """(number, mask) of every choice of `blocks - most_bits` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    chosen = combinations(masks, blocks - most_bits)
    return [(number, sum(choice)) for number, choice in enumerate(chosen)]


def _links_of(
    prints: np.ndarray, most_bits: int, mask: int = 0
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join what can be joined among `prints`, which agree in the bits of `mask`.

    A search from one fingerprint to those near it is compared with all that are left, and
    what it finds is left no more; so what is linked costs little. Where `SEARCHES` such looks
    at all of them have not been enough, most are far from each other. Then those that nobody
    has looked from yet are filed again, by blocks of the bits that `mask` leaves.
    """
    # In no order, so that a large group of linked ones is soon come upon.
    left = prints[np.argsort(prints * _SPREAD, kind="stable")]
    looks = SEARCHES * len(prints) if len(prints) > SEARCHES else len(prints) ** 2
    while len(left) > 1:
        frontier, left = [left[:1]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            for n, one in enumerate(at):
                if looks < 0:
                    waiting = np.concatenate([at[n:], *frontier, left])
                    yield from _filed_again(waiting, most_bits, mask)
                    return
                looks -= len(left)
                near = np.bitwise_count(left ^ one) <= most_bits
                if near.any():
                    found = left[near]
                    yield np.full(len(found), one), found
                    frontier.append(found)
                    left = left[~near]
                if not len(left):
                    break


def _filed_again(
    prints: np.ndarray, most_bits: int, mask: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """`_links_of` those that also agree in enough blocks of the bits outside `mask`."""
    bits = [1 << bit for bit in range(64) if not mask >> bit & 1]
    if len(bits) <= most_bits:
        yield np.full(len(prints) - 1, prints[0]), prints[1:]
        return
    blocks = min(len(bits), most_bits + 2)
    edges = [len(bits) * i // blocks for i in range(blocks + 1)]
    parts = [sum(bits[a:b]) for a, b in zip(edges, edges[1:])]
    for choice in combinations(parts, blocks - most_bits):
        more = sum(choice)
        key = prints & np.uint64(more)
        order = np.argsort(key, kind="stable")
        new = np.flatnonzero(np.diff(key[order])) + 1
        bounds = np.concatenate(([0], new, [len(prints)]))
        for at in np.flatnonzero(np.diff(bounds) > 1):
            yield from _links_of(prints[order[bounds[at]:bounds[at + 1]]], most_bits, mask | more)


def _link(most_bits: int, masks: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come ordered by file; a file may go on in the next batch."""
        held: list[pa.RecordBatch] = []

        def links(rows: pa.Table) -> pa.RecordBatch:
            file = rows.column("file").to_numpy()
            key, prints = rows.column("key").to_numpy(), rows.column("print").to_numpy()
            new = np.flatnonzero((file[1:] != file[:-1]) | (key[1:] != key[:-1])) + 1
            bounds = np.concatenate(([0], new, [len(prints)]))
            found = []
            for at in np.flatnonzero(np.diff(bounds) > 1):
                group = np.unique(prints[bounds[at]:bounds[at + 1]]).view(np.uint64)
                found.extend(_links_of(group, most_bits, masks[file[bounds[at]]]))
            a = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.uint64)
            b = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.uint64)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
            )

        for batch in batches:
            held.append(batch)
            file, key = batch.column("file").to_numpy(), batch.column("key").to_numpy()
            same = (file == file[-1]) & (key == key[-1])
            start = int(np.argmax(same)) if len(same) else 0
            before = held[0]
            if start == 0 and before.column("key")[0] == batch.column("key")[-1] \
                    and before.column("file")[0] == batch.column("file")[-1]:
                continue  # all of one file so far
            yield links(pa.Table.from_batches([*held[:-1], batch.slice(0, start)]))
            held = [batch.slice(start)]
        if held:
            yield links(pa.Table.from_batches(held))

    return run


def linked_prints(prints: DataFrame, most_bits: int, blocks: int) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints in `prints` joined by some chain."""
    if not 0 <= most_bits < blocks:
        raise ValueError("there must be more blocks than bits that may differ")
    files = _files(most_bits, blocks)
    masks = F.array(*[
        F.struct(F.lit(n).alias("file"), F.lit(_signed(mask)).cast("bigint").alias("mask"))
        for n, mask in files
    ])
    filed = prints.select("print", F.explode(masks).alias("m")).select(
        "m.file", F.col("print").bitwiseAND(F.col("m.mask")).alias("key"), "print"
    )
    return (
        filed.repartition("file", "key").sortWithinPartitions("file", "key")
        .mapInArrow(_link(most_bits, [mask for _, mask in files]), "a bigint, b bigint").distinct()
    )


def _hex(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def _with_components(
    docs: DataFrame, id_column: str, text_column: str, digests: bool = False,
    shingle: int = SHINGLE, most_bits: int = MOST_BITS, blocks: int | None = None,
) -> DataFrame:
    """Per row: id, print and component_id; with `digests` also digest and root.

    The root names a component whatever its ids are.
    """
    each = stored(with_fingerprints(docs, id_column, text_column, shingle, digests), "prints")
    distinct = stored(each.groupBy("print").agg(F.min("id").alias("least")), "distinct-prints")
    blocks = blocks or blocks_for(distinct.count(), most_bits)
    roots = components(linked_prints(distinct.select("print"), most_bits, blocks))
    rooted = distinct.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    names = ["print", "component_id", "root"] if digests else ["print", "component_id"]
    of_print = stored(rooted.join(least, "root").select(*names), "print-components")
    return each.join(of_print, "print")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    shingle: int = SHINGLE, most_bits: int = MOST_BITS, blocks: int | None = None,
) -> DataFrame:
    """Per row: id, fingerprint (16 hex digits) and component_id, the smallest id reachable."""
    found = _with_components(
        docs, id_column, text_column, shingle=shingle, most_bits=most_bits, blocks=blocks
    )
    return found.select(F.col("id").alias(id_column), _hex("print").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                **settings: int) -> DataFrame:
    """Of each component one row of `docs`: that with the smallest id, a null id after all others.

    Of several rows with that id in the component, that with the least text stays. An id may
    have rows in several components, which are settled one by one: a row is known by its id and
    the digest of its text. Texts are dealt out by these once, whatever the number of rows left
    out; only rows that share the smallest id of their component move again.
    """
    found = stored(
        _with_components(docs, id_column, text_column, True, **settings)
        .select("id", "digest", "root", "component_id"), "components",
    )
    first = F.col("id").eqNullSafe(F.col("component_id"))
    firsts = stored(
        found.where(first).groupBy("root", "id", "digest").agg(F.count("*").alias("n")), "first-rows"
    )
    several = firsts.groupBy("root").agg(F.sum("n").alias("n")).where("n > 1").select("root")
    repeated = stored(firsts.join(several, "root").select("id", "digest", "root"), "repeated-rows")
    others = stored(
        found.where(~first).select("id", "digest").distinct()
        .unionByName(repeated.select("id", "digest")), "other-rows",
    )
    # The columns of `docs` travel as one struct, so that no name of theirs can clash.
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row")[id_column].cast("bigint").alias("id"),
        F.xxhash64(F.col("row")[text_column]).alias("digest"),
    ).alias("a")
    same = F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.digest") == F.col("b.digest"))
    alone = rows.join(others.hint("merge").alias("b"), same, "left_anti").select("row")
    text = F.coalesce(F.col("row")[text_column], F.lit(""))
    one = (
        rows.join(repeated.alias("b"), same).select("row", "b.root")
        .groupBy("root").agg(F.min_by("row", text).alias("row")).select("row")
    )
    return alone.unionByName(one).select(
        *[F.col("row")[name].alias(name) for name in docs.columns]
    )
