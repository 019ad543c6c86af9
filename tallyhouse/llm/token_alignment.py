"""Tokens of two vocabularies over one text, aligned by bytes and scored over the corpus.

Each text is encoded both ways. A token of either side that starts within a token of
the other overlaps it, and every overlap begins with such a start: `merge_asof`, keyed
by document, finds for each start the other side's last start that is not later, and
the two directions together give all links. Where tokens of both sides start together
a new group begins. A pair of ids counts as often as documents hold it linked.

The tables of counts and links are never joined row by row. A task takes a lot of
documents, names the pairs that it holds once, with the number of its documents that
hold each, and writes each document's links as places in that list. Counts are summed
over the lots' lists, come back to each list, and score the links lot by lot. The cost
of the exchange follows the lists, and no task holds more than one lot.

A null or empty text, and one that either side does not give back byte by byte after
a space, has no tokens. Strings of special tokens in a text are plain text. Repeated
rows are documents of their own, each with its own count; an empty table gives no
rows. Columns beside id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.llm.byte_bpe import VOCABULARY, plain_encoder, token_bytes
from tallyhouse.llm.common import dealt, slices
from tallyhouse.folders import Folder
from tallyhouse.session import scratch_path

PIECES = "piece_bpe_32k"
# Text that is aligned at once, and text of the documents in one lot, or one document.
RUN_BYTES = 1024 * 1024
LOT_BYTES = 16 * 1024 * 1024


# ---- both sides of a text ---------------------------------------------------------


@lru_cache(maxsize=2)
def _pieces(vocabulary: str):
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path(f"{vocabulary}.model")
    )


@lru_cache(maxsize=2)
def piece_bytes(vocabulary: str) -> list[bytes]:
    model = _pieces(vocabulary)
    return [
        bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
        for i, piece in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))
    ]


class Side(NamedTuple):
    """What the ids of one vocabulary stand for."""

    tokens: pa.Array
    lengths: np.ndarray
    # Ids as text with what follows them inside a group, at its end first.
    names: pa.Array

    def joined(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, one after the other."""
        found = self.tokens.take(pa.array(ids))
        return found.buffers()[2].to_pybytes() if len(ids) else b""


def _side(tokens: list[bytes], last: str) -> Side:
    names = [f"{i}{mark}" for mark in (last, ",") for i in range(len(tokens))]
    lengths = np.array([len(token) for token in tokens], np.int64)
    return Side(pa.array(tokens, pa.binary()), lengths, pa.array(names, pa.string()))


@lru_cache(maxsize=2)
def _sides(a: str, b: str) -> tuple[Side, Side]:
    return _side(token_bytes(a), "|"), _side(piece_bytes(b), ";")


class Tokens(NamedTuple):
    """Ids of one side for some documents, one after the other, with each token's document."""

    ids: np.ndarray
    doc: np.ndarray
    starts: np.ndarray


def _tokens(ids: list[np.ndarray], lengths: np.ndarray) -> Tokens:
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    ends = np.cumsum(lengths[flat])
    doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    return Tokens(flat, doc, ends - lengths[flat])


def encode(texts: list[str | None], a: str, b: str) -> tuple[list[int], Tokens, Tokens]:
    """Which texts have tokens, and those of both sides; both start at the same bytes."""
    left, right = _sides(a, b)
    by_ranks, by_pieces = plain_encoder(a), _pieces(b)
    kept, ours, theirs = [], [], []
    for row, text in enumerate(texts):
        if not text:
            continue
        whole = f" {text}".encode()
        one = np.array(by_ranks(f" {text}"), np.int32)
        other = np.array(by_pieces.encode(text), np.int32)
        if left.joined(one) == whole and right.joined(other) == whole:
            kept.append(row)
            ours.append(one)
            theirs.append(other)
    return kept, _tokens(ours, left.lengths), _tokens(theirs, right.lengths)


# ---- alignment --------------------------------------------------------------------


def covering(starts: Tokens, other: Tokens) -> np.ndarray:
    """For each token of one side, the other side's token that its first byte lies in."""
    here = pd.DataFrame({"doc": starts.doc, "at": starts.starts})
    there = pd.DataFrame({"doc": other.doc, "at": other.starts, "token": np.arange(len(other.ids))})
    return pd.merge_asof(here, there, on="at", by="doc")["token"].to_numpy()


class Aligned(NamedTuple):
    """Links as places of tokens, and which tokens begin a group."""

    ours: np.ndarray
    theirs: np.ndarray
    begins_a: np.ndarray
    begins_b: np.ndarray


def align_run(a: Tokens, b: Tokens) -> Aligned:
    to_b, to_a = covering(a, b), covering(b, a)
    begins_a = b.starts[to_b] == a.starts
    begins_b = a.starts[to_a] == b.starts
    # Where both start together, both directions name the same link.
    late = np.flatnonzero(~begins_b)
    return Aligned(
        np.concatenate([np.arange(len(a.ids)), to_a[late]]), np.concatenate([to_b, late]),
        begins_a, begins_b,
    )


def align(a: Tokens, b: Tokens, most: int = RUN_BYTES) -> Aligned:
    """All documents at once, or a long one in runs that end where tokens of both sides end."""
    if not len(a.ids) or a.starts[-1] < 2 * most:
        return align_run(a, b) if len(a.ids) else Aligned(*[np.zeros(0, np.int64)] * 2, *[np.zeros(0, bool)] * 2)
    both = a.starts[np.isin(a.starts, b.starts, assume_unique=True)]
    cuts = [0]
    while (at := np.searchsorted(both, cuts[-1] + most)) < len(both):
        cuts.append(int(both[at]))
    found = []
    for low, high in zip(cuts, [*cuts[1:], np.iinfo(np.int64).max]):
        runs = []
        for side in (a, b):
            first, last = np.searchsorted(side.starts, [low, high])
            runs.append((first, Tokens(*(column[first:last] for column in side))))
        (from_a, run_a), (from_b, run_b) = runs
        run = align_run(run_a, run_b)
        found.append(run._replace(ours=run.ours + from_a, theirs=run.theirs + from_b))
    return Aligned(*(np.concatenate(column) for column in zip(*found)))


def written(a: Tokens, b: Tokens, found: Aligned, sides: tuple[Side, Side], docs: int) -> list[bytes]:
    """Each document's groups as text: `a1,a2|b1;a3|b2,b3`."""
    left, right = sides
    group_a, group_b = np.cumsum(found.begins_a) - 1, np.cumsum(found.begins_b) - 1
    # A group's tokens of one side come before those of the other and after all earlier groups.
    first_b = np.flatnonzero(found.begins_b)
    end_a = np.append(np.flatnonzero(found.begins_a)[1:], len(a.ids))
    places_a = np.arange(len(a.ids)) + first_b[group_a]
    places_b = np.arange(len(b.ids)) + end_a[group_b]
    last_a = np.append(found.begins_a[1:], True)
    last_b = np.append(found.begins_b[1:], True)
    names = pa.concat_arrays([left.names, right.names])
    order = np.empty(len(a.ids) + len(b.ids), np.int64)
    order[places_a] = a.ids + np.where(last_a, 0, len(left.tokens))
    order[places_b] = len(left.names) + b.ids + np.where(last_b, 0, len(right.tokens))
    text = names.take(pa.array(order))
    ends = np.frombuffer(text.buffers()[1], np.int32)[: len(order) + 1]
    counts = np.bincount(a.doc, minlength=docs) + np.bincount(b.doc, minlength=docs)
    cuts = ends[np.append(0, np.cumsum(counts))]
    buffer = memoryview(text.buffers()[2] or b"")
    # The last group has nothing after it.
    return [bytes(buffer[low:high - 1]) for low, high in zip(cuts[:-1], cuts[1:])]


# ---- lots -------------------------------------------------------------------------


def _small(numbers: np.ndarray) -> bytes:
    """Numbers that never fall, as their differences in a compressed form."""
    steps = np.diff(numbers, prepend=0).astype("<u4")
    return len(numbers).to_bytes(8, "little") + pa.compress(steps.tobytes(), "zstd", asbytes=True)


def _numbers(held: bytes) -> np.ndarray:
    size = int.from_bytes(held[:8], "little")
    raw = pa.decompress(held[8:], 4 * size, "zstd", asbytes=True)
    return np.cumsum(np.frombuffer(raw, "<u4").astype(np.int64))


class Lot:
    """Documents that share one list of pairs."""

    def __init__(self) -> None:
        self.bytes = 0
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, row: tuple, pairs: np.ndarray, times: np.ndarray) -> None:
        self.rows.append(row)
        self.pairs.append(pairs)
        self.times.append(times)

    def batch(self, number: int) -> pa.RecordBatch:
        """A row per document, and a first one that has the list."""
        names, places = np.unique(np.concatenate(self.pairs), return_inverse=True)
        held = np.bincount(places, minlength=len(names))
        ends = np.cumsum([len(x) for x in self.pairs])[:-1]
        links = [_small(x) for x in np.split(places, ends)]
        # Times are one or more each, so their sums never fall.
        times = [_small(np.cumsum(x)) for x in self.times]
        columns = list(zip(*self.rows))
        width = len(self.rows)
        fields = [
            pa.array([number] * (width + 1), pa.int64()),
            *[pa.array([None, *column], pa.int64()) for column in columns[:5]],
            pa.array([None, *columns[5]], pa.string()),
            pa.array([None, *links], pa.binary()),
            pa.array([None, *times], pa.binary()),
            pa.array([names, *[None] * width], pa.list_(pa.int64())),
            pa.array([held, *[None] * width], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(fields, _LOT_NAMES)


_DOC = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string"
_LOT = f"lot bigint, {_DOC}, links binary, times binary, pairs array<bigint>, held array<bigint>"
_LOT_NAMES = [field.split()[0] for field in _LOT.split(", ")]


def lots(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", a: str = VOCABULARY,
    b: str = PIECES, digest: bool = False, run_bytes: int = RUN_BYTES, lot_bytes: int = LOT_BYTES,
) -> DataFrame:
    """A row per document with its alignment, and a row per lot with its pairs of linked ids.

    `groups` is the alignment as text, or the SHA-256 of that with `digest`.
    """

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(a, b)
        wide = np.int64(len(sides[1].tokens))
        every = wide * len(sides[0].tokens)
        number = TaskContext.get().partitionId() << 32
        lot = Lot()
        for batch in slices(batches, "text", run_bytes):
            ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            size = sum(map(len, filter(None, texts)))
            if lot.rows and lot.bytes + size > lot_bytes:
                yield lot.batch(number)
                lot, number = Lot(), number + 1
            lot.bytes += size
            kept, ours, theirs = encode(texts, a, b)
            found = align(ours, theirs, run_bytes)
            n = len(kept)
            groups = written(ours, theirs, found, sides, n) if n else []
            doc = ours.doc[found.ours]
            pair = ours.ids[found.ours] * wide + theirs.ids[found.theirs]
            pairs, times = np.unique(doc * every + pair, return_counts=True)
            cuts = np.searchsorted(pairs, np.arange(1, n) * every)
            counts = [
                np.bincount(x, minlength=n)
                for x in (ours.doc, theirs.doc, ours.doc[found.begins_a], doc)
            ]
            split = list(zip(np.split(pairs % every, cuts), np.split(times, cuts)))
            at = {row: i for i, row in enumerate(kept)}
            none = np.zeros(0, np.int64)
            for row, doc_id in enumerate(ids):
                if row in at:
                    i = at[row]
                    text = hashlib.sha256(groups[i]).hexdigest() if digest else groups[i].decode()
                    lot.add((doc_id, *(int(x[i]) for x in counts), text), *split[i])
                else:
                    lot.add((doc_id, 0, 0, 0, 0, ""), none, none)
        if lot.rows:
            yield lot.batch(number)

    texts = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text_column}`").alias("text")
    )
    return texts.mapInArrow(take, _LOT)


# ---- scores -----------------------------------------------------------------------

_SCORED = f"{_DOC}, n_best bigint, count_sum bigint"


def _score(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of one lot with what their links count."""
    pairs = pairs.sort_by("place")
    counts = pairs.column("n").to_numpy().astype(np.int64)
    best = pairs.column("best").to_numpy(zero_copy_only=False).astype(np.int64)
    n_best, count_sum = [], []
    for links, times in zip(docs.column("links").to_pylist(), docs.column("times").to_pylist()):
        places = _numbers(links)
        often = np.diff(_numbers(times), prepend=0)
        n_best.append(int(best[places] @ often))
        count_sum.append(int(counts[places] @ often))
    kept = docs.select([field.split()[0] for field in _DOC.split(", ")])
    kept = kept.append_column("n_best", pa.array(n_best, pa.int64()))
    return kept.append_column("count_sum", pa.array(count_sum, pa.int64()))


def pair_counts(lists: DataFrame, pieces: int) -> DataFrame:
    """How many documents hold each pair, and whether no pair of its first id has more.

    A first id has no more pairs than the second vocabulary has ids.
    """
    counted = lists.groupBy("pair").agg(F.sum("held").alias("n"))
    of_first = Window.partitionBy(F.floor(F.col("pair") / F.lit(pieces)))
    return counted.withColumn("best", F.col("n") == F.max("n").over(of_first))


def align_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", a: str = VOCABULARY,
    b: str = PIECES, digest: bool = False, run_bytes: int = RUN_BYTES, lot_bytes: int = LOT_BYTES,
) -> DataFrame:
    """A row per document: its tokens on both sides, groups, links, and what the links count.

    `n_best` is the number of links whose pair has the highest count of its first id,
    `count_sum` the sum of the counts over all links.
    """
    spark = docs.sparkSession
    found = lots(docs, id_column, text_column, a, b, digest, run_bytes, lot_bytes)
    path = scratch_path(spark, "alignments")
    found.write.option("compression", "zstd").parquet(path)

    def kept() -> DataFrame:
        return spark.read.schema(found.schema).parquet(path)

    lists = kept().where("pairs IS NOT NULL").select(
        "lot", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "of")
    ).select("lot", "place", F.col("of.pairs").alias("pair"), F.col("of.held").alias("held"))
    counts = pair_counts(lists, len(piece_bytes(b)))
    scores = lists.join(counts, "pair").select("lot", "place", "n", "best")
    # Links arrive compressed, and take some three times their room in a task.
    total = 3 * Folder(spark, path).size()
    rows = dealt(kept().where("pairs IS NULL").drop("pairs", "held"), total, "lot")
    scores = dealt(scores, total, "lot")
    scored = rows.groupBy("lot").cogroup(scores.groupBy("lot")).applyInArrow(_score, _SCORED)
    return scored.withColumnRenamed("doc_id", id_column)
