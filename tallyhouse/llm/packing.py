"""Packing: documents as token windows of one length, by best-fit decreasing.

A document is its tokens and an end token. It is first cut into full windows;
what remains, longest first, goes to the open window that it fills best, found
in a segment tree indexed by remaining capacity. Documents are dealt by hash
into bins of some `BIN_PIECES` pieces, each packed on its own: the padding is
that of the few windows at each bin's end, whatever the size of the corpus.

Null and empty texts are the end token alone. Repeated rows are documents of
their own. Special tokens written out in a text have their own ids, as in the
tokenizer's library, and runs of white space may be of any length. Columns beside
id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.byte_bpe import VOCABULARY, encoder
from tallyhouse.llm.common import dealt, slices, stored

WINDOW = 1024
END = 0
BIN_PIECES = 65_536
# Bytes of a piece's row on its way to its bin, or so.
PIECE_ROW = 64


def token_ids(text: str | None, vocabulary: str = VOCABULARY) -> np.ndarray:
    return np.array([*encoder(vocabulary)(text or ""), END], dtype="<u4")


_PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(
    docs: DataFrame, id_column: str, text_column: str, window: int, vocabulary: str
) -> DataFrame:
    """Full windows of each document and its remainder, with a checksum of their ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                ids = token_ids(text, vocabulary)
                for start in range(0, len(ids), window):
                    part = ids[start:start + window]
                    rows.append((doc, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in columns],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    texts = docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text")
    )
    return texts.mapInArrow(cut, _PIECE)


class OpenWindows:
    """Windows by remaining capacity: a segment tree whose leaves count them."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, number: int) -> None:
        self.at[capacity].append(number)
        node = capacity + self.leaves
        while node:
            self.tree[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove the window with the least capacity of `least` or more: (capacity, number)."""
        node = least + self.leaves
        if not self.tree[node]:
            # Up to the first ancestor with windows to the right, then down to the leftmost.
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        number = self.at[capacity].pop()
        while node:
            self.tree[node] -= 1
            node >>= 1
        return capacity, number


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset for each length; the lengths come longest first."""
    open_windows, numbers, offsets, made = OpenWindows(window), [], [], 0
    for length in lengths:
        capacity, number = open_windows.take(length) or (window, made)
        made += number == made
        numbers.append(number)
        offsets.append(window - capacity)
        if capacity > length:
            open_windows.add(capacity - length, number)
    return numbers, offsets


def pack(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW,
    vocabulary: str = VOCABULARY, bin_pieces: int = BIN_PIECES,
) -> DataFrame:
    """A row per piece: its document's id, its place there, its window and its place in that.

    `padded_length` is what the window is padded to: its own tokens if they number a power of
    two, else the whole window.
    """
    cut = stored(pieces(docs, id_column, text_column, window, vocabulary), "pieces")
    count = cut.count()
    bins = count // bin_pieces + 1

    def fill(table: pa.Table) -> pa.Table:
        order = [("length", "descending"), *((c, "ascending") for c in ("doc_id", "start", "ids_crc32"))]
        table = table.sort_by(order)
        numbers, offsets = best_fit(table.column("length").to_pylist(), window)
        first = table.column("bin")[0].as_py() << 40
        used = np.bincount(numbers, weights=table.column("length").to_numpy()).astype(np.int64)
        padded = np.where(used & (used - 1), window, used)[numbers]
        table = table.append_column("sequence_id", pa.array(np.array(numbers, np.int64) + first))
        table = table.append_column("offset", pa.array(offsets, pa.int64()))
        return table.append_column("padded_length", pa.array(padded)).drop_columns("bin")

    binned = cut.withColumn("bin", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(bins)))
    packed = dealt(binned, count * PIECE_ROW, "bin").groupBy("bin").applyInArrow(
        fill, f"{_PIECE}, sequence_id bigint, offset bigint, padded_length bigint"
    )
    return packed.withColumnRenamed("doc_id", id_column)
