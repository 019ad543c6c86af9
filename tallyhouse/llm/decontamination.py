"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are compared in lower case with one space for each run of white space, as
UTF-8 bytes. An item of m bytes, `SHORT` or more, is in a document if some region of
the document is at most k = m * RATE edits away. Such a region shares at least
m - Q + 1 - Q*k q-grams with the item, all on diagonals no more than k apart, so
shared q-grams are counted in bands of diagonals that overlap by half; bands that
reach the bound are verified by an alignment that stays within them. No document is
cut, and no candidate is left out.

A q-gram that a text and an item both repeat is not counted place by place. Its places
in the text that lie no further apart than a band is wide are one stretch, which
covers a range of bands for each place in the item; so the work for an item grows with
the text, not with the places times the places, and is done in parts of bounded size.

An item below `SHORT` bytes says too little once it is edited. It has to stand there
as it is, and a letter or digit at either of its ends must not go on in the text.

The benchmark is the query set: it is taken in blocks of `BLOCK_BYTES` at most,
each of which meets every document once. Null and empty items are not found. Null and
empty texts hold nothing. Repeated rows are judged each. Columns beside id and text
are carried along.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import fresh, slices

Q = 7  # a q-gram and one byte more are a 64-bit word
RATE = 0.1
# From this length on the lemma asks for a shared q-gram at every number of edits.
SHORT = 24
BLOCK_BYTES = 2 * 1024 * 1024

# A byte that no normalized text has stands between texts and beyond their ends.
_GAP = 10
_BITS = 20
_SLOTS = 18
# Places of shared q-grams that are counted at once, and diagonals that are aligned at once.
PART = 500_000
# Diagonals that are counted at once, or twice the reach of the longest item.
SPAN = 1 << 18
WIDE = 1 << 16
_MIX = np.uint64(0x9E3779B97F4A7C15)


def normalized(text: str | None) -> bytes:
    return " ".join((text or "").lower().split()).encode("utf-8", "replace")


def _grams(raw: bytes) -> np.ndarray:
    words = np.ndarray((max(len(raw) - Q + 1, 0),), "<u8", raw + b"\0", strides=(1,))
    return words & np.uint64((1 << 8 * Q) - 1)


def _slot(grams: np.ndarray, bits: int) -> np.ndarray:
    return (grams * _MIX) >> np.uint64(64 - bits)


def _key(item: np.ndarray | int, band: np.ndarray) -> np.ndarray:
    return (np.int64(item) << 40) + band + (1 << 20)


def _band(key: np.ndarray) -> np.ndarray:
    return (key & ((1 << 40) - 1)) - (1 << 20)


def _slot_of(key: np.ndarray) -> np.ndarray:
    return _slot(key.astype(np.uint64), _SLOTS).astype(np.int64)


def distance(item: bytes, text: np.ndarray, width: int, most: int | None = None) -> int:
    """Least edits from `item` to a region of `text`.

    Only `width` diagonals are looked at; `text` has len(item) + width bytes. Beyond `most`
    edits the rest is not aligned, and some number above `most` is returned.
    """
    steps = np.arange(width, dtype=np.int32)
    row = np.zeros(width + 1, dtype=np.int32)
    row[-1] = len(item)
    for i, byte in enumerate(item):
        best = np.minimum(row[:-1] + (text[i:i + width] != byte), row[1:] + 1)
        row[:-1] = np.minimum.accumulate(best - steps) + steps
        if most is not None and i % 8 == 7 and row[:-1].min() > most:
            break
    return int(row[:-1].min())


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths - starts, lengths)


def _parts(sizes: np.ndarray) -> Iterator[slice]:
    """Neighbours whose sizes add up to `PART` or so, or single ones."""
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // PART)) + 1
    for low, high in zip([0, *cuts], [*cuts, len(sizes)]):
        yield slice(low, high)


@dataclass
class Block:
    """Some items of the benchmark and the index of their q-grams; the short ones come last."""

    ids: list
    items: list[bytes]

    def __post_init__(self):
        order = sorted(range(len(self.items)), key=lambda i: len(self.items[i]) < SHORT)
        self.ids, self.items = ([column[i] for i in order] for column in (self.ids, self.items))

    def __getstate__(self):
        return {"ids": self.ids, "items": self.items}

    @cached_property
    def long(self) -> list[bytes]:
        return [x for x in self.items if len(x) >= SHORT]

    @cached_property
    def sizes(self) -> np.ndarray:
        return np.array([len(x) for x in self.long], dtype=np.int64)

    @cached_property
    def budgets(self) -> np.ndarray:
        """Edits allowed."""
        return (self.sizes * RATE).astype(np.int64)

    @cached_property
    def bounds(self) -> np.ndarray:
        return self.sizes - Q + 1 - Q * self.budgets

    @cached_property
    def index(self) -> tuple[np.ndarray, ...]:
        """Distinct q-grams; for each, where its places begin; the places; a bitmap of slots."""
        grams = np.concatenate([_grams(x) for x in self.long])
        item = np.repeat(np.arange(len(self.long)), self.sizes - Q + 1)
        place = np.concatenate([np.arange(n) for n in self.sizes - Q + 1])
        order = np.argsort(grams, kind="stable")
        distinct, first = np.unique(grams[order], return_index=True)
        bitmap = np.zeros(1 << _BITS, dtype=bool)
        bitmap[_slot(distinct, _BITS)] = True
        return distinct, np.append(first, len(grams)), item[order], place[order], bitmap

    def shared(self, raw: bytes, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The q-grams that `raw` shares with an item; where each one's places begin, and these
        places, counted from `start`."""
        distinct, _, _, _, bitmap = self.index
        grams = _grams(raw)
        at = np.flatnonzero(bitmap[_slot(grams, _BITS)])
        found = np.minimum(np.searchsorted(distinct, grams[at]), len(distinct) - 1)
        right = distinct[found] == grams[at]
        at, found = at[right], found[right]
        order = np.argsort(found, kind="stable")
        found = found[order]
        begin = np.flatnonzero(np.diff(found, prepend=-1))
        return found[begin], np.append(begin, len(at)), at[order] + start

    def _rare(
        self, shared: np.ndarray, begin: np.ndarray, at: np.ndarray, which: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(key, place in the item) of q-grams with few places, for each place in the text; a key
        is an item and a band."""
        _, first, items, places, _ = self.index
        n_item = first[shared[which] + 1] - first[shared[which]]
        n_text = (begin[1:] - begin[:-1])[which]
        # Each place in an item with each place in the text.
        place = _ranges(first[shared[which]], n_item)
        times = np.repeat(n_text, n_item)
        text = at[_ranges(np.repeat(begin[:-1][which], n_item), times)]
        item, place = np.repeat(items[place], times), np.repeat(places[place], times)
        band = (text - place) // (self.budgets[item] + 1)
        key = _key(item, band)
        return np.concatenate([key, key - 1]), np.concatenate([place, place])

    def _frequent(self, gram: int, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for one q-gram with many places, a part at a time, each place once a band."""
        _, first, items, places, _ = self.index
        here = slice(first[gram], first[gram + 1])
        which, start = np.unique(items[here], return_index=True)
        for item, low, high in zip(which, start, [*start[1:], first[gram + 1] - first[gram]]):
            width = int(self.budgets[item]) + 1
            # Within a stretch some place lies in every `width` diagonals in a row.
            gaps = np.flatnonzero(np.diff(text) > width)
            begins, ends = text[np.append(0, gaps + 1)], text[np.append(gaps, len(text) - 1)]
            mine = places[here][low:high]
            for part in _parts(np.full(len(mine), (ends[-1] - begins[0]) // width + 2)):
                place = mine[part, None]
                from_, to = (begins - place) // width - 1, (ends - place) // width
                from_[:, 1:] = np.maximum(from_[:, 1:], to[:, :-1] + 1)
                many = np.maximum(to - from_ + 1, 0)
                bands = _ranges(from_.ravel(), many.ravel())
                yield _key(item, bands), np.repeat(mine[part], many.sum(1))

    def keys(self, raw: bytes, start: int) -> Callable[[], Iterable[tuple[np.ndarray, np.ndarray]]]:
        """(key, place in the item) of all shared q-grams, in parts, as often as one asks."""
        _, first, *_ = self.index
        shared, begin, at = self.shared(raw, start)
        pairs = (first[shared + 1] - first[shared]) * (begin[1:] - begin[:-1])
        often = pairs > PART // 16
        rare = np.flatnonzero(~often)

        def parts() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            if len(rare):
                for part in _parts(pairs[rare]):
                    yield self._rare(shared, begin, at, rare[part])
            for gram in np.flatnonzero(often):
                yield from self._frequent(shared[gram], at[begin[gram]:begin[gram + 1]])

        if pairs.sum() <= PART:
            held = list(parts())
            return lambda: held
        return parts

    def candidates(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(item, band) where enough q-grams are shared; band j has two widths of diagonals."""
        widths = self.budgets + 1
        reach = int((self.sizes + 2 * widths).max())
        step = max(SPAN, 2 * reach)
        found = [np.zeros(0, np.int64)]
        for low in range(-reach, len(raw), step):
            # The text that the bands which begin on these diagonals can meet.
            start = max(low, 0)
            keys = self._counted(self.keys(raw[start:low + step + reach], start))
            begins = _band(keys) * widths[keys >> 40]
            found.append(keys[(begins >= low) & (begins < low + step)])
        keys = np.sort(np.concatenate(found))
        return keys >> 40, _band(keys)

    def _counted(
        self, parts: Callable[[], Iterable[tuple[np.ndarray, np.ndarray]]]
    ) -> np.ndarray:
        """The keys that come with enough places of their item."""
        # Counted by slot first: a slot holds at least what each of its bands holds.
        many = np.zeros(1 << _SLOTS, np.int64)
        for key, _ in parts():
            many += np.bincount(_slot_of(key), minlength=1 << _SLOTS)
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for key, place in parts():
            likely = many[_slot_of(key)] >= self.bounds[key >> 40]
            key, place = key[likely], place[likely]
            if not len(key):
                continue
            # A place of the item counts once, however often the band has its q-gram.
            order = np.lexsort((place, key))
            key, place = key[order], place[order]
            new = np.append(True, (key[1:] != key[:-1]) | (place[1:] != place[:-1]))
            key, n = np.unique(key[new], return_counts=True)
            # Parts differ in the places of items that they count.
            keys, which = np.unique(np.concatenate([keys, key]), return_inverse=True)
            counts = np.bincount(which, np.concatenate([counts, n]), len(keys)).astype(np.int64)
        return keys[counts >= self.bounds[keys >> 40]]

    def windows(self, raw: bytes) -> Iterator[tuple[int, int, int]]:
        """(item, first diagonal, diagonals) to align: adjoining bands together, up to `WIDE`."""
        last = None
        for item, band in zip(*(x.tolist() for x in self.candidates(raw))):
            budget = int(self.budgets[item])
            first = band * (budget + 1) - budget
            width = 2 * (budget + 1) + 2 * budget
            if last and last[0] == item and first <= last[1] + last[2] and first + width - last[1] <= WIDE:
                last = item, last[1], first + width - last[1]
                continue
            if last:
                yield last
            last = item, first, width
        if last:
            yield last

    def found(self, texts: list[bytes]) -> list[tuple[int, int, int]]:
        """(text, item, edits) for every text that holds an item, with the least edits seen."""
        best: dict[tuple[int, int], int] = self._short(texts)
        raw = bytes([_GAP]).join([*texts, b""])
        ends = np.cumsum([len(x) + 1 for x in texts])
        for item, first, width in self.windows(raw) if self.long else ():
            size, budget = int(self.sizes[item]), int(self.budgets[item])
            # The texts that the window touches; a q-gram has no gap, so an item lies within one.
            low = int(np.searchsorted(ends, max(first, 0), "right"))
            high = int(np.searchsorted(ends, min(first + width + size, len(raw) - 1), "right"))
            for text in range(low, min(high, len(texts) - 1) + 1):
                if best.get((text, item)) == 0:
                    continue
                begin, end = int(ends[text]) - len(texts[text]) - 1, int(ends[text]) - 1
                # Diagonals on which no byte of the item meets one of the text are of no use.
                start, stop = max(first, begin - size), min(first + width, end)
                a, b = max(start, begin), min(stop + size, end)
                if start >= stop or a >= b:
                    continue
                if self.long[item] in raw[a:b]:
                    edits = 0
                else:
                    region = np.full(size + stop - start, _GAP, dtype=np.uint8)
                    region[a - start:b - start] = np.frombuffer(raw, np.uint8, b - a, a)
                    edits = distance(self.long[item], region, stop - start, budget)
                if edits <= budget:
                    best[text, item] = min(edits, best.get((text, item), edits))
        return [(text, item, edits) for (text, item), edits in sorted(best.items())]

    @cached_property
    def _automaton(self):
        """The short items; equal ones are looked for once."""
        import ahocorasick

        found = ahocorasick.Automaton()
        which: dict[str, list[int]] = {}
        for i in range(len(self.long), len(self.items)):
            which.setdefault(self.items[i].decode("utf-8"), []).append(i)
        for item, numbers in which.items():
            found.add_word(item, (item, numbers))
        found.make_automaton()
        return found

    def _short(self, texts: list[bytes]) -> dict[tuple[int, int], int]:
        found: dict[tuple[int, int], int] = {}
        if len(self.long) == len(self.items):
            return found
        for row, raw in enumerate(texts):
            text = raw.decode("utf-8")
            for last, (item, numbers) in self._automaton.iter(text):
                first = last - len(item) + 1
                runs_on = (
                    (first and text[first - 1].isalnum() and item[0].isalnum())
                    or (last + 1 < len(text) and text[last + 1].isalnum() and item[-1].isalnum())
                )
                if not runs_on:
                    found.update({(row, number): 0 for number in numbers})
        return found


def blocks(
    benchmark: DataFrame, item_column: str = "item_id", text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> Iterator[Block]:
    """The benchmark's items in order of id, in blocks whose size is bounded."""
    rows = (
        benchmark.select(F.col(item_column).alias("id"), F.col(text_column).alias("text"))
        .where("text IS NOT NULL").orderBy("id", "text")
    )
    ids, items, held = [], [], 0
    for row in rows.toLocalIterator():
        item = normalized(row["text"])
        if not item:
            continue
        if held and held + len(item) > block_bytes:
            yield Block(ids, items)
            ids, items, held = [], [], 0
        ids.append(row["id"])
        items.append(item)
        held += len(item)
    if items:
        yield Block(ids, items)


def _finder(block: Block) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = block.found([normalized(x) for x in batch.column("text").to_pylist()])
            rows = pa.array([text for text, _, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(rows),
                    pa.array([block.ids[item] for _, item, _ in found], pa.int64()),
                    pa.array([edits for _, _, edits in found], pa.int64()),
                    pa.array([len(block.items[item]) for _, item, _ in found], pa.int64()),
                ],
                ["id", "item", "edits", "size"],
            )

    return run


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """A row for each document and item found in it: ids, least edits, and the item's bytes."""
    texts = docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text")
    )
    schema = "id bigint, item bigint, edits bigint, size bigint"
    out = texts.sparkSession.createDataFrame([], schema)
    for block in blocks(benchmark, item_column, block_bytes=block_bytes):
        out = out.unionByName(texts.mapInArrow(_finder(block), schema))
    return out.select(
        F.col("id").alias(id_column), F.col("item").alias(item_column), "edits",
        F.col("size").alias("item_bytes"),
    )


def _marker(block: Block, text: str, mark: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            held = np.zeros(batch.num_rows, dtype=bool)
            texts = [normalized(x) for x in batch.column(text).to_pylist()]
            held[[row for row, _, _ in block.found(texts)]] = True
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(held)], [*batch.schema.names, mark]
            )

    return run


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of `docs` that hold no item, with the columns of `docs`."""
    mark = fresh(docs, "leaked")
    schema = T.StructType([*docs.schema.fields, T.StructField(mark, T.BooleanType())])
    for block in blocks(benchmark, block_bytes=block_bytes):
        docs = docs.mapInArrow(_marker(block, text_column, mark), schema).where(~F.col(mark)).drop(mark)
    return docs
