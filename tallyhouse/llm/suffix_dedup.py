"""Suffix-array dedup: bytes of strings that an earlier document also has are removed.

A byte is removed if a string of `LENGTH` bytes that covers it also starts in a
document with a smaller id. Strings are judged on the input, so the first
document keeps all of its own and overlaps count.

No task can hold the suffixes of a corpus, so they are dealt out by content.
Every string of `LENGTH` bytes has a minimizer, the least hash among its
`GRAM`-byte grams; equal strings have equal minimizers. In turn:

1. copies of whole texts are found by SHA-256; only the first goes on;
2. the minimizers of all texts are counted, by slices of the corpus: those found
   in two texts are the only ones whose strings can have a copy;
3. stretches of text with such a minimizer go to the task of that minimizer.
   Equal stretches are settled at once. Of the others the suffixes are put in order
   with what neighbours have in common. The previous and the next position of a
   smaller id in that order give each suffix its longest previous factor, and the
   strings whose factor reaches `LENGTH` have an earlier copy. Order and factors
   are exact up to `DEPTH` bytes, and what is longer counts as that;
4. the spans found go back to their documents and are cut out.

Texts travel compressed, and whole groups are bounded: what repeats within a slice
or a bucket is reduced there before it is sent, and a minimizer that very many
texts have travels as single strings, dealt by their own hash.

A null text is empty. A null id comes after all others. Rows of one id do not take
from each other, so repeated rows get the same result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import dealt, stored

LENGTH = 50
GRAM = 24
# Bytes to which suffixes are ordered and factors measured: a power of two above `LENGTH`.
DEPTH = 64
# Text that one task holds: of a slice, of a bucket of documents, of a share of the minimizers.
SLICE_BYTES = 4 * 1024 * 1024
BUCKET_BYTES = 8 * 1024 * 1024
SHARE_BYTES = 24 * 1024 * 1024
# Bytes of which one suffix array is built.
ARRAY_BYTES = 1024 * 1024
# A minimizer that more texts have than this travels as single strings.
MANY = 2048

_LAST = (1 << 63) - 1
_STRIDE = 1 << 20
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _words(raw: np.ndarray, count: int, offset: int) -> np.ndarray:
    """The 8 bytes that begin at each of `count` places, as one number each."""
    return np.ndarray((count,), "<u8", raw.data, offset, strides=(1,))


def minimizers(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first string, strings, minimizer) of each stretch of strings with one minimizer.

    Long texts are taken a stride at a time; that may cut a stretch in two, no more.
    """
    starts, counts, values = [], [], []
    strings = len(text) - LENGTH + 1
    raw = np.frombuffer(text, dtype=np.uint8)
    for at in range(0, max(strings, 0), _STRIDE):
        n = min(_STRIDE, strings - at)
        grams = n + LENGTH - GRAM
        x = _words(raw, grams, at) * _C[0]
        x += _words(raw, grams, at + 8) * _C[1]
        x += _words(raw, grams, at + 16) * _C[2]
        x = _mix(x)
        span = 1
        while 2 * span <= LENGTH - GRAM + 1:
            x = np.minimum(x[:-span], x[span:])
            span *= 2
        rest = LENGTH - GRAM + 1 - span
        least = np.minimum(x[:n], x[rest:rest + n])
        change = np.append(0, np.flatnonzero(least[1:] != least[:-1]) + 1)
        starts.append(change + at)
        counts.append(np.diff(np.append(change, n)))
        values.append(least[change])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(counts), np.concatenate(values)


def _digest(text: bytes) -> int:
    """As Spark's xxhash64 has it."""
    value = xxhash.xxh64_intdigest(text, 42)
    return value - (1 << 64) if value >= 1 << 63 else value


def _bucket(ids: np.ndarray, digests: np.ndarray, buckets: int) -> np.ndarray:
    mixed = _mix(ids.astype(np.uint64) * _C[0] + digests.astype(np.uint64))
    return ((mixed >> np.uint64(8)) % np.uint64(buckets)).astype(np.int64)


def _texts(batches: Iterator[pa.RecordBatch], slice_bytes: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(ids, texts) of slices of some `slice_bytes`."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column("id").to_pylist(), batch.column("bytes").to_pylist()):
            if held and held + len(text) > slice_bytes:
                yield np.array(ids, np.int64), texts
                ids, texts, held = [], [], 0
            ids.append(doc)
            texts.append(text)
            held += len(text)
    if ids:
        yield np.array(ids, np.int64), texts


def _pack(*arrays: np.ndarray) -> bytes:
    body = b"".join(np.int64(len(x.tobytes())).tobytes() + x.tobytes() for x in arrays)
    return zstandard.ZstdCompressor(level=3).compress(body)


def _unpack(blob: bytes, *types: str) -> list[np.ndarray]:
    body, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for kind in types:
        size = int(np.frombuffer(body, np.int64, 1, at)[0])
        out.append(np.frombuffer(body, kind, size // np.dtype(kind).itemsize, at + 8))
        at += 8 + size
    return out


def _runs(sorted_: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    if not len(sorted_):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1, [len(sorted_)]))


def _by(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(key, places) for each distinct key."""
    order = np.argsort(keys, kind="stable")
    bounds = _runs(keys[order])
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield int(keys[order[a]]), order[a:b]


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    keys, kinds, blobs = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(kinds, pa.int64()), pa.array(blobs, pa.binary())],
        ["key", "kind", "blob"],
    )


_ROW = "key bigint, kind bigint, blob binary"
# Kinds of blobs.
TEXTS, ASKED, KNOWN, HOT, WANTED, COPIES, STRETCHES, SPANS = range(8)
# Id, digest and entries of each text, and its remainders; shared remainders and how many texts
# have each; the slice.
_ASKED = ("<i8", "<i8", "<i8", "<u4", "<u4", "<i8", "<i8")
_KNOWN = ("<i8", "<i8", "<u8")  # id, digest, name
_WANTED = ("<i8", "<i8", "<u8", "u1")  # id, digest, name, whether very many have it
_STRETCHES = ("<i8", "<i8", "<i8", "<i8", "<u4", "u1")  # id, digest, start, size, mark; bytes
_SPANS = ("<i8", "<i8", "<i8", "<i8")  # id, digest, start, end


def _names(hashes: np.ndarray, shares: int) -> np.ndarray:
    """Share and remainder of each minimizer; the share's task needs the remainder alone."""
    share = (hashes >> np.uint64(40)) % np.uint64(shares)
    return (share << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def _count_minimizers(shares: int, slice_bytes: int):
    """Per slice: a row for each share of the minimizers, with one entry for each minimizer.

    One that two texts of the slice have is known to be shared: these texts are put down for
    it here, and only their number is sent on to tell other slices.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _texts(batches, slice_bytes):
            digests = np.array([_digest(x) for x in texts], np.int64)
            first: dict[int, int] = {}  # of copies within the slice only the least id can go on
            for at in np.argsort(ids, kind="stable").tolist():
                first.setdefault(int(digests[at]), at)
            each = [(at, np.unique(_names(minimizers(texts[at])[2], shares))) for at in first.values()]
            names = np.concatenate([x for _, x in each])
            owner = np.repeat(np.array([at for at, _ in each]), [len(x) for _, x in each])
            order = np.argsort(names, kind="stable")
            bounds = _runs(names[order])
            sizes = np.diff(bounds)
            several = np.zeros(len(names), dtype=bool)
            several[order[np.repeat(sizes > 1, sizes)]] = True
            slice_ = np.array([_digest(ids.tobytes() + digests.tobytes()) >> 1 & _LAST], np.int64)
            # Entries stay in order of their text, which is then named once.
            alone = np.flatnonzero(~several)
            shared = names[order[bounds[:-1]]][sizes > 1]
            of_alone = dict(_by((names[alone] >> np.uint64(32)).astype(np.int64)))
            of_shared = dict(_by((shared >> np.uint64(32)).astype(np.int64)))
            none, rows = np.zeros(0, np.int64), []
            for key in of_alone.keys() | of_shared.keys():
                at, both = alone[of_alone.get(key, none)], of_shared.get(key, none)
                ends = _runs(owner[at])
                who = owner[at][ends[:-1]]
                rows.append((key, ASKED, _pack(
                    ids[who], digests[who], np.diff(ends), names[at].astype("<u4"),
                    shared[both].astype("<u4"), sizes[sizes > 1][both], slice_,
                )))
            if len(shared):
                who = owner[several]
                rows.append((-1 - int(slice_[0]), KNOWN, _pack(ids[who], digests[who], names[several])))
            yield _rows(rows)

    return run


def _find_shared(buckets: int, most: int):
    """Of a share of the minimizers: which texts want them, by the bucket of the text; and to
    slices with several texts that have one, whether very many have it."""

    def run(table: pa.Table) -> pa.Table:
        rows, texts, entries, both = [], [], [], []
        for key, kind, blob in zip(*(table.column(c).to_pylist() for c in ("key", "kind", "blob"))):
            if kind == KNOWN:
                rows.append((key, kind, blob))
                continue
            share = key
            ids, digests, counts, rest, shared, sizes, slice_ = _unpack(blob, *_ASKED)
            texts.append((ids, digests, counts))
            entries.append(rest)
            both.append((shared, sizes, np.repeat(slice_, len(shared))))
        if entries:
            ids, digests, counts = map(np.concatenate, zip(*texts))
            shared, of_slice, slices = map(np.concatenate, zip(*both))
            owner = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
            # First what single texts have, then what slices know to be shared.
            rest = np.concatenate([*entries, shared])
            del texts, entries, both
            order = np.argsort(rest, kind="stable")
            bounds = _runs(rest[order])
            runs = np.diff(bounds)
            single = order < len(owner)
            times = np.ones(len(rest), np.int64)
            times[len(owner):] = of_slice
            total = np.add.reduceat(times[order], bounds[:-1])
            digest = np.zeros(len(rest), np.int64)
            digest[single] = digests[owner[order[single]]]
            differs = single & (digest != np.repeat(digest[bounds[:-1]], runs))
            found = np.add.reduceat(differs | ~single, bounds[:-1]) > 0
            many = np.repeat(total > most, runs)
            names = rest[order].astype("<u8") | np.uint64(share << 32)
            pick = np.flatnonzero(np.repeat(found, runs) & single)
            pick = pick[np.argsort(order[pick], kind="stable")]
            who = owner[order[pick]]
            for key, at in _by(_bucket(ids[who], digests[who], buckets)):
                rows.append((key, WANTED, _pack(
                    ids[who[at]], digests[who[at]], names[pick[at]], many[pick[at]].astype("u1")
                )))
            pick = np.flatnonzero(many & ~single)
            for key, at in _by(slices[order[pick] - len(owner)]):
                rows.append((-1 - key, HOT, _pack(names[pick[at]])))
        return pa.Table.from_batches([_rows(rows)])

    return run


def _put_down(buckets: int):
    """Of a slice: what its texts want of the minimizers that several of them have."""

    def run(table: pa.Table) -> pa.Table:
        known, hot = [], [np.zeros(0, np.uint64)]
        for kind, blob in zip(table.column("kind").to_pylist(), table.column("blob").to_pylist()):
            if kind == KNOWN:
                known.append(_unpack(blob, *_KNOWN))
            else:
                hot += _unpack(blob, "<u8")
        ids, digests, names = map(np.concatenate, zip(*known))
        many = np.isin(names, np.concatenate(hot)).astype("u1")
        return pa.Table.from_batches([_rows([
            (key, WANTED, _pack(ids[at], digests[at], names[at], many[at]))
            for key, at in _by(_bucket(ids, digests, buckets))
        ])])

    return run


def _pack_texts(buckets: int, slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _texts(batches, slice_bytes):
            # A row repeated in the slice is sent once, with how often it is there.
            times: dict[tuple[int, int], int] = {}
            first: dict[tuple[int, int], int] = {}
            for at, row in enumerate(zip(ids.tolist(), map(_digest, texts))):
                first.setdefault(row, at)
                times[row] = times.get(row, 0) + 1
            own, digests = (np.array(x, np.int64) for x in zip(*first))
            count, place = np.array([*times.values()]), np.array([*first.values()])
            rows = []
            for key, at in _by(_bucket(own, digests, buckets)):
                some = [texts[i] for i in place[at]]
                sizes = np.array([len(text) for text in some], np.int64)
                rows.append((key, TEXTS, _pack(
                    own[at], digests[at], count[at], sizes, np.frombuffer(b"".join(some), np.uint8)
                )))
            yield _rows(rows)

    return run


def _bucket_texts(table: pa.Table) -> Iterator[tuple[int, int, int, bytes]]:
    """(id, digest, rows, text) of the texts of a bucket."""
    for blob in table.column("blob").to_pylist():
        *columns, sizes, body = _unpack(blob, "<i8", "<i8", "<i8", "<i8", "u1")
        body, ends = body.tobytes(), np.cumsum(sizes)
        for row in zip(*(x.tolist() for x in (*columns, ends, sizes))):
            doc, digest, times, end, size = row
            yield doc, digest, times, body[end - size:end]


def _gather(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of `raw`, one after the other."""
    return raw[np.repeat(starts, sizes) + _counted(sizes)]


def _counted(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each size, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def _equal_groups(body: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A number for each stretch, the same for those with the same bytes."""
    raw, known, out, at = body.tobytes(), {}, np.empty(len(sizes), np.int64), 0
    for row, size in enumerate(sizes.tolist()):
        out[row] = known.setdefault(raw[at:at + size], len(known))
        at += size
    return out


def _least_by(groups: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row the least id of its group."""
    least = np.full(int(groups.max()) + 1 if len(groups) else 0, _LAST, np.int64)
    np.minimum.at(least, groups, ids)
    return least[groups]


def _span_rows(ids, digests, starts, ends, buckets: int) -> list[tuple[int, int, bytes]]:
    return [
        (key, SPANS, _pack(ids[at], digests[at], starts[at], ends[at]))
        for key, at in _by(_bucket(ids, digests, buckets))
    ]


def _stretches(shares: int, buckets: int):
    """Of a bucket: the wanted stretches of its texts, by the task of their minimizer.

    Of equal stretches only those of the least id go on; the others have an earlier copy.
    """

    def run(texts: pa.Table, asked: pa.Table) -> pa.Table:
        wanted, copies = [], set()
        for kind, blob in zip(asked.column("kind").to_pylist(), asked.column("blob").to_pylist()):
            if kind == WANTED:
                wanted.append(_unpack(blob, *_WANTED))
            else:
                ids, digests = _unpack(blob, "<i8", "<i8")
                copies.update(zip(ids.tolist(), digests.tolist()))
        by_text: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        if wanted:
            ids, digests, names, many = map(np.concatenate, zip(*wanted))
            order = np.lexsort((names, digests, ids))
            ids, digests, names, many = ids[order], digests[order], names[order], many[order]
            new = np.flatnonzero((ids[1:] != ids[:-1]) | (digests[1:] != digests[:-1])) + 1
            bounds = [0, *new.tolist(), len(ids)]
            for a, b in zip(bounds[:-1], bounds[1:]):
                by_text[int(ids[a]), int(digests[a])] = names[a:b], many[a:b].astype(bool)
        parts = []
        for doc, digest, _, text in _bucket_texts(texts):
            want = by_text.pop((doc, digest), None) if (doc, digest) not in copies else None
            if want is None:
                continue
            starts, counts, hashes = minimizers(text)
            own = _names(hashes, shares)
            at = np.minimum(np.searchsorted(want[0], own), len(want[0]) - 1)
            chosen = want[0][at] == own
            single = chosen & want[1][at]
            whole = chosen & ~single
            raw = np.frombuffer(text, np.uint8)
            s, n, h = starts[whole], counts[whole] + LENGTH - 1, hashes[whole]
            if single.any():
                one = np.repeat(starts[single], counts[single]) + _counted(counts[single])
                value = np.zeros(len(one), np.uint64)
                for i, offset in enumerate((*range(0, LENGTH - 8, 8), LENGTH - 8)):
                    value = _mix(value * _C[i % 3] + _words(raw, len(raw) - LENGTH + 1, offset)[one])
                s, h = np.concatenate([s, one]), np.concatenate([h, value])
                n = np.concatenate([n, np.full(len(one), LENGTH)])
            parts.append((
                np.full(len(s), doc), np.full(len(s), digest), s, n, h, _gather(raw, s, n)
            ))
        if not parts:
            return pa.Table.from_batches([_rows([])])
        ids, digests, starts, sizes, hashes, body = map(np.concatenate, zip(*parts))
        del parts
        later = ids > _least_by(_equal_groups(body, sizes), ids)
        rows = _span_rows(ids[later], digests[later], starts[later], starts[later] + sizes[later], buckets)
        begins = np.cumsum(sizes) - sizes
        go = np.flatnonzero(~later)
        share = ((hashes[go] >> np.uint64(20)) % np.uint64(shares)).astype(np.int64)
        for key, at in _by(share):
            at = go[at]
            rows.append((key, STRETCHES, _pack(
                ids[at], digests[at], starts[at], sizes[at], hashes[at].astype("<u4"),
                _gather(body, begins[at], sizes[at]),
            )))
        return pa.Table.from_batches([_rows(rows)])

    return run


def suffix_order(body: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`places` in order of the text that begins there, and for each how many bytes it has in
    common with the one before it, both up to `DEPTH` bytes; equal ones stay in the order given.

    Ranks of prefixes are doubled: 8 bytes are one number, then 16, 32 and `DEPTH`. The ranks of
    each size then say how far two neighbours agree, and the last 8 bytes where they part.
    """
    padded = np.concatenate([body, np.zeros(2 * DEPTH, np.uint8)])
    first = _words(padded, len(body) + DEPTH, 0).byteswap()
    ranks = {8: np.unique(first, return_inverse=True)[1].astype(np.int64)}
    step = 8
    while 2 * step < DEPTH:
        rank = ranks[step]
        pair = rank[:-step] * len(padded) + rank[step:]
        ranks[2 * step] = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        step *= 2
    last = ranks[step][places] * len(padded) + ranks[step][places + step]
    order = np.argsort(last, kind="stable")
    a, b = places[order[:-1]], places[order[1:]]
    same = np.zeros(len(a), np.int64)
    # Those that agree in `step` bytes are compared after them; each size is tried twice at the
    # top, as `DEPTH` is two of the largest.
    for size in (step, *sorted(ranks, reverse=True)):
        same += np.where(ranks[size][a + same] == ranks[size][b + same], size, 0)
    parted = np.minimum(same, DEPTH - 8)
    differ = first[a + parted] ^ first[b + parted]
    # Of 8 bytes as one number the first that differs is the highest.
    inner = np.zeros(len(a), np.int64)
    for byte in range(8):
        inner += (inner == byte) & (differ >> np.uint64(56 - 8 * byte) & np.uint64(255) == 0)
    common = np.zeros(len(order), np.int64)
    common[1:] = np.minimum(parted + inner, DEPTH)
    return order, common


def nearest_smaller(ids: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place in suffix order the nearest one before it with a smaller id, or -1, and how
    many bytes the two have in common.

    Each place points to the one before it, and on from there as long as the id is no smaller;
    all do so at once, and where a place points is as far as it has looked.
    """
    before = np.arange(len(ids)) - 1
    shared = common.copy()
    look = np.flatnonzero(before >= 0)
    while len(look):
        look = look[ids[before[look]] >= ids[look]]
        there = before[look]
        shared[look] = np.minimum(shared[look], shared[there])
        before[look] = before[there]
        look = look[before[look] >= 0]
    shared[before < 0] = 0
    return before, shared


def longest_previous_factor(order: np.ndarray, common: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each place the most bytes, up to `DEPTH`, that it has in common with a place of a
    smaller id.

    In suffix order, the nearest smaller position on either side has most in common with it.
    """
    own = ids[order]
    _, left = nearest_smaller(own, common)
    # From behind, what a place has in common with the next one stands at the next one.
    behind = np.append(common[1:], 0)[::-1]
    _, right = nearest_smaller(own[::-1], behind)
    out = np.zeros(len(order), np.int64)
    out[order] = np.maximum(left, right[::-1])
    return out


def _match(buckets: int):
    """Of a share of the minimizers: the spans of strings that an earlier document has."""

    def run(table: pa.Table) -> pa.Table:
        rows, parts = [], []
        for key, kind, blob in zip(*(table.column(c).to_pylist() for c in ("key", "kind", "blob"))):
            if kind == STRETCHES:
                parts.append(_unpack(blob, *_STRETCHES))
            else:
                rows.append((key, kind, blob))
        if not parts:
            return pa.Table.from_batches([_rows(rows)])
        ids, digests, starts, sizes, marks, body = map(np.concatenate, zip(*parts))
        del parts
        groups = _equal_groups(body, sizes)
        later = ids > _least_by(groups, ids)
        rows += _span_rows(ids[later], digests[later], starts[later], starts[later] + sizes[later], buckets)
        # Left are the first of each kind; a minimizer with one kind of stretch has no more to find.
        left = np.flatnonzero(~later)
        marks = marks.astype(np.int64)
        kinds = np.unique(np.stack([marks[left], groups[left]]), axis=1)
        value, times = np.unique(kinds[0], return_counts=True)
        left = left[np.isin(marks[left], value[times > 1])]
        left = left[np.argsort(marks[left], kind="stable")]
        begins = np.cumsum(sizes) - sizes
        # A suffix array for each few megabytes; the stretches of one minimizer stay together.
        bounds = _runs(marks[left])
        weight = np.append(0, np.cumsum(sizes[left]))[bounds]
        piece = np.repeat(weight[:-1] // ARRAY_BYTES, np.diff(bounds))
        for _, at in _by(piece):
            some = left[at][np.argsort(ids[left[at]], kind="stable")]
            n = sizes[some]
            strings = n - LENGTH + 1
            inner = _counted(strings)
            places = np.repeat(np.cumsum(n) - n, strings) + inner
            owner = np.repeat(some, strings)
            order, common = suffix_order(_gather(body, begins[some], n), places)
            again = longest_previous_factor(order, common, ids[owner]) >= LENGTH
            owner, begin = owner[again], (starts[owner] + inner)[again]
            if len(owner):
                new = np.append(True, (owner[1:] != owner[:-1]) | (begin[1:] != begin[:-1] + 1))
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(owner)) - 1
                rows += _span_rows(
                    ids[owner[first]], digests[owner[first]], begin[first], begin[last] + LENGTH, buckets
                )
        return pa.Table.from_batches([_rows(rows)])

    return run


def _merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs that (start, end) pairs cover; runs that touch are one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(map(tuple, spans.tolist())):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


_RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _cut_out():
    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        spans, copies = [], set()
        for kind, blob in zip(found.column("kind").to_pylist(), found.column("blob").to_pylist()):
            if kind == SPANS:
                spans.append(_unpack(blob, *_SPANS))
            else:
                ids, digests = _unpack(blob, "<i8", "<i8")
                copies.update(zip(ids.tolist(), digests.tolist()))
        by_text: dict[tuple[int, int], np.ndarray] = {}
        if spans:
            ids, digests, starts, ends = map(np.concatenate, zip(*spans))
            order = np.lexsort((digests, ids))
            new = np.flatnonzero(
                (ids[order][1:] != ids[order][:-1]) | (digests[order][1:] != digests[order][:-1])
            ) + 1
            bounds = [0, *new.tolist(), len(order)]
            for a, b in zip(bounds[:-1], bounds[1:]):
                at = order[a:b]
                by_text[int(ids[at[0]]), int(digests[at[0]])] = np.stack([starts[at], ends[at]], 1)
        rows = []
        for doc, digest, times, text in _bucket_texts(texts):
            if (doc, digest) in copies and len(text) >= LENGTH:
                runs = [(0, len(text))]
            else:
                runs = _merged(by_text.get((doc, digest), np.zeros((0, 2), np.int64)))
            kept, at = hashlib.sha256(), 0
            for start, end in runs:
                kept.update(text[at:start])
                at = end
            kept.update(text[at:])
            row = (
                None if doc == _LAST else doc, len(text), sum(e - s for s, e in runs), len(runs),
                kept.hexdigest(),
            )
            rows += [row] * times
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64()] * 4 + [pa.string()]
        names = [part.split()[0] for part in _RESULT.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _copies(whole: DataFrame, buckets: int) -> DataFrame:
    """Texts that a smaller id has as a whole, as blobs by bucket."""
    firsts = stored(
        whole.groupBy("sha").agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .where("first < last").select("sha", "first"), "first-texts",
    )
    copies = whole.join(firsts, "sha").where("id > first").select("id", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests = (batch.column(c).to_numpy() for c in ("id", "digest"))
            yield _rows([
                (key, COPIES, _pack(ids[at], digests[at]))
                for key, at in _by(_bucket(ids, digests, buckets))
            ])

    return copies.mapInArrow(run, _ROW)


def dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *,
    slice_bytes: int = SLICE_BYTES, bucket_bytes: int = BUCKET_BYTES,
    share_bytes: int = SHARE_BYTES, many: int = MANY,
) -> DataFrame:
    """Per row: id, bytes, bytes and maximal runs removed, and the SHA-256 of what is left.

    The sizes bound what a task holds and change no result.
    """
    texts = docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(_LAST)).alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("bytes"),
    )
    whole = stored(
        texts.select("id", F.octet_length("bytes").alias("n"), F.sha2("bytes", 256).alias("sha"),
                     F.xxhash64("bytes").alias("digest")), "whole-texts",
    )
    total = whole.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shares, buckets = total // share_bytes + 1, total // bucket_bytes + 1

    copies = stored(_copies(whole, buckets), "copies")
    counted = texts.mapInArrow(_count_minimizers(shares, slice_bytes), _ROW)
    found = stored(
        dealt(counted, total, "key").groupBy("key").applyInArrow(_find_shared(buckets, many), _ROW),
        "minimizers",
    )
    of_slices = dealt(found.where(F.col("kind").isin(KNOWN, HOT)), total, "key").groupBy("key")
    wanted = found.where(F.col("kind") == WANTED).unionByName(
        of_slices.applyInArrow(_put_down(buckets), _ROW)
    )
    packed = dealt(texts.mapInArrow(_pack_texts(buckets, slice_bytes), _ROW), total, "key")
    asked = dealt(wanted.unionByName(copies), total, "key")
    sent = (
        packed.groupBy("key").cogroup(asked.groupBy("key"))
        .applyInArrow(_stretches(shares, buckets), _ROW)
    )
    # A share of stretches and a bucket of spans may have the same number.
    share = F.when(F.col("kind") == STRETCHES, F.col("key")).otherwise(-1 - F.col("key"))
    spans = stored(
        dealt(sent.withColumn("share", share), total, "share").groupBy("share")
        .applyInArrow(_match_share(buckets), _ROW), "spans",
    )
    to_cut = dealt(spans.unionByName(copies), total, "key")
    return (
        packed.groupBy("key").cogroup(to_cut.groupBy("key"))
        .applyInArrow(_cut_out(), _RESULT).withColumnRenamed("doc_id", id_column)
    )


def _match_share(buckets: int):
    match = _match(buckets)
    return lambda table: match(table.drop_columns("share"))
