"""Conversations as one text and its token ids, with the tokens to learn from marked.

A template puts a control string before and after each turn. A conversation is rendered
as a whole and encoded once; the ids' lengths in bytes give each token its span in
characters. The spans of the assistant's texts and those of the tokens are both in
order, so two binary searches per text find its tokens. Control strings have ids of
their own and part what stands beside them, so a text's span is a span of whole tokens.

A control string inside a text gets a backslash after its first sign, and one that looks
so already gets one more; reading back takes one away. No control string has its first
sign anywhere else, so none can form where a text and a mark meet.

Turns are dealt into ranges of conversation and turn, and each range is formatted in one
pass, a conversation at a time and a long one in pieces of whole turns. So a conversation
of any length fills several tasks. Reading back digests the conversations that lie in one
piece within a range where they are; the pieces of others, some two a range and those of
long ones, meet in order and are digested piece by piece, without being joined.

Null texts and roles are empty. Rows of one turn come in order of role, then of a hash of
the text, copies included; a null turn comes first, and rows without conversation are one
conversation. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.byte_bpe import VOCABULARY, Encoder, special_tokens, token_bytes
from tallyhouse.llm.common import BATCH_BYTES, slices

# The template. A role's marks, and those around the name of any other role.
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER_ROLE = ("[ROLE]", "[/ROLE]")
OTHER_END = "</s>"
LEARNED = "assistant"

CONTROLS = tuple(dict.fromkeys([*(mark for pair in MARKS.values() for mark in pair), *OTHER_ROLE, OTHER_END]))
_OPENS = {opened: role for role, (opened, _) in MARKS.items()}

# Turns in one range, or so, and characters of a conversation in one piece.
RANGE_TURNS = 16_384
PIECE_CHARS = 1024 * 1024


# ---- template ---------------------------------------------------------------------


def _within(times: str) -> re.Pattern:
    """The first sign of a control string and backslashes, where the rest of it comes after."""
    rests: dict[str, list[str]] = {}
    for name in CONTROLS:
        rests.setdefault(name[0], []).append(re.escape(name[1:]))
    return re.compile("|".join(
        rf"{re.escape(sign)}\\{times}(?={'|'.join(some)})" for sign, some in rests.items()
    ))


_TO_ESCAPE, _ESCAPED = _within("*"), _within("+")


def escape(text: str) -> str:
    """`text` without control strings; `unescape` gives it back."""
    return _TO_ESCAPE.sub(lambda found: found[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda found: found[0][:-1], text)


def render(turns: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Turns (role, text) as one text, and where in it the texts to learn from stand."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        if role in MARKS:
            before, after = MARKS[role]
        else:
            before, after = f"{OTHER_ROLE[0]}{escape(role)}{OTHER_ROLE[1]}", OTHER_END
        body = escape(text)
        parts += [before, body, after]
        start = at + len(before)
        at = start + len(body) + len(after)
        if role == LEARNED:
            spans.append((start, start + len(body)))
    return "".join(parts), spans


@lru_cache(maxsize=2)
def control_ids(vocabulary: str) -> dict[str, int]:
    """Ids for the control strings, after all that the vocabulary has."""
    first = len(token_bytes(vocabulary))
    return {name: first + i for i, name in enumerate(CONTROLS)}


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> tuple[Encoder, np.ndarray]:
    """Text to ids, and the bytes of each id."""
    sizes = [len(token) for token in token_bytes(vocabulary)]
    for name, i in special_tokens(vocabulary).items():
        sizes[i] = len(name.encode())
    return Encoder(vocabulary, control_ids(vocabulary)), np.array([*sizes, *map(len, CONTROLS)])


def encode_with_spans(text: str, vocabulary: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids with the first character of each and the one after its last.

    A token that has only some bytes of a character has that character in its span.
    """
    encode, sizes = _encoder(vocabulary)
    ids = np.array(encode(text), np.int32)
    ends = np.cumsum(sizes[ids])
    raw = np.frombuffer(text.encode(), np.uint8)
    # Characters that have begun by each byte, that byte included.
    begun = np.cumsum((raw & 0xC0) != 0x80)
    return ids, begun[ends - sizes[ids]] - 1, begun[ends - 1]


def under(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which tokens share a character with a span; spans and tokens are both in order."""
    mask = np.zeros(len(starts), bool)
    lows = np.searchsorted(ends, [low for low, _ in spans], "right")
    highs = np.searchsorted(starts, [high for _, high in spans], "left")
    for low, high in zip(lows, highs):
        mask[low:high] = True
    return mask


# ---- formatting -------------------------------------------------------------------

_FORMATTED = (
    "conv_id bigint, part int, piece bigint, whole boolean, formatted string, ids array<int>, "
    "starts array<int>, ends array<int>, loss array<boolean>"
)


def _pieces(
    batches: Iterator[pa.RecordBatch], most: int
) -> Iterator[tuple[int | None, int, bool, list[tuple[str, str]]]]:
    """(conversation, piece, whether that is all of it, turns) of one range's rows."""
    conv, turns, size, piece = None, [], 0, 0
    # The first and the last conversation of a range may go on in others.
    first = True
    for batch in slices(batches, "text"):
        columns = (batch.column(name).to_pylist() for name in ("conv", "role", "text"))
        for of, role, text in zip(*columns):
            if turns and (of != conv or size >= most):
                yield conv, piece, not first and not piece and of != conv, turns
                piece = piece + 1 if of == conv else 0
                first = first and of == conv
                turns, size = [], 0
            conv = of
            turns.append((role or "", text or ""))
            size += len(text or "") + 1
    if turns:
        yield conv, piece, False, turns


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays), kind))


def format_conversations(
    rows: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn",
    role_column: str = "role", text_column: str = "text", vocabulary: str = VOCABULARY,
    range_turns: int = RANGE_TURNS, piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """Conversations in pieces: `formatted` text, `ids` with their spans, and `loss` for each id.

    A piece's place is its range (`part`) and its number there (`piece`); `whole` says that
    it is all of its conversation, as far as one range can tell.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, size = [], 0

        def batch() -> pa.RecordBatch:
            conv, piece, whole, text, ids, starts, ends, loss = zip(*held)
            return pa.RecordBatch.from_arrays([
                pa.array(conv, pa.int64()), pa.array([part] * len(held), pa.int32()),
                pa.array(piece, pa.int64()), pa.array(whole), pa.array(text, pa.string()),
                *(_lists(column, pa.int32()) for column in (ids, starts, ends)),
                _lists(loss, pa.bool_()),
            ], [field.split()[0] for field in _FORMATTED.split(", ")])

        for conv, piece, whole, turns in _pieces(batches, piece_chars):
            text, spans = render(turns)
            ids, starts, ends = encode_with_spans(text, vocabulary)
            held.append((conv, piece, whole, text, ids, starts, ends, under(spans, starts, ends)))
            size += len(text)
            if size >= BATCH_BYTES // 4:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()

    named = rows.select(
        F.col(f"`{conv_column}`").cast("bigint").alias("conv"),
        F.col(f"`{turn_column}`").cast("bigint").alias("turn"),
        F.col(f"`{role_column}`").alias("role"), F.col(f"`{text_column}`").alias("text"),
    )
    # Copies are told apart by a number, so any number of them can lie in several ranges.
    keys = ("conv", "turn", "role", "hash", "copy")
    marked = named.withColumn("hash", F.xxhash64("text"))
    marked = marked.withColumn("copy", F.monotonically_increasing_id())
    ordered = [F.col(key).asc_nulls_first() for key in keys]
    dealt = marked.repartitionByRange(named.count() // range_turns + 1, *ordered)
    pieces = dealt.sortWithinPartitions(*ordered).select("conv", "role", "text")
    return pieces.mapInArrow(work, _FORMATTED).withColumnRenamed("conv_id", conv_column)


# ---- reading back -----------------------------------------------------------------


def turns_of(text: str, marks: Iterable[tuple[str, int, int]]) -> Iterator[tuple[str, str]]:
    """Turns (role, text) of a formatted text, from its control strings and where they stand."""
    marks = iter(marks)
    for name, _, start in marks:
        if name in _OPENS:
            role = _OPENS[name]
        else:
            _, end, after = next(marks)
            role, start = unescape(text[start:end]), after
        _, end, _ = next(marks)
        yield role, unescape(text[start:end])


def learned(text: str, loss: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[str]:
    """The texts under the mask, one for each run of marked tokens."""
    edges = np.flatnonzero(np.diff(loss.astype(np.int8), prepend=0, append=0))
    for first, last in zip(edges[::2], edges[1::2]):
        yield unescape(text[starts[first]:ends[last - 1]])


_READ = (
    "conv_id bigint, part int, piece bigint, whole boolean, n_turns bigint, turns binary, "
    "loss_chars bigint, loss binary, formatted_chars bigint"
)
_DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)


def digests(
    formatted: DataFrame, conv_column: str = "conv_id", vocabulary: str = VOCABULARY
) -> DataFrame:
    """What can be read back from formatted conversations, a row each.

    `turns_sha256` is over role and text of each turn, each with a line feed after it;
    `loss_sha256` over the texts under the mask and nothing else.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = {i: name for name, i in control_ids(vocabulary).items()}
        least = min(names)
        for batch in batches:
            rows = []
            columns = {name: batch.column(name) for name in batch.schema.names}
            lists = {
                name: (columns[name].offsets.to_numpy(), columns[name].values.to_numpy(zero_copy_only=False))
                for name in ("ids", "starts", "ends", "loss")
            }
            heads = (columns[name].to_pylist() for name in ("conv", "part", "piece", "whole", "formatted"))
            for row, (conv, part, piece, whole, text) in enumerate(zip(*heads)):
                ids, starts, ends, loss = (
                    values[cuts[row]:cuts[row + 1]] for cuts, values in lists.values()
                )
                at = np.flatnonzero(ids >= least)
                marks = zip([names[i] for i in ids[at].tolist()], starts[at].tolist(), ends[at].tolist())
                turns = list(turns_of(text, marks))
                said = "".join(learned(text, loss, starts, ends))
                content = "".join(f"{role}\n{body}\n" for role, body in turns).encode()
                kept = said.encode()
                if whole:
                    content, kept = (hashlib.sha256(x).digest() for x in (content, kept))
                rows.append((
                    conv, part, piece, whole, len(turns), content, len(said), kept, len(text)
                ))
            yield _batch(rows, _READ)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, sums, turns, loss = None, [0, 0, 0], None, None
        for batch in batches:
            rows = []
            columns = (batch.column(field.split()[0]).to_pylist() for field in _READ.split(", "))
            for conv, _, _, whole, n_turns, content, chars, kept, size in zip(*columns):
                if whole:
                    rows.append((conv, n_turns, content.hex(), chars, kept.hex(), size))
                    continue
                if open_ is not None and open_ != (conv,):
                    rows.append((*open_, sums[0], turns.hexdigest(), sums[1], loss.hexdigest(), sums[2]))
                    open_ = None
                if open_ is None:
                    open_, sums = (conv,), [0, 0, 0]
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                turns.update(content)
                loss.update(kept)
                sums = [a + b for a, b in zip(sums, (n_turns, chars, size))]
            if rows:
                yield _batch(rows, _DIGESTS)
        if open_ is not None:
            last = (*open_, sums[0], turns.hexdigest(), sums[1], loss.hexdigest(), sums[2])
            yield _batch([last], _DIGESTS)

    pieces = formatted.withColumnRenamed(conv_column, "conv")
    found = pieces.mapInArrow(read, _READ)
    met = found.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    return met.mapInArrow(finish, _DIGESTS).withColumnRenamed("conv_id", conv_column)


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    columns = [pa.array(column, _ARROW[kind]) for (_, kind), column in zip(fields, zip(*rows))]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])
