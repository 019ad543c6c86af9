from __future__ import annotations

import hashlib
import json
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_samples import docs, odd_texts
from tallyhouse.llm import queries
from tallyhouse.llm import token_alignment as ta

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@lru_cache
def byte_side():
    """The library, and its entries as bytes: each sign of an entry stands for one byte."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in shown]
    signs = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(hidden)}
    with open(path, encoding="utf-8") as file:
        entries = json.load(file)["model"]["vocab"]
    special = {"<|endoftext|>"}
    return tokenizer, {i: bytes(signs[c] for c in t) for t, i in entries.items() if t not in special}


@lru_cache
def piece_side():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def piece_bytes(i):
    piece = piece_side().id_to_piece(i)
    if piece.startswith("<0x") and len(piece) == 6:
        return bytes.fromhex(piece[3:5])
    return piece.replace("▁", " ").encode()


def spans(ids, size_of):
    out, at = [], 0
    for i in ids:
        out.append((at, at + size_of(i)))
        at += size_of(i)
    return out


def plain_document(text):
    """(a ids, b ids, links as id pairs, groups as text)."""
    if not text:
        return [], [], [], ""
    tokenizer, entries = byte_side()
    a = tokenizer.encode(" " + text, add_special_tokens=False).ids
    b = piece_side().encode(text)
    whole = (" " + text).encode()
    if b"".join(entries[i] for i in a) != whole or b"".join(map(piece_bytes, b)) != whole:
        return [], [], [], ""
    at_a, at_b = spans(a, lambda i: len(entries[i])), spans(b, lambda i: len(piece_bytes(i)))
    links, low = [], 0
    for i, (s, e) in zip(a, at_a):
        while at_b[low][1] <= s:
            low += 1
        j = low
        while j < len(b) and at_b[j][0] < e:
            links.append((i, b[j]))
            j += 1
    ends = sorted({e for _, e in at_a} & {e for _, e in at_b})
    groups, i, j = [], 0, 0
    for end in ends:
        ours, theirs = [], []
        while i < len(a) and at_a[i][1] <= end:
            ours.append(str(a[i]))
            i += 1
        while j < len(b) and at_b[j][1] <= end:
            theirs.append(str(b[j]))
            j += 1
        groups.append(",".join(ours) + "|" + ",".join(theirs))
    return a, b, links, ";".join(groups)


def plain_rows(rows):
    done = [(i, *plain_document(text)) for i, text in rows]
    held = Counter(pair for *_, links, _ in done for pair in set(links))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    return Counter(
        (
            doc, len(a), len(b), groups.count(";") + bool(groups), len(links),
            sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links),
            hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for doc, a, b, links, groups in done
    )


@pytest.fixture
def asked(spark, monkeypatch):
    def run(rows, extra=False, **sizes):
        table, real = docs(spark, rows, extra), ta.align_documents
        with monkeypatch.context() as patch:
            patch.setattr(queries, "load", lambda *_: table)
            patch.setattr(ta, "align_documents", lambda d, digest: real(d, digest=digest, **sizes))
            found = queries.op12_token_alignment(spark, "").select(COLUMNS).collect()
        return Counter(map(tuple, found))

    return run


ODD = [
    (20, "a <s> </s> <|endoftext|> <0x41> <unk> [INST]"), (21, "▁ x"), (22, " lead and trail "),
    (23, "日本語 😀 é Ａ   x\r\n\ty\x00z"), (24, "   "), (25, "1234567 foo_bar(baz)"),
    (26, "a▁b"), (27, "<unk>"), (28, "� ퟿"),
]


def test_documents_are_those_of_the_plain_version(asked):
    rows = odd_texts() + ODD
    assert asked(rows) == plain_rows(rows)


def test_small_lots_runs_and_clashing_columns(asked):
    rows = odd_texts(5) + ODD
    assert asked(rows, extra=True, run_bytes=64, lot_bytes=200) == plain_rows(rows)


def test_no_rows_and_none_with_tokens(asked):
    assert not asked([])
    rows = [(1, None), (2, ""), (None, None)]
    assert asked(rows) == plain_rows(rows)


def test_counts_go_over_all_lots(asked):
    rows = [(i, text) for i, text in enumerate(["Hello there", "there Hello", "Hello Hello"] * 12)]
    found = asked(rows, run_bytes=1, lot_bytes=1)
    assert found == plain_rows(rows)
    assert all(row[6] >= row[4] * 12 for row in found)


def test_groups_themselves(spark):
    rows = docs(spark, [(1, "Hello, wörld"), (2, None)])
    found = {r["doc_id"]: r["groups"] for r in ta.align_documents(rows).collect()}
    assert found == {1: plain_document("Hello, wörld")[3], 2: ""}


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60), st.integers(1, 40))
def test_runs_change_nothing(text, most):
    kept, a, b = ta.encode([text, None, text + "é"], ta.VOCABULARY, ta.PIECES)
    one, many = ta.align(a, b), ta.align(a, b, most)
    sides = ta._sides(ta.VOCABULARY, ta.PIECES)
    for found in (one, many):
        texts = ta.written(a, b, found, sides, len(kept)) if kept else []
        assert [x.decode() for x in texts] == [
            groups for groups in (plain_document(t)[3] for t in (text, text + "é")) if groups
        ]
    assert sorted(zip(one.ours, one.theirs)) == sorted(zip(many.ours, many.theirs))
    if kept:
        pairs = Counter(zip(a.ids[one.ours].tolist(), b.ids[one.theirs].tolist()))
        assert pairs == Counter(plain_document(text)[2]) + Counter(plain_document(text + "é")[2])


def test_long_run_of_one_sign(asked):
    rows = [(1, "x" * 300_000), (2, " " * 800_000), (3, "\n" * 800_000 + "a")]
    assert asked(rows, run_bytes=10_000) == plain_rows(rows)


def test_numbers_come_back():
    for numbers in ([], [0], [0, 0, 5, 70_000, 4_000_000_000]):
        assert ta._numbers(ta._small(np.array(numbers, np.int64))).tolist() == numbers
