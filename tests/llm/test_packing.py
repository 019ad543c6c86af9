from __future__ import annotations

import random
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_samples import docs, odd_texts, words
from tallyhouse.llm import packing


@lru_cache
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def library_ids(texts):
    return [x.ids + [0] for x in library().encode_batch(list(texts), add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_ids_are_those_of_the_tokenizer_library(texts):
    assert [packing.token_ids(x).tolist() for x in texts] == library_ids(texts)


@lru_cache
def library_at_its_defaults():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(
    st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", "<|", " ", "\n", "a", " b"]), st.text(max_size=8)
), max_size=8).map("".join))
def test_special_tokens_have_their_own_ids(text):
    want = library_at_its_defaults().encode(text, add_special_tokens=False).ids
    assert packing.token_ids(text).tolist() == want + [0]


def test_the_end_of_a_text_written_out():
    assert packing.token_ids("a <|endoftext|> b").tolist() == [64, 220, 50256, 275, 0]


def test_white_space_of_any_length_has_the_ids_of_the_library():
    run = 10_000_000
    for text in (" " * run, "\n" * run, "\t" * run, "a" + " \n" * 400_000 + " b<|endoftext|>" + " " * 800_000):
        want = library_at_its_defaults().encode(text, add_special_tokens=False).ids
        assert packing.token_ids(text).tolist() == want + [0]


def check(rows, texts, window=packing.WINDOW):
    """Every id in exactly one piece, and windows without gap or excess."""
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row["doc_id"]].append(row)
        by_window[row["sequence_id"]].append(row)
    for doc, ids in texts.items():
        own = sorted(by_doc.pop(doc), key=lambda r: r["start"])
        at = 0
        for row in own:
            part = np.array(ids[row["start"]:row["start"] + row["length"]], "<u4")
            assert row["start"] == at and row["doc_tokens"] == len(ids) and len(part) == row["length"]
            assert row["ids_crc32"] == zlib.crc32(part.tobytes())
            at += row["length"]
        assert at == len(ids)
    assert not by_doc
    for own in by_window.values():
        at = 0
        for row in sorted(own, key=lambda r: r["offset"]):
            assert row["offset"] == at
            at += row["length"]
        assert at <= window
        padded = at if at & (at - 1) == 0 else window
        assert {row["padded_length"] for row in own} == {padded}
    return by_window


def test_pieces_hold_all_ids_and_windows_fit(spark):
    draw = random.Random(8)
    texts = {i: words(draw, draw.choice([0, 3, 40, 300, 900, 4000])) for i in range(120)}
    rows = packing.pack(docs(spark, texts.items())).collect()
    windows = check(rows, dict(zip(texts, library_ids(texts.values()))))
    tokens = sum(row["length"] for row in rows)
    assert len(windows) <= -(-tokens // packing.WINDOW) + 1


def test_several_bins(spark):
    draw = random.Random(9)
    texts = {i: words(draw, draw.randint(1, 400)) for i in range(200)}
    rows = packing.pack(docs(spark, texts.items()), bin_pieces=50).collect()
    check(rows, dict(zip(texts, library_ids(texts.values()))))


def test_odd_rows(spark):
    texts = [(n, t) for n, (_, t) in enumerate(odd_texts())]
    rows = packing.pack(docs(spark, texts, extra=True)).collect()
    check(rows, {n: ids for (n, _), ids in zip(texts, library_ids(t or "" for _, t in texts))})


def test_repeated_rows_and_null_ids_keep_their_pieces(spark):
    rows = packing.pack(docs(spark, [(1, "a"), (1, "a"), (None, "b")])).collect()
    assert sorted((str(r["doc_id"]), r["length"]) for r in rows) == [("1", 2), ("1", 2), ("None", 2)]
    assert sorted(r["offset"] for r in rows) == [0, 2, 4]


def test_no_rows(spark):
    assert packing.pack(docs(spark, [])).collect() == []


@given(st.lists(st.integers(1, 64), max_size=200))
def test_the_tightest_window_is_taken(lengths):
    lengths = sorted(lengths, reverse=True)
    numbers, offsets = packing.best_fit(lengths, 64)
    used: list[int] = []
    for length, number, offset in zip(lengths, numbers, offsets):
        fitting = [u for u in used if u + length <= 64]
        assert offset == (max(fitting) if fitting else 0)
        if fitting:
            assert used[number] == offset
            used[number] += length
        else:
            assert number == len(used)
            used.append(length)
