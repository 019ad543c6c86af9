from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_samples import CLASHING, words
from tallyhouse.llm import chat_format as cf
from tallyhouse.llm import queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SAID = "</s>[INST] ok [/INST]"
# What a text can hold to look like the template.
HOSTILE = [*cf.CONTROLS, "<\\s>", "<\\\\/s>", "[\\INST]", "[\\\\/ROLE]", "<", "[", "\\", "s>", "/s>",
           "INST]", "<|endoftext|>", "<\\", "[[INST]]", "<<s>>"]
hostile = st.lists(st.one_of(st.sampled_from(HOSTILE), st.text(max_size=4)), max_size=8).map("".join)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """Digests of all conversations, taken from the rows alone; `formatted_chars` apart."""
    by_conv = defaultdict(list)
    for conv, turn, role, text in [*rows, (-7, 0, "user", SAID), (-7, 1, "assistant", SAID)]:
        by_conv[conv].append((turn is not None, turn or 0, role is not None, role or "", text or ""))
    found = Counter()
    for conv, turns in by_conv.items():
        turns.sort()
        said = "".join(text for *_, role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        found[conv, len(turns), sha(whole), len(said), sha(said)] += 1
    return found


def rows_of(seed, n):
    draw = random.Random(seed)
    rows = []
    for conv in [*range(n), None, 10**12]:
        for turn in range(draw.randint(1, 9)):
            role = draw.choice(["system", "user", "assistant", "assistant", "tool", "[/ROLE]x", "", None])
            text = draw.choice([None, "", words(draw, 9), "".join(draw.choices(HOSTILE, k=5)), "é😀 日本\n"])
            rows.append((conv, turn, role, text))
    draw.shuffle(rows)
    return rows


@pytest.fixture
def asked(spark, monkeypatch):
    def run(rows, extra=False, **sizes):
        schema, held = SCHEMA, rows
        if extra:
            names = [*CLASHING, "conv", "copy", "part", "piece", "ids", "loss", "starts", "whole"]
            held, schema = [(*row, *range(len(names))) for row in rows], SCHEMA + "".join(f", {n} int" for n in names)
        table, real = spark.createDataFrame(held, schema), cf.format_conversations
        with monkeypatch.context() as patch:
            patch.setattr(queries, "load", lambda *_: table)
            patch.setattr(cf, "format_conversations", lambda r: real(r, **sizes))
            found = queries.op11_chat_format(spark, "")
            assert found.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            rows = [tuple(row) for row in found.collect()]
        assert all(row[5] >= row[3] for row in rows)
        return Counter(row[:5] for row in rows)

    return run


@pytest.mark.parametrize(("n", "sizes"), [
    (40, {}), (30, {"range_turns": 3}), (25, {"range_turns": 10, "piece_chars": 1}),
    (25, {"range_turns": 10**6, "piece_chars": 20}),
])
def test_conversations_are_read_back_as_they_were(asked, n, sizes):
    rows = rows_of(n, n)
    assert asked(rows, extra=n == 30, **sizes) == plain(rows)


def test_one_hot_conversation_with_copies_and_a_very_long_text(asked):
    draw = random.Random(2)
    rows = [(1, turn, draw.choice(["user", "assistant"]), words(draw, 5)) for turn in range(400)]
    rows += [(1, 7_000, "assistant", "same")] * 200 + [(2, 0, "user", words(draw, 40_000) + " " * 800_000)]
    rows += [(2, 1, "assistant", "<s>" * 20_000), (2, None, "user", "first")]
    assert asked(rows, range_turns=50, piece_chars=300) == plain(rows)


def test_only_the_planted_conversation(asked):
    found = asked([])
    assert found == plain([])
    assert next(iter(found))[3] == len(SAID)


@settings(max_examples=500, deadline=None)
@given(hostile)
def test_escaping_hides_every_control_string_and_is_undone(text):
    hidden = cf.escape(text)
    assert not any(name in hidden for name in cf.CONTROLS)
    assert cf.unescape(hidden) == text


@lru_cache
def library():
    import public_tokenizers
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = False
    tokenizer.add_tokens([AddedToken(x, normalized=False) for x in cf.CONTROLS])
    return tokenizer


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "<s>"]), hostile), max_size=6))
def test_ids_spans_and_mask_of_a_conversation(turns):
    text, spans = cf.render(turns)
    ids, starts, ends = cf.encode_with_spans(text, cf.VOCABULARY)
    if "<|endoftext|>" not in text:
        whole = library().encode(text, add_special_tokens=False)
        assert ids.tolist() == whole.ids
    # Spans follow each other without gap, but for bytes of one character.
    assert not len(ids) or (starts[0] == 0 and ends[-1] == len(text))
    assert (starts[1:] <= ends[:-1]).all() and (ends[:-1] - starts[1:] <= 1).all()
    for i, s, e in zip(ids.tolist(), starts, ends):
        if i >= 50_257:
            assert cf.control_ids(cf.VOCABULARY)[text[s:e]] == i
    mask = cf.under(spans, starts, ends)
    inside = np.zeros(len(text) + 1, bool)
    for low, high in spans:
        inside[low:high] = True
    assert [bool(inside[s:e].any()) for s, e in zip(starts, ends)] == mask.tolist()
    assert all(inside[s:e].all() for s, e in zip(starts[mask], ends[mask]))
    said = [text for role, text in turns if role == "assistant" and text]
    assert list(cf.learned(text, mask, starts, ends)) == said
    marks = [(text[s:e], s, e) for i, s, e in zip(ids, starts, ends) if i >= 50_257]
    assert list(cf.turns_of(text, marks)) == turns


def test_pieces_are_the_conversations(spark):
    rows = rows_of(4, 12)
    found = cf.format_conversations(spark.createDataFrame(rows, SCHEMA), range_turns=20, piece_chars=30).collect()
    by_conv = defaultdict(list)
    for row in sorted(found, key=lambda r: (r["part"], r["piece"])):
        by_conv[row["conv_id"]].append(row)
        assert len(row["ids"]) == len(row["starts"]) == len(row["ends"]) == len(row["loss"])
    assert any(len(pieces) > 1 for pieces in by_conv.values())
    assert set(by_conv) == {row[0] for row in rows}
    for conv, pieces in by_conv.items():
        turns = sorted((t, r is not None, r or "", x or "") for c, t, r, x in rows if c == conv)
        assert "".join(p["formatted"] for p in pieces) == cf.render((r, x) for _, _, r, x in turns)[0]
