from __future__ import annotations

import random
import re
from collections import Counter

from llm_samples import docs, odd_texts, words
from tallyhouse.llm import quality_rules


def brute(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(found[i:i + 3]) for i in range(len(found) - 2)]
    times = Counter(grams)
    held = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(found)
    failed = n < 50 or 100 * len(held) > 50 * n
    return (n, sum(map(len, found)), sum(map(text.count, "#*$%&|<>")),
            len(lines) - len(set(lines)), len(held), failed)


def texts():
    draw = random.Random(2)
    out = odd_texts() + [(20 + i, words(draw, draw.randint(0, 120))) for i in range(30)]
    out += [(60, "a b c " * 40), (61, "a\u00a0b\u2003c \x0b d\x1ce"), (62, "#! | <b> " * 30),
            (63, "the of and " + words(draw, 60) + "\nfoo\nfoo\n \nfoo"), (64, "é " * 70)]
    return out


def test_measures_agree_with_a_plain_count(spark):
    rows = texts()
    got = quality_rules.judge(docs(spark, rows, extra=True)).drop("kept").collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *brute(t)) for i, t in rows)


def test_rules_decide_only_what_passes_the_base(spark):
    draw = random.Random(5)
    clean = " ".join(words(draw, 4) + " the" for _ in range(30))
    rows = [(1, clean), (2, clean.upper()), (3, clean.replace(" ", " ### ")), (4, "the end"),
            (5, clean.replace(" ", "!! "))]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs(spark, rows)).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_a_rule_is_a_row_of_the_table(spark):
    draw = random.Random(6)
    rows = [(1, words(draw, 90))]
    none = quality_rules.judge(docs(spark, rows), rules=[])
    strict = quality_rules.judge(
        docs(spark, rows), rules=[quality_rules.Rule("long words", "word_chars", "n_words", 50, 99)]
    )
    assert [r["kept"] for r in none.collect()] == [True]
    assert [r["kept"] for r in strict.collect()] == [False]


def test_no_user_functions(spark):
    plan = quality_rules.judge(docs(spark, texts()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_no_rows(spark):
    assert quality_rules.judge(docs(spark, [])).collect() == []
