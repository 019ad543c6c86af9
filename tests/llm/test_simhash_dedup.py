from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from llm_samples import docs, odd_texts, words
from tallyhouse.llm import simhash_dedup
from tallyhouse.llm.components import components


def plain_print(text, shingle=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return 0
    grams = [" ".join(found[i:i + shingle]) for i in range(max(len(found) - shingle, 0) + 1)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(texts, bits=4):
    prints = [plain_print(t) for _, t in texts]
    root = list(range(len(texts)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in range(len(texts)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(texts):
        if i is not None:
            least[find(n)] = min(i, least.get(find(n), i))
    return sorted(
        ((i, f"{p:016x}", least.get(find(n))) for n, ((i, _), p) in enumerate(zip(texts, prints))), key=str
    )


def corpus(seed):
    draw = random.Random(seed)
    texts = []
    for i in range(40):
        base = words(draw, draw.choice([3, 30, 400])).split()
        texts.append((draw.randint(0, 10_000), " ".join(base)))
        for _ in range(draw.randint(0, 4)):
            near = list(base)
            for _ in range(draw.randint(1, 3)):
                near[draw.randrange(len(near))] = "zz"
            texts.append((draw.randint(0, 10_000), "\t".join(near).upper()))
    return texts


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("blocks", [None, 5, 7])
def test_agrees_with_all_pairs(spark, blocks):
    texts = corpus(1)
    assert found(simhash_dedup.near_duplicates(docs(spark, texts), blocks=blocks)) == brute(texts)


def test_more_fingerprints_make_more_blocks():
    found = [simhash_dedup.blocks_for(n, 4) for n in (0, 10**6, 10**8, 10**10, 10**12)]
    assert found == [6, 6, 7, 8, 10]


def test_odd_rows(spark):
    texts = odd_texts()
    assert found(simhash_dedup.near_duplicates(docs(spark, texts, extra=True))) == brute(texts)


def test_no_rows(spark):
    assert simhash_dedup.near_duplicates(docs(spark, [])).collect() == []
    assert simhash_dedup.one_of_each(docs(spark, [])).collect() == []


def test_links_join_what_all_pairs_join(spark):
    """Fingerprints within few bits of each other, in chains and clusters."""
    draw = np.random.default_rng(2)
    centres = draw.integers(0, 1 << 63, 30, dtype=np.uint64)
    prints = [int(c) for c in centres]
    for _ in range(600):
        one = prints[int(draw.integers(0, len(prints)))]
        for _ in range(int(draw.integers(1, 5))):
            one ^= 1 << int(draw.integers(0, 64))
        prints.append(one)
    prints = sorted(set(prints))
    rows = spark.createDataFrame([(simhash_dedup._signed(p),) for p in prints], "print bigint")
    links = simhash_dedup.linked_prints(rows, 4, 6).collect()
    assert all(((a ^ b) & (2 ** 64 - 1)).bit_count() <= 4 for a, b in links)
    assert len(links) < 15 * len(prints)

    def classes(pairs):
        root = {p: p for p in prints}

        def find(p):
            while root[p] != p:
                p = root[p]
            return p

        for a, b in pairs:
            root[find(a)] = find(b)
        groups = {}
        for p in prints:
            groups.setdefault(find(p), set()).add(p)
        return sorted(map(sorted, groups.values()))

    exact = [(a, b) for n, a in enumerate(prints) for b in prints[:n] if (a ^ b).bit_count() <= 4]
    mask = 2 ** 64 - 1
    assert classes(exact) == classes([(a & mask, b & mask) for a, b in links])


def test_one_document_of_each_group_stays(spark):
    texts = corpus(3) + [(1, "a b"), (1, "a b"), (None, "only null"), (None, "only null")]
    rows = docs(spark, texts, extra=True)
    kept = simhash_dedup.one_of_each(rows)
    assert kept.columns == rows.columns
    want = {c for _, _, c in brute(texts)}
    got = [r["doc_id"] for r in kept.collect()]
    assert set(got) == want and len(got) == len(set(got))


def test_rows_of_null_and_repeated_ids_stay_by_component(spark):
    draw = random.Random(8)
    a, b, c, d, e, f = (words(draw, 60) for _ in range(6))
    texts = [
        (None, a), (None, b), (None, b),  # two documents without an id
        (5, c), (5, d), (5, d),  # two documents of one id
        (2, e), (7, e), (7, f),  # of one id a copy and a document of its own
        (None, c), (9, None), (None, ""),
    ]
    kept = simhash_dedup.one_of_each(docs(spark, texts, extra=True)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(
        [(None, a), (None, b), (5, c), (5, d), (2, e), (7, f), (9, None)], key=str
    )


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(n, n + 1) for n in range(100, 160)]
    star = [(7, n) for n in range(1000, 1100)]
    rows = spark.createDataFrame(chain + star + [(7, 7), (None, 3)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components(rows).collect()}
    assert got == {**{n: 100 for n in range(100, 161)}, **{n: 7 for n in (7, *range(1000, 1100))}}


def far_apart(seed, n, shared=21):
    """Fingerprints that agree in some bits and are random in the others."""
    draw = random.Random(seed)
    return [draw.getrandbits(64 - shared) << shared | (0x155555 & (1 << shared) - 1) for _ in range(n)]


def joined(prints, links):
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            parent[p] = parent[parent[p]]
            p = parent[p]
        return p

    for a, b in links:
        parent[root(a)] = root(b)
    groups = {}
    for p in prints:
        groups.setdefault(root(p), set()).add(p)
    return {frozenset(g) for g in groups.values()}


def found_links(prints, most_bits=4, mask=0):
    array = np.unique(np.array(prints, np.uint64))
    return [(int(a), int(b)) for x, y in simhash_dedup._links_of(array, most_bits, mask) for a, b in zip(x, y)]


@pytest.mark.parametrize("searches", [1, 4, 256])
def test_a_file_that_is_filed_again_loses_no_link(monkeypatch, searches):
    monkeypatch.setattr(simhash_dedup, "SEARCHES", searches)
    draw = random.Random(searches)
    mask = (1 << 21) - 1
    prints = far_apart(1, 600)
    for p in prints[:40]:
        # A chain of neighbours, and a crowd around one.
        for _ in range(draw.randint(1, 4)):
            for _ in range(draw.randint(1, 4)):
                p ^= 1 << draw.randint(21, 63)
            prints.append(p)
    prints += [prints[50] ^ 1 << a ^ 1 << b for a in range(21, 64) for b in range(21, a)]
    array = np.unique(np.array(prints, np.uint64))
    every = [(int(a), int(b)) for n, a in enumerate(array)
             for b in array[n + 1:][np.bitwise_count(array[n + 1:] ^ a) <= 4]]
    links = found_links(prints, mask=mask)
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    assert joined(array.tolist(), links) == joined(array.tolist(), every)


def test_no_bits_left_to_file_by():
    few = [a << 60 | 5 for a in range(16)]
    found = list(simhash_dedup._filed_again(np.array(few, np.uint64), 4, (1 << 60) - 1))
    assert joined(few, [(int(a), int(b)) for x, y in found for a, b in zip(x, y)]) == {frozenset(few)}


def test_unlinked_fingerprints_of_one_file_cost_far_less_than_their_square(monkeypatch):
    compared = []

    class Counting:
        def __getattr__(self, name):
            return getattr(np, name)

        def bitwise_count(self, x):
            compared.append(len(x))
            return np.bitwise_count(x)

    monkeypatch.setattr(simhash_dedup, "np", Counting())
    costs = []
    for n in (10_000, 40_000):
        compared.clear()
        assert len(found_links(far_apart(7, n), mask=(1 << 21) - 1)) < n // 100
        costs.append(sum(compared))
    # Four times as many: sixteen times the comparisons if all were compared.
    assert costs[1] < 6 * costs[0] and costs[1] < 0.05 * 40_000**2
