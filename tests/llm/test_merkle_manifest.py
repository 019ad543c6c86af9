from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_samples import CLASHING, words
from tallyhouse.llm import merkle_manifest as mm
from tallyhouse.llm import queries

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def joined(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return joined("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def plain_tree(nodes):
    tree = [nodes]
    while len(tree[-1]) > 1:
        tree.append([joined(tree[-1][i:i + 3]) for i in range(0, len(tree[-1]), 3)])
    return tree


def plain_path(tree, i):
    """(siblings, own place among them) from the bottom up."""
    steps = []
    for level in tree[:-1]:
        first = i // 3 * 3
        family = level[first:first + 3]
        steps.append((family[:i - first] + family[i - first + 1:], i - first))
        i //= 3
    return steps


def plain_manifest(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        mine = by_source[source]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r, r[1])))
        trees[source] = plain_tree([plain_leaf(r, r[1]) for r in mine])
    top = plain_tree([trees[s][-1][0] for s in sources])
    root = top[-1][0]
    found = Counter()
    for place, source in enumerate(sources):
        for i, row in enumerate(by_source[source]):
            steps = plain_path(trees[source], i) + plain_path(top, place)
            text = row[1]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = plain_leaf(row, text)
            for siblings, at in steps:
                node = joined([*siblings[:at], node, *siblings[at:]])
            proof = joined(x for siblings, _ in steps for x in siblings)
            found[
                row[0], trees[source][0][i], trees[source][-1][0], root, proof, node, node == root
            ] += 1
    return found


def rows_of(seed, n):
    draw = random.Random(seed)
    sources = [None, "", "a", "é", "z", "hot", "hot", "hot", "hot"]
    rows = []
    for i in range(n):
        text = draw.choice([None, "", "one\ntwo", words(draw, 12) + "\n" + words(draw, 3), "\n"])
        size = None if text is None or i % 7 == 0 else len(text)
        rows.append((i - 5, text, draw.choice([None, "en"]), draw.choice(sources), size))
    return rows


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.fixture
def asked(spark, monkeypatch):
    """op13 over made-up rows, with small partitions and blocks."""

    def run(rows, extra=False, **sizes):
        schema, held = SCHEMA, rows
        if extra:
            names = [*CLASHING, "at", "part", "copy", "node", "kind", "held", "leaf", "root"]
            held = [(*row, *range(len(names))) for row in rows]
            schema += "".join(f", {name} bigint" for name in names)
        table = spark.createDataFrame(held, schema)
        real = mm.manifest
        with monkeypatch.context() as patch:
            patch.setattr(queries, "load", lambda *_: table)
            patch.setattr(mm, "manifest", lambda docs, held: real(docs, held, **sizes))
            found = queries.op13_merkle_manifest(spark, "")
            assert found.columns == COLUMNS
            return Counter(map(tuple, found.collect()))

    return run


@pytest.mark.parametrize(("n", "partition", "block"), [(200, 7, 1), (90, 1, 2), (120, 10_000, 6)])
def test_manifest_is_the_plain_one(asked, n, partition, block):
    rows = rows_of(n, n)
    found = asked(rows, extra=n == 90, partition_leaves=partition, block_levels=block)
    assert found == plain_manifest(rows)


def test_copies_null_ids_and_a_long_text(asked):
    draw = random.Random(3)
    long = (9, "\n".join(words(draw, 2000) for _ in range(50)), "en", "s", 1)
    same = (4, "a\nb", None, "s", 3)
    nulls = [(None, "x\ny", None, None, 3), (None, "x\nz", None, None, 3), (None, None, None, "s", None)]
    rows = [same] * 40 + [long, (4, "other", None, "s", 5), *nulls, *nulls]
    assert asked(rows, partition_leaves=6, block_levels=2) == plain_manifest(rows)


def test_lone_rows_and_no_rows(asked):
    assert not asked([])
    alone = [(1, "a\nb", "en", None, 3)]
    assert asked(alone) == plain_manifest(alone)
    each_its_own = [(i, "t", "en", f"s{i}", 1) for i in range(30)]
    assert asked(each_its_own, partition_leaves=4, block_levels=2) == plain_manifest(each_its_own)


def test_copies_of_one_row_lie_in_many_ranges(spark):
    table = spark.createDataFrame([(1, "s", "n")] * 100, "id bigint, source string, leaf string")
    placed = mm.placed(table, "source", ["id", "leaf"], 10).collect()
    assert sorted(row["at"] for row in placed) == list(range(100))
    assert max(Counter(row["part"] for row in placed).values()) < 60


def test_what_was_not_changed_is_verified(asked):
    for doc, leaf, subroot, root, proof, folded, verified in asked(rows_of(8, 60), partition_leaves=9):
        assert verified or zlib.crc32(str(doc).encode()) % 2 == 0


@given(st.integers(1, 200).flatmap(lambda n: st.tuples(st.just(n), st.sets(st.integers(0, n - 1), min_size=1))))
def test_octopus_is_what_is_missing_and_no_more(case):
    size, known = case
    tree = plain_tree([joined([str(i)]) for i in range(size)])
    spots = list(mm.octopus(known, size))
    assert len(set(spots)) == len(spots)
    partial = mm.Partial(
        size, {i: tree[0][i] for i in known}, {(lv, i): tree[lv][i] for lv, i in spots}
    )
    assert partial.root == tree[-1][0]
    for i in known:
        assert partial.path(0, i) == [x for family, _ in plain_path(tree, i) for x in family]
        assert partial.fold(i, tree[0][i]) == tree[-1][0]
        assert partial.fold(i, "0" * 64) != tree[-1][0]
    # None of them is above a known leaf, and none above another: leaving one out leaves a gap.
    above = {(lv, i // 3**lv) for i in known for lv in range(len(tree))}
    assert not above & set(spots)
    for level, i in spots:
        assert not any((lv, i // 3 ** (lv - level)) in spots for lv in range(level + 1, len(tree)))
        assert (level + 1, i // 3) in above


def test_leaf_tells_fields_apart(spark):
    rows = spark.createDataFrame([("1:a", None), ("1", ":a"), (None, "-"), ("-", None)], "a string, b string")
    found = rows.select(mm.leaf_digest(F.col("a"), F.col("b"))).distinct().count()
    assert found == 4
