from __future__ import annotations

import random
import zlib

import numpy as np

from llm_samples import docs, odd_texts, words
from tallyhouse.llm import quality_classifier as qc


def labelled(spark, n=300, seed=1):
    """Clean texts and junk of four kinds, with labels for all."""
    draw = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        text, good = words(draw, draw.randint(5, 200)).capitalize() + ".", draw.random() < 0.8
        if not good:
            kind = draw.randrange(4)
            text = [text.upper().replace(" ", "!! "), text.replace(" ", "### "), text.replace(" ", " | "),
                    " ".join(w for w in text.split() for _ in range(12))][kind]
        texts.append((i, text))
        labels.append((i, int(good), 0))
    return docs(spark, texts), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_labels_are_found(spark):
    rows, labels = labelled(spark)
    model = qc.train(rows, qc.for_learning(labels))
    got = {r["doc_id"]: r["score"] for r in qc.with_score(rows, model).collect()}
    held = [r for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert held
    right = [(got[r["doc_id"]] >= qc.CUT) == bool(r["quality"]) for r in held]
    assert np.mean(right) > 0.97
    assert all(0 <= s <= 1 for s in got.values())


def test_held_out_labels_are_not_read(spark):
    rows, labels = labelled(spark)
    learn = {r["doc_id"] for r in qc.for_learning(labels).collect()}
    assert learn == {i for i in range(300) if zlib.crc32(str(i).encode()) % 5}


def test_the_score_follows_from_the_text_alone(spark):
    rows, labels = labelled(spark)
    model = qc.train(rows, labels)
    again = qc.train(rows.repartition(7), labels.repartition(3))
    assert np.array_equal(model.weights, again.weights)
    twice = docs(spark, [(1, "One text."), (2, "One text."), (2, "One text.")])
    assert len({r["score"] for r in qc.with_score(twice, model).collect()}) == 1


def test_a_repeated_id_is_learned_from_once(spark, monkeypatch):
    rows, labels = labelled(spark, 60)
    want = qc.train(rows, labels)
    learned = []
    monkeypatch.setattr(qc, "fit", lambda rows, good, fit=qc.fit: learned.append(len(rows)) or fit(rows, good))
    copies = rows.where("doc_id < 3").selectExpr("*", "explode(sequence(1, 200))").drop("col")
    model = qc.train(rows.union(copies), labels.union(labels.where("doc_id < 3")))
    assert learned == [60] and np.array_equal(model.weights, want.weights)
    others = docs(spark, [(1, f"Another text {n}.") for n in range(50)])
    models = [qc.train(x, labels) for x in (rows.union(others), others.union(rows).repartition(5))]
    assert learned == [60] * 3 and np.array_equal(models[0].weights, models[1].weights)


def test_pairs_order_the_scores():
    draw = np.random.default_rng(1)
    rows = draw.normal(size=(400, qc.FEATURES))
    good = rows[:, 0] + 0.1 * draw.normal(size=400) > 0.8
    model = qc.fit(rows, good)
    scores = model.scores(rows)
    assert (scores[good][:, None] > scores[~good]).mean() > 0.98
    assert ((scores >= qc.CUT).sum()) == good.sum()


def test_odd_rows_and_clashing_columns(spark):
    rows = docs(spark, odd_texts(), extra=True)
    _, labels = labelled(spark, 20)
    model = qc.train(rows, labels.union(labels.selectExpr("null", "quality", "toxic")))
    kept = qc.accepted(rows, model)
    assert kept.columns == rows.columns
    assert kept.count() <= rows.count()
    assert qc.with_score(rows, model, score_column="s").where("s IS NULL").count() == 0


def test_without_two_classes_every_score_is_a_half(spark):
    rows, labels = labelled(spark, 10)
    for some in (labels.limit(0), labels.where("quality = 1")):
        model = qc.train(rows, some)
        assert {r["score"] for r in qc.with_score(rows, model).collect()} == {0.5}
    assert qc.with_score(rows.limit(0), model).collect() == []
