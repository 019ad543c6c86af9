from __future__ import annotations

import random
from collections import Counter

import pytest

from llm_samples import docs, odd_texts, words
from tallyhouse.llm import common, merkle_manifest, packing, suffix_dedup, token_alignment


def rows(df):
    return Counter(map(str, df.collect()))


@pytest.mark.parametrize("run", [
    lambda d: suffix_dedup.dedup(d, slice_bytes=2000, bucket_bytes=4000, share_bytes=4000),
    lambda d: packing.pack(d, bin_pieces=5).select("doc_id", "start", "length", "ids_crc32", "doc_tokens"),
    lambda d: token_alignment.align_documents(d, lot_bytes=2000),
    lambda d: merkle_manifest.manifest(d, partition_leaves=5, block_levels=2),
], ids=["op3", "op5", "op12", "op13"])
def test_more_tasks_for_more_bytes_change_no_result(spark, monkeypatch, run):
    draw = random.Random(1)
    shared = words(draw, 40)
    texts = odd_texts()[4:] + [(n, words(draw, 20) + shared[n:]) for n in range(20, 40)]
    table = docs(spark, texts)
    few = rows(run(table))
    monkeypatch.setattr(common, "TASK_BYTES", 200)
    df = run(table)
    assert rows(df) == few


def test_tasks_follow_bytes_where_the_session_has_too_few(spark):
    df = spark.range(100)
    assert common.dealt(df, 10 * common.TASK_BYTES, "id").rdd.getNumPartitions() == 11
    # Grouping by the same key moves nothing again.
    plan = common.dealt(df, 10 * common.TASK_BYTES, "id").groupBy("id").count()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1
    assert common.dealt(df, 3 * common.TASK_BYTES, "id") is df
