"""The numbered queries: each operator over the whole of its table, as the driver runs it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    chat_format,
    decontamination,
    html_extraction,
    line_dedup,
    merkle_manifest,
    packing,
    quality_classifier,
    quality_rules,
    simhash_dedup,
    suffix_dedup,
    token_alignment,
    url_filter,
    warc,
)
from tallyhouse.llm.common import fresh, load

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(load(spark, sf_dir, "pages"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(load(spark, sf_dir, "pages"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(load(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(load(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(load(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(load(spark, sf_dir, "pages"), url_filter.labelled(spark))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    counts = fresh(docs, "n_lines"), fresh(docs, "n_removed")
    cleaned = line_dedup.dedup_lines(docs, counts=counts, passage_words=line_dedup.PASSAGE_WORDS)
    return cleaned.select(
        "doc_id", *[F.col(c).alias(name) for c, name in zip(counts, ("n_lines", "n_removed"))],
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = quality_classifier.train(docs, quality_classifier.for_learning(labels))
    scored = quality_classifier.with_score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality_classifier.CUT).cast("int").alias("predicted"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")
    return decontamination.leaks(docs, benchmark)


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # One more conversation, whose texts say what the template says.
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    return chat_format.digests(chat_format.format_conversations(rows.unionByName(planted)))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_alignment.align_documents(load(spark, sf_dir, "documents"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    held = merkle_manifest.leaf_digest(
        *[text if name == "text" else F.col(name) for name in merkle_manifest.FIELDS]
    )
    return merkle_manifest.manifest(docs, held).select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.concat_ws("", "proof"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_warc_index_merge,
        op2_html_extraction,
        op3_suffix_dedup,
        op4_quality_rules,
        op5_packing,
        op6_simhash_dedup,
        op7_url_filter,
        op8_line_dedup,
        op9_quality_classifier,
        op10_decontamination,
        op11_chat_format,
        op12_token_alignment,
        op13_merkle_manifest,
    )
}

# Those that SQL can express; the others are tested against plain versions in tests/llm.
ORACLES: dict[str, str] = {"op4_quality_rules": quality_rules.sql()}
