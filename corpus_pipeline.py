"""Documents to training windows, in five stages, each written and read again.

quality -> line dedup -> near-duplicates -> decontamination -> packing. Every
stage but the last returns the columns of `documents`; a filtering stage returns
rows as they came, and line dedup also renews `n_chars` where there is one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import decontamination, line_dedup, packing, quality_classifier, simhash_dedup
from tallyhouse.llm.common import load, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    labels = quality_classifier.for_learning(load(spark, sf_dir, "labels"))
    model = quality_classifier.train(load(spark, sf_dir, "documents"), labels)
    return quality_classifier.accepted(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the chunks and passages of lines that an earlier document has."""
    cleaned = line_dedup.dedup_lines(docs, passage_words=line_dedup.PASSAGE_WORDS)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(kind))
    return cleaned


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash_dedup.one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.without_leaks(docs, load(spark, sf_dir, "benchmark"))


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the training windows they lie in."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("packing", windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


# A learned model, fingerprints and token ids are beyond SQL.
ORACLE_SQL = None
