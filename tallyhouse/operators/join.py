from __future__ import annotations

from pyspark.sql import DataFrame


def matching(facts: DataFrame, entities: DataFrame, key: str) -> DataFrame:
    """Facts with their entity's columns; facts without an entity are left out.

    There is no broadcast hint. Spark sends the entities out only when their
    size is under its threshold; else both sides are shuffled by the key, and
    AQE splits the partition of a key with very many facts.
    """
    return facts.join(entities, key, "inner")
