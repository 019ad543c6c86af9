"""The two reports, for any facts, entities and columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.dates import day_text
from tallyhouse.operators.aggregate import count_per, sum_per, top_k
from tallyhouse.operators.join import matching
from tallyhouse.schemas import DAY_PARTS, MONEY


def daily_activity(
    facts: DataFrame,
    entities: DataFrame,
    key: str = "account_id",
    moment: str = "transmit_time",
    labels: Sequence[str] = ("first_name", "last_name"),
    count: str = "num_transactions",
    by_partition: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Facts per entity and day, under the entity's labels, sorted by day.

    The grain is the key: two entities with the same labels get a row each.
    Facts without an entity are left out (`unmatched` lists them). An entity
    listed twice counts once, with its least labels; `unique` says that none is,
    as `ingest_accounts` leaves them, and saves looking. So both sides have one
    row for what they are joined by, and facts are counted before the join.
    With `by_partition` the day comes from a table's partition columns instead
    of from `moment`, which is then not read from the files at all.
    """
    day = F.make_date(*DAY_PARTS) if by_partition else F.to_date(moment)
    per_day = count_per(facts.select(key, day.alias(moment)), [key, moment], count)
    once = entities.select(key, *labels)
    if not unique:
        least = entities.groupBy(key).agg(F.min(F.struct(*labels)).alias("__labels"))
        once = least.select(key, "__labels.*")
    named = matching(per_day, once, key)
    # Grouped, sent and sorted as a date; only the finished rows carry text.
    ordered = named.orderBy(moment, *labels, key)
    return ordered.select(*labels, day_text(moment).alias(moment), count)


def top_k_by_sum(
    df: DataFrame,
    group: str = "merchant_name",
    amount: str = "amount",
    k: int = 3,
    total: str = "dollars_spent",
    money=MONEY,
) -> DataFrame:
    """The `k` groups with the largest sums, largest first, ties by name."""
    return top_k(sum_per(df, [group], amount, total, money), total, k, [group])
