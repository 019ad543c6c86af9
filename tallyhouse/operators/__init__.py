from tallyhouse.operators.aggregate import count_per, sum_per, top_k
from tallyhouse.operators.checks import (
    duplicate_keys,
    schema_diff,
    split_invalid_keys,
    table_diff,
    unmatched,
)
from tallyhouse.operators.join import matching
from tallyhouse.operators.merge import (
    append_distinct,
    change_columns,
    day_codes,
    distinct_rows,
    latest_per_key,
    on_days,
    ranked_changes,
    rows_to_append,
    touched_days,
    union_all,
    upsert_latest,
)
from tallyhouse.operators.project import conform_names, fresh, keep

__all__ = [
    "append_distinct",
    "change_columns",
    "conform_names",
    "count_per",
    "day_codes",
    "distinct_rows",
    "duplicate_keys",
    "fresh",
    "keep",
    "latest_per_key",
    "matching",
    "on_days",
    "ranked_changes",
    "rows_to_append",
    "schema_diff",
    "split_invalid_keys",
    "sum_per",
    "table_diff",
    "top_k",
    "touched_days",
    "union_all",
    "unmatched",
    "upsert_latest",
]
