from tallyhouse.plans.ingest import (
    ingest_accounts,
    ingest_auths,
    read_accounts,
    tidy_auths,
    tidy_days,
    upsert_days,
)
from tallyhouse.plans.pipeline import PipelineResult, run
from tallyhouse.plans.reports import daily_activity, top_k_by_sum

__all__ = [
    "PipelineResult",
    "daily_activity",
    "ingest_accounts",
    "ingest_auths",
    "read_accounts",
    "run",
    "tidy_auths",
    "tidy_days",
    "top_k_by_sum",
    "upsert_days",
]
