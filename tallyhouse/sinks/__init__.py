from tallyhouse.sinks.key_index import days_with_keys
from tallyhouse.sinks.lease import LeaseLost, TableBusy, writing
from tallyhouse.sinks.publish import (
    append_partitioned,
    day_folder,
    latest_version,
    publish_days,
    publish_partitioned,
    publish_version,
    publish_version_days,
    restore_interrupted,
    sweep_deliveries,
)
from tallyhouse.sinks.report import write_report

__all__ = [
    "LeaseLost",
    "TableBusy",
    "append_partitioned",
    "day_folder",
    "days_with_keys",
    "latest_version",
    "publish_days",
    "publish_partitioned",
    "publish_version",
    "publish_version_days",
    "restore_interrupted",
    "sweep_deliveries",
    "write_report",
    "writing",
]
