from tallyhouse.functions.dates import add_date_parts, between_days, day_code, day_text
from tallyhouse.functions.names import canonical_value, canonicalize, canonicalize_from_table

__all__ = [
    "add_date_parts",
    "between_days",
    "canonical_value",
    "canonicalize",
    "canonicalize_from_table",
    "day_code",
    "day_text",
]
