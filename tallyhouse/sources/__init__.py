from tallyhouse.sources.delimited import RAW_LINE, read_delimited, read_feed
from tallyhouse.sources.warehouse import discover_table, read_table

__all__ = ["RAW_LINE", "discover_table", "read_delimited", "read_feed", "read_table"]
