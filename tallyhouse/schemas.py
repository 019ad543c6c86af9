"""Column names, types and value maps of the two feeds and their tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# Every table is laid out by calendar day of its own timestamp.
DAY_PARTS = ["year", "month", "day"]

# Fixed value: how both feeds write a moment in time.
FEED_TIMESTAMP = "M/d/y H:m:s"


class Feed(NamedTuple):
    """One delimited feed and the warehouse table it fills."""

    name: str
    sep: str
    # file header -> (table column, type), in file order; None marks a column
    # whose header is blank in the file, named as Spark's reader names it
    columns: dict[str, tuple[str, T.DataType] | None]
    key: str
    moment: str

    @property
    def source_schema(self) -> T.StructType:
        return T.StructType([
            T.StructField(header, T.StringType() if target is None else target[1])
            for header, target in self.columns.items()
        ])

    @property
    def names(self) -> dict[str, str]:
        """file header -> table column, without the blank columns."""
        return {h: target[0] for h, target in self.columns.items() if target is not None}

    @property
    def table_schema(self) -> T.StructType:
        fields = [T.StructField(*target) for target in self.columns.values() if target is not None]
        return T.StructType(fields + [T.StructField(p, T.IntegerType()) for p in DAY_PARTS])


# The headers of the account feed and the table's column names.
# The postal code is text, since an integer would lose leading zeros.
ACCOUNTS = Feed(
    name="accounts",
    sep="\t",
    columns={
        "account_id": ("account_id", T.StringType()),
        "first_name": ("first_name", T.StringType()),
        "last_name": ("last_name", T.StringType()),
        "creation_date": ("creation_date", T.TimestampType()),
        "updated_date": ("updated_date", T.TimestampType()),
        "Postal_Code": ("postal_code", T.StringType()),
        "Cardholder_Country": ("cardholder_country", T.StringType()),
        "Card_status": ("card_status", T.StringType()),
    },
    key="account_id",
    moment="updated_date",
)

# The headers of the authorization feed and the table's names.
AUTHS = Feed(
    name="auths",
    sep=",",
    columns={
        "_c0": None,
        "account_id": ("account_id", T.StringType()),
        "_c2": None,
        "Transmit Time": ("transmit_time", T.TimestampType()),
        "Transaction Type": ("transaction_type", T.StringType()),
        "Merchant Country": ("merchant_country", T.StringType()),
        "Amount": ("amount", T.DoubleType()),
        "merchant_name": ("merchant_name", T.StringType()),
    },
    key="account_id",
    moment="transmit_time",
)

# Merchant spelling -> the name reports use. Anything not listed
# here passes through as it is.
MERCHANT_NAMES = {
    "walmrt": "walmart",
    "walmart": "walmart",
    "Walmrt": "walmart",
    "target": "target",
    "Target": "target",
    "google": "google",
    "amazon": "amazon",
    "amzn": "amazon",
    "Walgreens": "walgreens",
    "Home depot": "home_depot",
    "Cvs": "cvs",
}

# Money is summed as a decimal, so a total does not depend on the order in
# which partitions are added up.
MONEY = T.DecimalType(18, 2)
