"""Column types of the three source tables and of the change feed.

Streaming file sources need a schema up front, so the tables are declared here once.
"""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
}


def _struct(text: str) -> T.StructType:
    """Columns from "name TYPE, ..."; Spark's own DDL reader needs a running session."""
    pairs = (column.split() for column in text.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


ACCOUNTS = _struct(
    "id BIGINT, acct_id STRING, acct_name STRING, acct_number INT, acct_type STRING, "
    "balance DOUBLE, acct_status STRING, open_date TIMESTAMP, closed_date TIMESTAMP, "
    "margin_enabled STRING, risk_tolerance STRING, created_date TIMESTAMP"
)

CUSTOMER = _struct(
    "id BIGINT, customer_id STRING, first_name STRING, last_name STRING, email STRING, "
    "phone_number STRING, acct_id STRING, state_cd STRING, latitude DOUBLE, longitude DOUBLE, "
    "country_cd STRING, created_at TIMESTAMP"
)

TRANSACTIONS = _struct(
    "id BIGINT, transaction_id STRING, acct_id STRING, ticker_symbol STRING, "
    "transaction_type STRING, quantity DOUBLE, price_per_share DOUBLE, total_amt DOUBLE, "
    "transaction_date TIMESTAMP, order_type STRING, trade_status STRING, created_date TIMESTAMP, "
    "total_holdings DOUBLE"
)

# The metadata columns of a change feed and its four change types.
CHANGE_COLUMNS = ("_change_type", "_commit_version", "_commit_timestamp")
INSERT = "insert"
UPDATE_PREIMAGE = "update_preimage"
UPDATE_POSTIMAGE = "update_postimage"
DELETE = "delete"


def change_feed(table: T.StructType) -> T.StructType:
    """The table's columns and the three metadata columns of its change feed."""
    return T.StructType(
        table.fields
        + _struct("_change_type STRING, _commit_timestamp TIMESTAMP, _commit_version BIGINT").fields
    )


def bronze(table: T.StructType) -> T.StructType:
    """The table's columns and those that bronze enrichment adds."""
    return T.StructType(
        table.fields
        + _struct(
            "ingestion_timestamp TIMESTAMP, source_file STRING, operation_type STRING, "
            "commit_version BIGINT, commit_timestamp TIMESTAMP"
        ).fields
    )
