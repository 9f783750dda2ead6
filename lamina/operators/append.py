"""Silver in append mode: rows are stamped as open versions and never closed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns that bronze may have added; a missing one is no error.
BRONZE_EXTRAS = ("ingestion_timestamp", "source_file")


def append_silver(
    df: DataFrame, doubles: Sequence[str] = (), drop: Sequence[str] = BRONZE_EXTRAS, started_at=None
) -> DataFrame:
    """Casts, validity stamps and ``is_current``; ``started_at`` defaults to now."""
    return df.withColumns(
        {
            **{c: F.col(c).cast("double") for c in doubles},
            "__START_AT": F.current_timestamp() if started_at is None else started_at,
            "__END_AT": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        }
    ).drop(*drop)


def append_transactions(df: DataFrame) -> DataFrame:
    """Immutable facts: amounts as doubles, the transaction's day as a date, no validity."""
    return df.withColumns(
        {
            "total_amt": F.col("total_amt").cast("double"),
            "total_holdings": F.col("total_holdings").cast("double"),
            "transaction_date": F.col("transaction_date").cast("date"),
        }
    ).drop("source_file", "processed_timestamp", "created_date")
