"""Checks across tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.columns import col


def missing_keys(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The distinct keys, of one column or several, of ``left`` that ``right`` lacks; nulls compare equal.

    Each side is made distinct before they meet, so a key's repeats vanish on the map side.
    """
    keys = [col(k) for k in ([key] if isinstance(key, str) else key)]
    return left.select(*keys).distinct().subtract(right.select(*keys).distinct())


def count_spread(df: DataFrame, key: str) -> DataFrame:
    """The smallest and the greatest number of rows per key."""
    return (
        df.groupBy(col(key))
        .agg(F.count("*").alias("cnt"))
        .agg(F.min("cnt").alias("min_cnt"), F.max("cnt").alias("max_cnt"))
    )
