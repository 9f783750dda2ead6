"""Expectations that count failing rows and keep them. A predicate that is null has failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT = "dataset STRING, expectation STRING, total_rows BIGINT, failed_rows BIGINT"


def _counters(expectations: dict[str, str], only: str = "true") -> list[Column]:
    counted = F.coalesce(F.expr(only), F.lit(False))
    return [F.count_if(counted).alias("total_rows")] + [
        F.count_if(counted & ~F.coalesce(F.expr(rule), F.lit(False))).alias(f"failed_{i}")
        for i, rule in enumerate(expectations.values())
    ]


def expect_all(
    df: DataFrame, expectations: dict[str, str], only: str = "true"
) -> tuple[DataFrame, Observation]:
    """The same rows, counted as the next action on them runs; one observation serves one action.

    ``only`` says which of the rows to count.
    """
    seen = Observation()
    return df.observe(seen, *_counters(expectations, only)), seen


def observed_report(
    spark: SparkSession, dataset: str, expectations: dict[str, str], seen: Observation
) -> DataFrame:
    """The counts of a finished action, one row per expectation."""
    counts = seen.get
    rows = [
        (dataset, name, counts.get("total_rows", 0), counts.get(f"failed_{i}", 0))
        for i, name in enumerate(expectations)
    ]
    return spark.createDataFrame(rows, REPORT)


def expectation_report(df: DataFrame, dataset: str, expectations: dict[str, str]) -> DataFrame:
    """The same counts as a query: one pass over ``df``, one row per expectation."""
    failed = [
        F.struct(F.lit(name).alias("expectation"), F.col(f"failed_{i}").alias("failed_rows"))
        for i, name in enumerate(expectations)
    ]
    return df.agg(*_counters(expectations)).select(
        F.lit(dataset).alias("dataset"), F.explode(F.array(*failed)).alias("rule"), "total_rows"
    ).select("dataset", "rule.expectation", "total_rows", "rule.failed_rows")
