"""Finding and spreading the few keys that hold a large share of the rows.

A window or a join sends all rows of a key to one task. The operators here and in ``scd2`` and
``latest`` first look for keys above ``HOT_ROWS`` rows, and treat those another way. Looking is a job of
its own that counts a sample of the key columns; all rows of all keys are then worked on, and with no
such key the plan is the plain one. A table has at most its rows / ``hot_rows`` such keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lamina.columns import col, free_name
from lamina.session import work_dir

HOT_ROWS = 5_000_000
# How many sampled rows a key at the threshold has; the estimate is then within a few percent.
SAMPLE_AT_THRESHOLD = 10_000
# A list of hot keys up to this long is broadcast; a longer one is joined as Spark sees fit.
BROADCAST_KEYS = 100_000
# Rows without a key match nothing, so their number of salts needs no bound.
NULL_SALTS = 1 << 20


def heavy_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None) -> DataFrame | None:
    """The keys with more than ``hot_rows`` rows, and their rough number of rows ``hot_n``.

    None if there are none. A sample is enough, since missing a key costs balance only. The list is
    kept as a table below ``spark.checkpoint.dir``, so every branch that uses it sees the same keys.
    """
    if hot_rows is None:
        return None
    fraction = min(1.0, SAMPLE_AT_THRESHOLD / hot_rows)
    seen = df.select(*[col(k) for k in keys])
    if fraction < 1.0:
        seen = seen.sample(fraction, seed=17)
    counted = seen.groupBy(*[col(k) for k in keys]).agg(
        (F.count("*") / F.lit(fraction)).cast("bigint").alias("hot_n")
    )
    spark = df.sparkSession
    path = work_dir(spark, "hot_keys")
    written = Observation()
    counted.where(F.col("hot_n") > hot_rows).observe(
        written, F.count(F.lit(1)).alias("keys")
    ).write.mode("overwrite").parquet(path)
    found = written.get["keys"]
    if not found:
        return None
    hot = spark.read.schema(counted.schema).parquet(path)
    return F.broadcast(hot) if found <= BROADCAST_KEYS else hot


def parts(hot_rows: int) -> Column:
    """Into how many parts a hot key is cut, from its row count ``hot_n``."""
    return F.ceil(F.col("hot_n") / F.lit(hot_rows)).cast("int")


def skew_join(
    many: DataFrame,
    one: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot_rows: int | None = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join on ``on`` where a few keys may hold most rows of ``many``.

    ``hot`` is their list, if the caller has it already.

    Rows of a hot key are spread over salts by their content (a retried task repeats the same
    choice), and only the matching rows of ``one`` are repeated. Null keys match nothing and are spread
    too. ``many`` must hold distinct rows for the spread to work; duplicates cost balance, not
    correctness.
    """
    if hot is None:
        hot = heavy_keys(many, on, hot_rows)
    if hot is None:
        return many.join(one, list(on), how)
    salts, salt = free_name("hot_salts", many, one), free_name("hot_salt", many, one)
    hot = hot.select(*[col(k) for k in on], parts(hot_rows).alias(salts))
    spread = F.xxhash64(*[col(c) for c in many.columns])
    no_key = reduce(or_, [col(k).isNull() for k in on])
    salted = many.join(hot, list(on), "left").select(
        *[col(c) for c in many.columns],
        F.when(F.col(salts).isNotNull(), F.pmod(spread, F.col(salts)))
        .when(no_key, F.pmod(spread, F.lit(NULL_SALTS)))
        .otherwise(F.lit(0))
        .cast("int")
        .alias(salt),
    )
    repeated = one.join(hot, list(on), "left").select(
        *[col(c) for c in one.columns],
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col(salts), F.lit(1)) - F.lit(1))).alias(salt),
    )
    return salted.join(repeated, [*on, salt], how).drop(salt)
