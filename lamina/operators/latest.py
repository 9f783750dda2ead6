"""The latest rows of each group, ties kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from lamina.columns import col, free_name, none_null
from lamina.operators.heavy import BROADCAST_KEYS, HOT_ROWS, SAMPLE_AT_THRESHOLD, heavy_keys
from lamina.session import work_dir


def latest_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    hot_rows: int | None = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Rows whose ``order_by`` is the greatest of their group; rows with a null in either are lost.

    Equal to joining the table with its own per-group maximum, but in one pass: ``rank() = 1`` is cut
    down to each task's own best rows before the shuffle. Groups above ``hot_rows`` rows, whose ties
    alone could fill a task, are compared in place with their maximum instead. ``hot`` is their list, if
    the caller has it already. If it is too long to broadcast, all groups are joined with their maximum,
    so that whole rows move once, spread by ``order_by`` too.
    """
    keys = list(keys)
    grouped = [col(k) for k in keys]
    valid = df.where(none_null([*keys, order_by]))
    best_of, n_of = free_name("hot_best", df), free_name("hot_n", df)
    own = [col(c) for c in df.columns]
    best = valid.groupBy(*grouped).agg(F.max(col(order_by)).alias(best_of), F.count("*").alias(n_of))
    if hot is not None:
        many = hot.limit(BROADCAST_KEYS + 1).count() > BROADCAST_KEYS
    elif hot_rows is not None and hot_rows <= SAMPLE_AT_THRESHOLD:
        # The search counts every row then, and finds each group's maximum on the way.
        path, written = work_dir(df.sparkSession, "hot_best"), Observation()
        over = F.col(n_of) > hot_rows
        best.observe(written, F.count_if(over).alias("keys")).write.parquet(path)
        best, found = df.sparkSession.read.schema(best.schema).parquet(path), written.get["keys"]
        hot = F.broadcast(best.where(over)) if found else None
        many = found > BROADCAST_KEYS
    else:
        hot = heavy_keys(valid, keys, hot_rows)
        many = hot is not None and hot.limit(BROADCAST_KEYS + 1).count() > BROADCAST_KEYS
    if hot is None:
        return _ranked(valid, keys, order_by)
    if many:
        best = best.select(*grouped, best_of)
        return valid.withColumn(best_of, col(order_by)).join(best, [*keys, best_of]).select(*own)
    usual = valid.join(hot.select(*grouped), keys, "left_anti")
    busy = valid.join(hot.select(*grouped), keys)
    # One row per hot group, so no more than the list of hot groups has.
    best = busy.groupBy(*grouped).agg(F.max(col(order_by)).alias(best_of))
    latest = busy.join(best, keys).where(col(order_by) == F.col(best_of))
    return _ranked(usual.select(*own), keys, order_by).unionByName(latest.select(*own))


def _ranked(df: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    rank = free_name("latest_rank", df)
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(col(order_by).desc())
    return df.withColumn(rank, F.rank().over(window)).where(F.col(rank) == 1).drop(rank)
