"""The change log of a table: Parquet, one partition per commit, three metadata columns.

A commit is written beside the log and moved into it when it is complete. It is never changed: a stream
has taken its files in, and would take new ones in again. Writing a version that is there is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.schemas import CHANGE_COLUMNS, change_feed
from lamina.sources.files import Store, hidden


def write_commit(feed: DataFrame, path: str, version: int, timestamp) -> None:
    """Store rows with ``_change_type`` as commit ``version`` at ``timestamp``.

    Raises FileExistsError, before anything is written, if the log has that version.
    """
    stamp = F.lit(timestamp).cast("timestamp")
    name = f"_commit_version={version}"
    _refuse(Store(feed.sparkSession, path), path, [name])
    staged = hidden(path)
    feed.withColumn("_commit_timestamp", stamp).write.parquet(f"{staged}/{name}")
    _move_in(feed.sparkSession, staged, path)


def write_commits(feed: DataFrame, path: str) -> None:
    """Store a feed that carries all three metadata columns, each commit in its own partition.

    Raises FileExistsError, and leaves the log as it was, if it has one of the versions.
    """
    staged = hidden(path)
    feed.hint("rebalance", "_commit_version").write.partitionBy("_commit_version").parquet(staged)
    _move_in(feed.sparkSession, staged, path)


def _refuse(store: Store, path: str, names: list[str]) -> None:
    there = [n for n in names if store.exists(f"{path}/{n}")]
    if there:
        raise FileExistsError(f"{path} has {', '.join(sorted(there)[:5])} already")


def _move_in(spark: SparkSession, staged: str, path: str) -> None:
    """Move staged commits into the log, in the order of their versions."""
    store = Store(spark, path)
    names = [n for n in store.children(staged) if n.startswith("_commit_version=")]
    try:
        _refuse(store, path, names)
        for name in sorted(names, key=lambda n: int(n.partition("=")[2])):
            store.move(f"{staged}/{name}", f"{path}/{name}")
    finally:
        store.remove(staged)


def read_changes(
    spark: SparkSession, path: str, table: T.StructType, starting_version: int | None = None
) -> DataFrame:
    """The log as a batch: all of it, or the commits from ``starting_version`` on."""
    return _since(spark.read.schema(change_feed(table)).parquet(path), starting_version)


def read_change_stream(
    spark: SparkSession,
    path: str,
    table: T.StructType,
    starting_version: int | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """The log as a stream. The initial load is its first commit, so the default gives snapshot then
    changes."""
    reader = spark.readStream.schema(change_feed(table))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _since(reader.parquet(path), starting_version)


def _since(log: DataFrame, starting_version: int | None) -> DataFrame:
    if starting_version is None:
        return log
    return log.where(F.col("_commit_version") >= starting_version)


def has_change_feed(df: DataFrame) -> bool:
    """Whether a table carries the metadata columns of a feed."""
    return set(CHANGE_COLUMNS) <= set(df.columns)
