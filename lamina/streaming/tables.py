"""Streaming tables. Each run takes what is new since the last one and stops."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lamina.operators.quality import expect_all, observed_report
from lamina.sources.files import Store, hidden


# The folder, and so the column, by which ``stream_with_quality`` keeps batches apart.
BATCH = "_batch"
#: Batches whose counts are added into one.
MERGED_COUNTS = 16


def stream_to_table(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append a stream to a Parquet table; with ``partition_by`` rows are first brought together, so
    that a run writes few files per partition."""
    if partition_by:
        stream = stream.hint("rebalance", *partition_by)
    writer = stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.option("checkpointLocation", checkpoint).start(path)
    query.awaitTermination()
    return query


def stream_with_quality(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    dataset: str,
    expectations: dict[str, str],
    quality: str,
) -> StreamingQuery:
    """Append a stream to a table and keep each batch's expectation counts under ``quality``.

    A batch goes to a folder of its own, so a retry replaces it instead of adding to it.
    """

    claim(stream.sparkSession, path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        counted, seen = expect_all(batch, expectations)
        counted.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        report = observed_report(batch.sparkSession, dataset, expectations, seen)
        keep_counts(report, dataset, quality, batch_id)

    return for_each_batch(stream, write, checkpoint)


def claim(spark: SparkSession, table: str, checkpoint: str) -> None:
    """Bind a table whose folders have a checkpoint's batch numbers to that checkpoint.

    Another one would count from zero again and take old batches' places: ValueError.
    """
    store = Store(spark, table)
    ours, theirs = f"{checkpoint.rstrip('/')}/_owner", f"{table.rstrip('/')}/_owner"
    mine, owner = (store.children(p) if store.exists(p) else [] for p in (ours, theirs))
    if owner and owner != mine:
        raise ValueError(f"{table} belongs to another checkpoint than {checkpoint}")
    if not owner:
        name = mine[0] if mine else uuid.uuid4().hex
        store.make(f"{ours}/{name}")
        store.make(f"{theirs}/{name}")


def keep_counts(report: DataFrame, dataset: str, quality: str, batch_id: int) -> None:
    """Store one batch's counts under ``quality``, once: a retry leaves them as they are.

    Every ``MERGED_COUNTS`` batches the folders before are added into the newest, whose ``since`` says so, and
    removed. ``read_counts`` leaves out what a lost run did not get to remove.
    """
    spark = report.sparkSession
    folder = f"{quality}/source={dataset}"
    store, target = Store(spark, folder), f"{folder}/batch={batch_id}"
    if store.exists(target):
        return
    earlier = _batches(store, folder)
    merged = len(earlier) >= MERGED_COUNTS
    if merged:
        held = read_counts(spark, quality).where(F.col("source") == dataset)
        report = (
            report.unionByName(held.select(*report.columns))
            .groupBy("dataset", "expectation")
            .agg(F.sum("total_rows").alias("total_rows"), F.sum("failed_rows").alias("failed_rows"))
        )
    since = min(earlier) if merged else batch_id
    staged = hidden(folder)
    report.withColumn("since", F.lit(since)).coalesce(1).write.parquet(staged)
    store.move(staged, target)
    if merged:
        for number in earlier:
            store.remove(f"{folder}/batch={number}")


def replace_counts(report: DataFrame, dataset: str, quality: str) -> None:
    """Store the counts of a table that is rebuilt each time, in place of those before."""
    folder = f"{quality}/source={dataset}/batch=0"
    report.withColumn("since", F.lit(0)).coalesce(1).write.mode("overwrite").parquet(folder)


def _batches(store: Store, folder: str) -> list[int]:
    names = store.children(folder) if store.exists(folder) else []
    return [int(n.partition("=")[2]) for n in names if n.startswith("batch=")]


def read_counts(spark: SparkSession, quality: str) -> DataFrame:
    """All counts under ``quality``, each batch's once: dataset, expectation, rows, and source, batch, since."""
    counts = spark.read.parquet(quality)
    merged = counts.groupBy("source").agg(
        F.max(F.when(F.col("since") < F.col("batch"), F.col("batch"))).alias("newest")
    )
    return counts.join(F.broadcast(merged), "source").where(
        F.col("newest").isNull() | (F.col("batch") >= F.col("newest"))
    ).drop("newest")


def for_each_batch(
    stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    query = (
        stream.writeStream.foreachBatch(step)
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .start()
    )
    query.awaitTermination()
    return query
