"""Change feeds made from tables that do not keep one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.columns import col, free_name
from lamina.operators.heavy import HOT_ROWS, heavy_keys, skew_join
from lamina.schemas import DELETE, INSERT, UPDATE_POSTIMAGE, UPDATE_PREIMAGE

# Copies of a row are made in steps of this many, so that no array grows with their number.
COPIES = 10_000


def diff_snapshots(
    before: DataFrame, after: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """What turned ``before`` into ``after``, as the table's columns and ``_change_type``.

    Rows that both hold are dropped by grouping the union on all columns, so each snapshot is shuffled
    once and a repeated key never pairs up. Of a row that one side has more often, the surplus
    counts. A key with rows gone and rows new was updated; with only one of them, deleted or inserted.
    Hot keys are looked for among the snapshots' own keys, before anything is shuffled.
    """
    keys = list(keys)
    columns = before.columns
    kept = [col(c) for c in columns]
    more, updated, step, copy = (
        free_name(n, before) for n in ("more", "updated", "step", "copy")
    )
    counted = (
        before.select(*kept, F.lit(-1).alias(more))
        .unionByName(after.select(*kept, F.lit(1).alias(more)))
        .groupBy(*kept)
        .agg(F.sum(more).alias(more))
        .where(F.col(more) != 0)
    )
    whole = F.sequence(F.lit(0), F.floor((F.abs(more) - 1) / COPIES))
    rest = F.least(F.abs(more) - F.col(step) * COPIES, F.lit(COPIES))
    changed = (
        counted.withColumn(step, F.explode(whole))
        .withColumn(copy, F.explode(F.sequence(F.lit(1), rest.cast("int"))))
        .select(*kept, F.col(more))
    )
    both = (
        counted.groupBy(*[col(k) for k in keys])
        .agg(F.min(more).alias(step), F.max(more).alias(copy))
        .where((F.col(step) < 0) & (F.col(copy) > 0))
        .select(*[col(k) for k in keys], F.lit(True).alias(updated))
    )
    change = (
        F.when((F.col(more) < 0) & F.col(updated), F.lit(UPDATE_PREIMAGE))
        .when(F.col(more) < 0, F.lit(DELETE))
        .when(F.col(updated), F.lit(UPDATE_POSTIMAGE))
        .otherwise(F.lit(INSERT))
    )
    own_keys = [col(k) for k in keys]
    hot = heavy_keys(before.select(*own_keys).union(after.select(*own_keys)), keys, hot_rows)
    joined = (
        changed.join(both, keys, "left")
        if hot is None
        else skew_join(changed, both, keys, "left", hot_rows, hot)
    )
    return joined.select(*kept, change.alias("_change_type"))


def append_changes(rows: DataFrame) -> DataFrame:
    """The feed of an append: every row an insert."""
    return rows.withColumn("_change_type", F.lit(INSERT))


def overwrite_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """The feed of an overwrite: every old row deleted and every new row inserted, equal or not."""
    return before.withColumn("_change_type", F.lit(DELETE)).unionByName(
        append_changes(after), allowMissingColumns=True
    )
