"""Type 2 history from a change log.

One row per version of a key, valid from ``__START_AT`` up to but not including ``__END_AT``; the open
version has a null ``__END_AT``. The order of arrival does not matter, only the sequence column.

Rules where a log leaves room:

* pre-images of updates are dropped;
* of several changes to a key at one sequence value an upsert beats a delete, then the greatest tie
  columns win, so a replayed log gives the same history;
* a change that leaves every stored column as it was opens no new version, unless
  ``collapse_unchanged`` is off;
* nulls overwrite, unless their columns are named in ``ignore_nulls``: an upsert then leaves what the
  key last held in these columns since it was last deleted. Of changes at one place only the winner
  counts here too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.columns import col, none_null, quoted
from lamina.operators.heavy import HOT_ROWS, heavy_keys, parts
from lamina.schemas import UPDATE_PREIMAGE
from lamina.session import work_dir

START, END = "__START_AT", "__END_AT"
# Sampled sequence values per wanted chunk of a hot key, from which the cuts are chosen.
SAMPLES_PER_CHUNK = 32


def current(history: DataFrame) -> DataFrame:
    """Only the open versions."""
    return history.where(F.col(END).isNull())


def rejected_changes(changes: DataFrame, keys: Sequence[str], sequence_by: str) -> DataFrame:
    """The changes that no history can hold: a null in the key or in the sequence."""
    return changes.where(~_usable(keys, sequence_by))


def scd2_history(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    apply_as_deletes: str | None = None,
    except_column_list: Sequence[str] = (),
    tie_columns: Sequence[str] = (),
    collapse_unchanged: bool = True,
    change_type: str = "operation_type",
    hot_rows: int | None = HOT_ROWS,
    hot_from: DataFrame | None = None,
    ignore_nulls: bool | Sequence[str] = False,
) -> DataFrame:
    """Keys, stored columns, ``__START_AT`` and ``__END_AT`` of every version.

    ``ignore_nulls`` names the stored columns in which a null leaves the value that was there; True
    means all of them.

    Keys above ``hot_rows`` changes are cut into stretches of their own sequence, worked on separately
    and joined up at the edges (None: never). They are looked for in ``changes``, or in ``hot_from``, a
    table that has the key columns at less cost.
    """
    keys = list(keys)
    skip = {*keys, *except_column_list}
    stored = [c for c in changes.columns if c not in skip]
    kept = _kept_columns(ignore_nulls, stored)
    log = _prepare(changes, keys, sequence_by, apply_as_deletes, stored, tie_columns, change_type)
    hot = heavy_keys(log if hot_from is None else hot_from, keys, hot_rows)
    if hot is None:
        return _finish(_whole_keys(log, keys, collapse_unchanged, kept), keys, stored)
    usual = log.join(hot.select(*_cols(keys)), keys, "left_anti")
    versions = _whole_keys(usual, keys, collapse_unchanged, kept).unionByName(
        _cut_keys(log, hot, keys, collapse_unchanged, hot_rows, kept)
    )
    return _finish(versions, keys, stored)


def _kept_columns(ignore_nulls: bool | Sequence[str], stored: list[str]) -> list[str]:
    if isinstance(ignore_nulls, bool):
        return stored if ignore_nulls else []
    unknown = [c for c in ignore_nulls if c not in stored]
    if unknown:
        raise ValueError(f"not stored columns: {', '.join(unknown)}")
    return list(ignore_nulls)


def _cols(names: Sequence[str]) -> list[Column]:
    return [col(n) for n in names]


def _usable(keys: Sequence[str], sequence_by: str) -> Column:
    return none_null([*keys, sequence_by])


def _prepare(
    changes: DataFrame,
    keys: list[str],
    sequence_by: str,
    apply_as_deletes: str | None,
    stored: Sequence[str],
    tie_columns: Sequence[str],
    change_type: str,
) -> DataFrame:
    """The log as keys, ``__seq`` and ``__change``; of changes at one place the greatest wins.

    Stored columns stay inside a struct, so that the names used here cannot meet theirs.
    """
    if change_type in changes.columns:
        changes = changes.where(
            F.coalesce(col(change_type) != UPDATE_PREIMAGE, F.lit(True))
        )
    deleted = (
        F.coalesce(F.expr(apply_as_deletes), F.lit(False)) if apply_as_deletes else F.lit(False)
    )
    ties = [col(c).alias(f"tie_{i}") for i, c in enumerate(tie_columns)]
    # A table of keys alone still needs a state that differs from that of a delete.
    payload = F.struct(*_cols(stored)) if stored else F.struct(F.lit(True).alias("present"))
    return changes.where(_usable(keys, sequence_by)).select(
        *_cols(keys),
        col(sequence_by).alias("__seq"),
        F.struct((~deleted).alias("upsert"), *ties, payload.alias("payload")).alias("__change"),
    )


def _state() -> Column:
    """What a change leaves: its stored columns, or null after a delete."""
    return F.when(F.col("__change.upsert"), F.col("__change.payload")).alias("__state")


def _told(kept: Sequence[str]) -> Column:
    """For each kept column what a change says of it: a value in a struct, or nothing.

    A delete says of each that there is no value.
    """
    says = []
    for i, c in enumerate(kept):
        value = F.col("__state").getField(c)
        said = F.col("__state").isNull() | value.isNotNull()
        says.append(F.when(said, F.struct(value.alias("value"))).alias(f"c{i}"))
    return F.struct(*says)


def _last_told(told: str, kept: Sequence[str], window) -> Column:
    """The last that was said of each kept column up to the window's end."""
    return F.struct(
        *[F.last(F.col(told)[f"c{i}"], True).over(window).alias(f"c{i}") for i in range(len(kept))]
    )


def _filled(known: Column, kept: Sequence[str]) -> Column:
    """The state with its kept columns as they were last known."""
    state = F.col("__state")
    for i, c in enumerate(kept):
        state = state.withField(quoted(c), known[f"c{i}"]["value"])
    return F.when(F.col("__state").isNotNull(), state).alias("__state")


def _whole_keys(
    log: DataFrame, keys: list[str], collapse: bool, kept: Sequence[str] = ()
) -> DataFrame:
    """Versions of keys that fit a task: one shuffle and one sort serve all the windows."""
    ties = Window.partitionBy(*_cols(keys), "__seq").orderBy(F.desc("__change"))
    line = Window.partitionBy(*_cols(keys)).orderBy("__seq")
    winners = (
        log.repartition(*_cols(keys))
        .withColumn("__tie", F.row_number().over(ties))
        .where("__tie = 1")
        .select(*_cols(keys), "__seq", _state())
    )
    if kept:
        so_far = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        known = winners.withColumn("__told", _told(kept)).withColumn(
            "__known", _last_told("__told", kept, so_far)
        )
        winners = known.select(*_cols(keys), "__seq", _filled(F.col("__known"), kept))
    return (
        _mark(winners, line, collapse)
        .where("__changed")
        .withColumn("__until", F.lead("__seq").over(line))
        .select(*_cols(keys), "__seq", "__state", "__until")
    )


def _mark(winners: DataFrame, line, collapse: bool) -> DataFrame:
    """Flag the first row of a line and every row whose state differs from the one before."""
    first = F.lag("__seq").over(line).isNull()
    same = F.lag("__state").over(line).eqNullSafe(F.col("__state")) if collapse else F.lit(False)
    marked = winners.withColumn("__first", first)
    return marked.withColumn("__same", same).withColumn("__changed", F.expr("__first OR NOT __same"))


def _carry_over(winners: DataFrame, keys: list[str], kept: Sequence[str]) -> DataFrame:
    """``winners`` with kept columns filled, within each stretch and from the stretches before.

    What a stretch ends with is one small row, as in ``_edges``.
    """
    line = Window.partitionBy(*_cols(keys), "__chunk").orderBy("__seq")
    so_far = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = winners.withColumn("__told", _told(kept)).withColumn(
        "__known", _last_told("__told", kept, so_far)
    )
    ends = known.groupBy(*_cols(keys), "__chunk").agg(F.max_by("__known", "__seq").alias("__held"))
    before = (
        Window.partitionBy(*_cols(keys))
        .orderBy("__chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inherited = ends.withColumn("__inherited", _last_told("__held", kept, before)).drop("__held")
    own = F.struct(
        *[
            F.coalesce(F.col("__known")[f"c{i}"], F.col("__inherited")[f"c{i}"]).alias(f"c{i}")
            for i in range(len(kept))
        ]
    )
    return known.join(inherited, [*keys, "__chunk"]).select(
        *_cols(keys), "__chunk", "__seq", _filled(own, kept)
    )


def _cut_keys(
    log: DataFrame,
    hot: DataFrame,
    keys: list[str],
    collapse: bool,
    hot_rows: int,
    kept: Sequence[str] = (),
) -> DataFrame:
    """Versions of hot keys. No task sees more than a stretch of one key.

    Their changes are stored once, since cuts, stretches and edges all read them. Ties fall to a grouped
    maximum on the way, so that many changes at one instant shrink before the shuffle.
    """
    path = work_dir(log.sparkSession, "hot_changes")
    log.join(hot.select(*_cols(keys)), keys).groupBy(*_cols(keys), "__seq").agg(
        F.max("__change").alias("__change")
    ).write.mode("overwrite").parquet(path)
    held = log.sparkSession.read.schema(log.schema).parquet(path)
    winners = (
        held.join(_cuts(held, hot, keys, hot_rows), keys)
        .withColumn("__chunk", _chunk_of(F.col("__cuts"), F.col("__seq")))
        .select(*_cols(keys), "__chunk", "__seq", _state())
    )
    if kept:
        winners = _carry_over(winners, keys, kept)
    line = Window.partitionBy(*_cols(keys), "__chunk").orderBy("__seq")
    marked = _mark(winners, line, collapse)
    edges = _edges(marked, keys, collapse)
    opens = F.expr("IF(__first, __opens, NOT __same)")
    return (
        marked.join(edges, [*keys, "__chunk"])
        .where(opens)
        .withColumn("__until", F.coalesce(F.lead("__seq").over(line), F.col("__next_seq")))
        .select(*_cols(keys), "__seq", "__state", "__until")
    )


def _cuts(log: DataFrame, hot: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """For each hot key the sequence values at which its stretches begin, evenly filled.

    The cuts come from a sample picked by hash, the same on every evaluation; they steer balance
    only. There are at most ``rows / hot_rows`` in all.
    """
    wanted = hot.select(*_cols(keys), "hot_n", parts(hot_rows).alias("__chunks")).withColumn(
        "__step", F.expr(f"greatest(1, hot_n DIV (__chunks * {SAMPLES_PER_CHUNK}))")
    )
    sample = (
        log.select(*_cols(keys), "__seq")
        .join(wanted, keys)
        .where(F.expr("pmod(xxhash64(__seq), __step) = 0"))
        .groupBy(*_cols(keys))
        .agg(F.array_sort(F.collect_set("__seq")).alias("__sample"))
    )
    cuts = F.expr(
        "CASE WHEN __sample IS NULL THEN NULL"
        " WHEN size(__sample) <= __chunks THEN __sample"
        " ELSE transform(sequence(1, __chunks - 1), i -> __sample["
        "CAST(CAST(i AS BIGINT) * size(__sample) DIV __chunks AS INT)]) END"
    )
    return wanted.join(sample, keys, "left").select(*_cols(keys), cuts.alias("__cuts"))


# Halving steps for up to 16 million cuts of one key.
CUT_STEPS = tuple(1 << bit for bit in range(23, -1, -1))


def _chunk_of(cuts: Column, seq: Column) -> Column:
    """How many cuts lie at or below ``seq``: a binary search by halving steps."""
    return F.aggregate(
        F.array(*[F.lit(step) for step in CUT_STEPS]),
        F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - 1) <= seq, at + step).otherwise(at),
    )


def _edges(marked: DataFrame, keys: list[str], collapse: bool) -> DataFrame:
    """One row per stretch: does its first row open a version, and when does the next stretch open one."""
    ends = marked.groupBy(*_cols(keys), "__chunk").agg(
        F.min("__seq").alias("__first_seq"),
        F.min_by("__state", "__seq").alias("__first_state"),
        F.max_by("__state", "__seq").alias("__last_state"),
        F.min(F.when(F.expr("NOT __first AND NOT __same"), F.col("__seq"))).alias("__inner_seq"),
    )
    forward = Window.partitionBy(*_cols(keys)).orderBy("__chunk")
    # Later stretches come first in this order, which keeps the frame growing.
    later = (
        Window.partitionBy(*_cols(keys))
        .orderBy(F.desc("__chunk"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = F.lag("__chunk").over(forward).isNull()
    if collapse:
        starts = starts | ~F.lag("__last_state").over(forward).eqNullSafe(F.col("__first_state"))
    else:
        starts = F.lit(True)
    opened = ends.withColumn("__opens", starts).withColumn(
        "__open_seq", F.expr("IF(__opens, __first_seq, __inner_seq)")
    )
    return opened.withColumn("__next_seq", F.min("__open_seq").over(later)).select(
        *_cols(keys), "__chunk", "__opens", "__next_seq"
    )


def _finish(versions: DataFrame, keys: list[str], stored: Sequence[str]) -> DataFrame:
    """Drop the deletes, which served only to close versions, and spread the state out."""
    return versions.where(F.col("__state").isNotNull()).select(
        *_cols(keys),
        *[F.col("__state").getField(c).alias(c) for c in stored],
        F.col("__seq").alias(START),
        F.col("__until").alias(END),
    )
