"""An SCD2 table kept up to date from a bronze stream.

Both tables are partitioned twice: by a bucket of the keys, and by a period. Bronze has the period of a
change's sequence value; the history has that of a version's end, or ``open``. A run finds the oldest
change it got for each bucket and goes back to the start of that period, the cut. Versions that ended
before the cut cannot change. All others of the bucket are derived again from the bronze rows since
the cut and from the versions that reach over it, and take the place of their partitions in the next
version of the table. So a run costs what the touched buckets hold in recent periods and in open versions,
however long the history is; a late change costs more, and ends in the same history. Readers see the
history before or after a run, and never a mix of both.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lamina.columns import col, free_name, quoted
from lamina.operators.bronze import add_bucket
from lamina.operators.heavy import HOT_ROWS
from lamina.operators.quality import expect_all, observed_report
from lamina.operators.scd2 import END, START, scd2_history
from lamina.rules import ChangeFlow
from lamina.schemas import INSERT, UPDATE_PREIMAGE
from lamina.sources.files import Store, replace_folder
from lamina.sources.versions import Versions
from lamina.streaming.landing import read_landed_stream
from lamina.streaming.tables import for_each_batch, keep_counts

BUCKET, PERIOD = "_bucket", "_period"
OPEN = "open"
LAYOUT = [BUCKET, PERIOD]
PLACES = T.StructType().add(BUCKET, "integer").add(PERIOD, "string")
UNITS = ("DAY", "WEEK", "MONTH", "QUARTER", "YEAR")
LAYOUT_SCHEMA = T.StructType().add("buckets", "integer").add("unit", "string")


def period_of(moment: str, kind: T.DataType, unit: str) -> Column:
    """The first day of the period a column lies in, as text, which sorts like the time and before
    ``open``. Instants are taken in UTC: the folders must not depend on a session's time zone."""
    day = col(moment).cast("date")
    if isinstance(kind, T.TimestampType):
        days = F.floor(F.unix_seconds(col(moment)) / F.lit(86400)).cast("int")
        day = F.date_add(F.lit("1970-01-01").cast("date"), days)
    unit = checked_unit(unit)
    return (day if unit == "DAY" else F.trunc(day, unit)).cast("string")


def checked_unit(unit: str) -> str:
    """One of ``UNITS``, whatever its case; anything else raises ValueError."""
    if unit.upper() not in UNITS:
        raise ValueError(f"a period is one of {', '.join(UNITS)}, not {unit!r}")
    return unit.upper()


def keep_layout(spark: SparkSession, target: str, buckets: int, unit: str) -> None:
    """Store a table's buckets and unit beside it, or raise ValueError if it has others."""
    path = f"{target.rstrip('/')}_layout"
    asked = (buckets, checked_unit(unit))
    if Store(spark, path).exists(path):
        held = tuple(spark.read.schema(LAYOUT_SCHEMA).parquet(path).first())
        if held != asked:
            raise ValueError(f"{target} has (buckets, unit) {held}, not {asked}")
        return
    row = spark.createDataFrame([asked], LAYOUT_SCHEMA).coalesce(1)
    replace_folder(spark, path, lambda fresh: row.write.parquet(fresh))


def place_changes(
    bronze: DataFrame, flow: ChangeFlow, buckets: int, unit: str = "MONTH"
) -> DataFrame:
    """Bronze with the two columns by which it must be partitioned.

    ``unit`` is one of ``UNITS``, in any case.
    """
    period = period_of(flow.sequence_by, bronze.schema[flow.sequence_by].dataType, unit)
    return add_bucket(bronze, flow.keys, buckets, BUCKET).withColumn(PERIOD, period)


def placed_schema(schema: T.StructType) -> T.StructType:
    """The schema of a placed table, to read it back."""
    return T.StructType([*schema.fields]).add(BUCKET, "integer").add(PERIOD, "string")


def history_schema(bronze: T.StructType, flow: ChangeFlow) -> T.StructType:
    """The columns of the SCD2 table that a flow makes of a bronze table."""
    skip = {*flow.keys, *flow.except_column_list, *LAYOUT}
    stored = [f for f in bronze.fields if f.name not in skip]
    moment = bronze[flow.sequence_by].dataType
    fields = [*[bronze[k] for k in flow.keys], *stored]
    return T.StructType(fields).add(START, moment).add(END, moment)


def read_history(
    spark: SparkSession,
    path: str,
    bronze: T.StructType,
    flow: ChangeFlow,
    only_current: bool = False,
    version: int | None = None,
) -> DataFrame:
    """The versions of every key, as the table's newest ``version`` or an older one has them.

    ``only_current`` gives the open versions and reads nothing else.
    """
    where = F.col(PERIOD) == OPEN if only_current else None
    placed = placed_schema(history_schema(bronze, flow))
    return Versions(spark, path, PLACES).read(placed, where, version).drop(*LAYOUT)


def apply_changes(
    stream: DataFrame,
    bronze: str,
    target: str,
    checkpoint: str,
    flow: ChangeFlow,
    buckets: int,
    unit: str = "MONTH",
    quality: str | None = None,
    tie_columns: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
    collapse_unchanged: bool = True,
    beside: Sequence[str] = (),
    keep: int = 2,
) -> StreamingQuery:
    """Bring the SCD2 table at ``target`` up to date with the bronze table at ``bronze``.

    ``stream`` reads what lands in that same bronze table, which is the truth, together with the bronze
    tables ``beside`` it that other flows bring in. Late changes, replays and batches that run a second time
    all end in the history that a single run would give. The last ``keep`` versions of the table stay
    readable. The flow's sequence must be a date or a time; ``buckets`` and ``unit`` are those of
    ``place_changes`` and stay the same for the table's life: other ones than the table was made with raise
    ValueError, and a batch whose rows lie elsewhere than they say fails before it writes anything.
    """
    unit = checked_unit(unit)
    keep_layout(stream.sparkSession, target, buckets, unit)
    entering = f"coalesce(operation_type <> '{UPDATE_PREIMAGE}', true)"
    upserts = f"{entering} AND NOT coalesce({flow.apply_as_deletes or 'false'}, false)"
    # Rows without a key or a place in the sequence enter no history; they are counted.
    usable = " AND ".join(f"{quoted(c)} IS NOT NULL" for c in (*flow.keys, flow.sequence_by))
    placing = {"has_key_and_sequence": usable}
    schema = stream.schema
    moment = schema[flow.sequence_by].dataType
    placed_history = placed_schema(history_schema(schema, flow))

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counted, seen = expect_all(batch, flow.expectations, only=upserts)
        counted, seen_keys = expect_all(counted, placing, only=entering)
        cuts = _cuts(counted.where(f"{entering} AND {usable}"), flow, buckets, unit)
        if cuts:
            since = _since(cuts)
            table = Versions(spark, target, PLACES)
            history = table.read(placed_history, since)
            log = _carried(history, cuts, flow, period_of(START, moment, unit))
            for path in (bronze, *beside):
                landed = Versions(spark, path, PLACES).read(schema, since)
                log = log.unionByName(landed, allowMissingColumns=True)
            versions = scd2_history(
                log.select(*[col(f.name) for f in schema]),
                flow.keys,
                flow.sequence_by,
                flow.apply_as_deletes,
                [*flow.except_column_list, *LAYOUT],
                tie_columns,
                collapse_unchanged=collapse_unchanged,
                hot_rows=hot_rows,
                ignore_nulls=flow.ignore_null_updates,
            )
            ends = F.coalesce(period_of(END, moment, unit), F.lit(OPEN))
            placed = add_bucket(versions, flow.keys, buckets, BUCKET).withColumn(PERIOD, ends)
            table.publish(placed, replaced=since)
            table.clean(keep)
        if quality:
            report = observed_report(spark, flow.name, flow.expectations, seen)
            unplaced = observed_report(spark, flow.name, placing, seen_keys)
            keep_counts(report.unionByName(unplaced), flow.name, quality, batch_id)

    return for_each_batch(stream, apply, checkpoint)


def apply_flows(
    spark: SparkSession,
    flows: dict[str, str],
    schema: T.StructType,
    target: str,
    checkpoints: str,
    flow: ChangeFlow,
    buckets: int,
    unit: str = "MONTH",
    only: Sequence[str] | None = None,
    max_files: int | None = None,
    **options,
) -> None:
    """Several named flows into one history: ``flows`` are their bronze tables, columns ``schema``, by name.

    Each flow has its own offsets, below ``checkpoints``, and counts under its own name. ``only`` says which
    are to run; in any order and number of runs, once all have run the history is that of all changes in one
    log. A flow that is added later starts with its first change. All bronze tables are placed alike.
    """
    for name in flows if only is None else only:
        others = [path for other, path in flows.items() if other != name]
        apply_changes(
            read_landed_stream(spark, flows[name], schema, max_files),
            flows[name],
            target,
            f"{checkpoints.rstrip('/')}/{name}",
            replace(flow, name=f"{flow.name}_{name}"),
            buckets,
            unit,
            beside=others,
            **options,
        )


def _cuts(
    changes: DataFrame, flow: ChangeFlow, buckets: int, unit: str
) -> dict[str, list[int]]:
    """The period to go back to, and the buckets that go back to it: one small row per bucket.

    Raises ValueError if a row has no period, or lies in another bucket or period than it should.
    """
    bucket, period = (free_name(n, changes) for n in ("own_bucket", "own_period"))
    kind = changes.schema[flow.sequence_by].dataType
    placed = add_bucket(changes, flow.keys, buckets, bucket).withColumn(
        period, period_of(flow.sequence_by, kind, unit)
    )
    in_place = (F.col(BUCKET) == F.col(bucket)) & (F.col(PERIOD) == F.col(period))
    rows = (
        placed.groupBy(BUCKET)
        .agg(
            F.min(PERIOD).alias(PERIOD),
            F.count_if(~F.coalesce(in_place, F.lit(False))).alias("misplaced"),
        )
        .collect()
    )
    misplaced = sum(row["misplaced"] for row in rows)
    if misplaced:
        raise ValueError(f"{misplaced} rows of bronze aren't placed by {buckets} buckets and {unit}")
    cuts = defaultdict(list)
    for row in rows:
        cuts[row[PERIOD]].append(row[BUCKET])
    return dict(cuts)


def _since(cuts: dict[str, list[int]]) -> Column:
    """Touched buckets from their cut on; a condition on partition columns, so the rest is not read."""
    condition = F.lit(False)
    for period, touched in cuts.items():
        condition = condition | (F.col(BUCKET).isin(touched) & (F.col(PERIOD) >= period))
    return condition


def _carried(
    history: DataFrame, cuts: dict[str, list[int]], flow: ChangeFlow, starts: Column
) -> DataFrame:
    """The versions that reach over the cut, as inserts at their start."""
    before_cut = F.lit(False)
    for period, touched in cuts.items():
        before_cut = before_cut | (F.col(BUCKET).isin(touched) & (starts < period))
    return (
        history.where(before_cut)
        .withColumn(flow.sequence_by, F.col(START))
        .withColumn("operation_type", F.lit(INSERT))
        .drop(START, END, *LAYOUT)
    )
