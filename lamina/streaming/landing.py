"""Streams into versioned tables: numbered parts, merged as they add up.

Each batch lands as a part of its own, numbered like the batch, so a retry writes over it or finds it
listed and leaves it. A stream reads the landed parts and never sees merged ones; a batch read takes the
live partitions, whichever they are. Partitions that many parts share are written anew as one, so that
their number of files follows their rows and not the number of runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lamina.columns import col
from lamina.sources.tables import create_table
from lamina.sources.versions import FROM, PART, Versions
from lamina.streaming.tables import claim, for_each_batch

LANDED, MERGED = "landed", "merged"
#: Parts of a partition that are merged into one.
FAN = 8


def land(
    stream: DataFrame, path: str, checkpoint: str, layout: T.StructType
) -> StreamingQuery:
    """Append what is new in ``stream`` to the versioned table at ``path``, partitioned by ``layout``."""
    spark = stream.sparkSession
    claim(spark, path, checkpoint)
    create_table(spark, landed_folder(path), T.StructType([*stream.schema.fields]).add(PART, "long"), [PART, *layout.names])

    def write(batch: DataFrame, batch_id: int) -> None:
        table = Versions(batch.sparkSession, path, layout)
        listed = table.live().where((F.col(FROM) == LANDED) & (F.col(PART) == batch_id))
        if listed.isEmpty():
            table.publish(batch, origin=LANDED, part=batch_id)

    return for_each_batch(stream, write, checkpoint)


def landed_folder(path: str) -> str:
    return f"{path.rstrip('/')}/rows/{FROM}={LANDED}"


def read_landed_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """What landed since the last run of the same query."""
    reader = spark.readStream.schema(T.StructType([*schema.fields]).add(PART, "long"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(landed_folder(path)).drop(PART)


def merge_parts(
    spark: SparkSession, path: str, schema: T.StructType, layout: T.StructType, fan: int = FAN, keep: int = 2
) -> int:
    """Write partitions that ``fan`` parts or more share anew, as one part; how many there were.

    To be called when the streams that read the table have run: what is merged, and is in none of the last
    ``keep`` versions, is removed.
    """
    table = Versions(spark, path, layout)
    live = table.live()
    parts = live.groupBy(*[col(n) for n in layout.names]).agg(F.count(F.lit(1)).alias("parts"))
    # A small list that both reads and the anti-join below see alike.
    crowded = spark.createDataFrame(
        parts.where(F.col("parts") >= fan).select(*[col(n) for n in layout.names]).collect(), layout
    )
    many = crowded.count()
    if many:
        chosen = live.join(crowded, table.same_place(live, crowded), "left_semi")
        table.publish(table.read_partitions(schema, chosen), replaced=crowded, origin=MERGED)
    table.clean(keep)
    return many
