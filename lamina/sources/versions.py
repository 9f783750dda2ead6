"""Tables whose readers see one whole state, on plain Parquet.

Rows lie in numbered parts, ``rows/_from=<origin>/_part=<number>/<layout>``, which are never changed once
they are listed. A version is the list of the live partitions of all parts, a small table of its own below
``versions``; it appears by one move, after its rows are complete. So a reader that starts from a list sees
all of a run or nothing of it, a run that is lost leaves the version before, and running it again writes
over what it left. One writer at a time. The driver holds one row for each live partition it reads, as it
does for the folders of any partitioned table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.columns import col, quoted, sql_text
from lamina.sources.files import Store, hidden

FROM, PART = "_from", "_part"
#: The folder of a null in a partition column, as Spark names it.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class Versions:
    """A table at ``path``; ``layout`` are its partition columns and their types."""

    def __init__(self, spark: SparkSession, path: str, layout: T.StructType | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.layout = T.StructType([]) if layout is None else layout
        self.rows, self.lists = f"{self.path}/rows", f"{self.path}/versions"
        self.listed = T.StructType(
            [T.StructField(FROM, T.StringType()), T.StructField(PART, T.LongType()), *self.layout.fields]
        )
        self.store = Store(spark, self.path)

    def numbers(self) -> list[int]:
        """The versions that can be read, oldest first."""
        if not self.store.exists(self.lists):
            return []
        return sorted(int(n) for n in self.store.children(self.lists) if n.isdigit())

    def current(self) -> int | None:
        return max(self.numbers(), default=None)

    def live(self, version: int | None = None) -> DataFrame:
        """The live partitions of a version, the newest by default."""
        version = self.current() if version is None else version
        if version is None:
            return self.spark.createDataFrame([], self.listed)
        return self.spark.read.schema(self.listed).parquet(f"{self.lists}/{version}")

    def folder(self, row: Row) -> str:
        """Where a live partition lies."""
        parts = [f"{f.name}={NULL_FOLDER if row[f.name] is None else row[f.name]}" for f in self.listed]
        return "/".join([self.rows, *parts])

    def read(
        self, schema: T.StructType, where: Column | None = None, version: int | None = None
    ) -> DataFrame:
        """The rows, columns of ``schema``, of the live partitions, or of those that ``where`` names."""
        partitions = self.live(version)
        if where is None:
            return self.read_partitions(schema, partitions)
        return self.read_partitions(schema, partitions.where(where)).where(where)

    def read_partitions(self, schema: T.StructType, partitions: DataFrame) -> DataFrame:
        """The rows of ``partitions``, some rows of a list, and of no other folder."""
        rows = partitions.collect()
        if not rows:
            return self.spark.createDataFrame([], schema)
        data = [f for f in schema if f.name not in self.layout.names]
        typed = T.StructType([*data, *self.listed.fields])
        reader = self.spark.read.schema(typed).option("basePath", self.rows)
        return reader.parquet(*[self.folder(r) for r in rows]).select(*[col(f.name) for f in schema])

    def same_place(self, a: DataFrame, b: DataFrame) -> Column:
        """Equal in all partition columns, nulls included."""
        return reduce(and_, [a[n].eqNullSafe(b[n]) for n in self.layout.names], F.lit(True))

    def publish(
        self,
        rows: DataFrame | None,
        replaced: Column | DataFrame | None = None,
        origin: str = "rows",
        part: int | None = None,
    ) -> int:
        """A new version: the live partitions but for ``replaced``, and ``rows``.

        ``replaced`` is a condition on the partition columns, or a table of them; without it all stay. A
        part is numbered like its version, unless ``part`` is given.
        """
        current = self.current()
        number = 0 if current is None else current + 1
        part = number if part is None else part
        kept = self.live(current)
        if isinstance(replaced, DataFrame):
            kept = kept.join(replaced, self.same_place(kept, replaced), "left_anti")
        elif replaced is not None:
            kept = kept.where(~F.coalesce(replaced, F.lit(False)))
        if rows is not None:
            kept = kept.unionByName(self._write(rows, origin, part))
        self._list(kept, number)
        return number

    def _write(self, rows: DataFrame, origin: str, part: int) -> DataFrame:
        """Store a part, and the list of its partitions. Small ones share a task, large ones take several."""
        names = [quoted(f.name) for f in self.layout]
        path = f"{self.rows}/{FROM}={origin}/{PART}={part}"
        if names:
            rows = rows.hint("rebalance", *names)
        rows.write.mode("overwrite").partitionBy(*[f.name for f in self.layout]).parquet(path)
        data = T.StructType([f for f in rows.schema if f.name not in self.layout.names])
        written = self.spark.read.schema(T.StructType([*data.fields, *self.layout.fields])).parquet(path)
        return (
            written.select(*names).distinct()
            if names
            else self.spark.range(1).select()
        ).select(
            F.lit(origin).alias(FROM), F.lit(part).cast("long").alias(PART), *[col(f.name) for f in self.layout]
        )

    def _list(self, partitions: DataFrame, number: int) -> None:
        """The last step: from here on readers see the version."""
        staged = hidden(self.lists)
        partitions.coalesce(1).write.parquet(staged)
        self.store.move(staged, f"{self.lists}/{number}")

    def clean(self, keep: int = 2) -> None:
        """Remove all versions but the last ``keep``, and the partitions that only these had live.

        Readers of an older version fail; the driver receives one row for each partition that goes.
        """
        numbers = self.numbers()
        old, held = numbers[:-keep], numbers[-keep:]
        if not old:
            return
        gone, stay = (self._union(n) for n in (old, held))
        same = [gone[f.name].eqNullSafe(stay[f.name]) for f in self.listed]
        for row in gone.join(stay, same, "left_anti").distinct().collect():
            self.store.remove(self.folder(row))
        for number in old:
            self.store.remove(f"{self.lists}/{number}")

    def _union(self, numbers: Sequence[int]) -> DataFrame:
        return self.spark.read.schema(self.listed).parquet(*[f"{self.lists}/{n}" for n in numbers])


def refresh_view(df: DataFrame, path: str, keep: int = 2) -> None:
    """Rebuild a gold view in full. Readers have the old one until the new is complete."""
    table = Versions(df.sparkSession, path)
    table.publish(df, replaced=F.lit(True))
    table.clean(keep)


def view_folder(spark: SparkSession, path: str) -> str:
    """The folder of a view's newest rows."""
    table = Versions(spark, path)
    row = table.live().first()
    if row is None:
        raise FileNotFoundError(f"{path} has no version")
    return table.folder(row)


def read_view(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(view_folder(spark, path))


def show_version(
    spark: SparkSession,
    name: str,
    table: Versions,
    comment: str = "",
    properties: dict[str, str] | None = None,
) -> None:
    """Have the name ``name`` show a table's newest version; its readers change over at once.

    A table without rows as yet gets no name.
    """
    number = table.current()
    if number is None or table.live(number).isEmpty():
        return
    columns = [FROM, PART, *table.layout.names]
    same = " AND ".join(f"r.{quoted(c)} <=> l.{quoted(c)}" for c in columns)
    pairs = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in (properties or {}).items())
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} COMMENT {sql_text(comment)}"
        + (f" TBLPROPERTIES ({pairs})" if pairs else "")
        + f" AS SELECT * EXCEPT ({FROM}, {PART}) FROM parquet.`{table.rows}` r"
        f" LEFT SEMI JOIN parquet.`{table.lists}/{number}` l ON {same}"
    )
