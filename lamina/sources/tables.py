"""Tables as Parquet folders: append, overwrite, read, register."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.columns import col, sql_text
from lamina.operators.diff import append_changes, overwrite_changes
from lamina.schemas import DELETE, INSERT, change_feed
from lamina.sources.changelog import write_commit
from lamina.sources.files import Store


def create_table(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()
) -> None:
    """An empty table, unless there is one."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").partitionBy(*partition_by).parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Add rows; columns new to the table are allowed, see ``read_table``."""
    df.write.mode("append").parquet(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace the table. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)


def is_path(table: str) -> bool:
    """Whether a table is given as a folder; a name in the catalog has no slash."""
    return "/" in table


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A batch read of a folder or of a table by its name in the catalog.

    Without a schema the files' schemas are merged, missing columns null.
    """
    if not is_path(path):
        table = spark.table(path)
        return table if schema is None else table.to(schema)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_append_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """The rows added to a table since the last run of the same query; a folder or a table's name."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path if is_path(path) else table_folder(spark, path))


def table_folder(spark: SparkSession, name: str) -> str:
    """Where a registered table's files lie."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def ticker_list(spark: SparkSession, table: str, column: str = "ticker") -> DataFrame:
    """A dimension column of a registered table, as a table."""
    return spark.table(table).select(column)


@dataclass(frozen=True)
class SourceTable:
    """A source table that records its own changes: rows at ``path``, its feed at ``log``.

    The log is the truth. The rows of a change are worked out once, for the commit; the table's files are
    made from the stored commit, so both hold the same rows. A commit's files are written aside, and are
    moved in when all are there; a marker for each commit says that it is in. What a lost run left undone
    ``mend`` finishes, which each change does first: no commit is left out, and none comes in twice.
    """

    path: str
    log: str
    schema: T.StructType

    def append(self, df: DataFrame, version: int, timestamp) -> None:
        """Add rows; the commit holds them as inserts."""
        self.mend(df.sparkSession)
        write_commit(append_changes(df.to(self.schema)), self.log, version, timestamp)
        self.bring_in(df.sparkSession, version)

    def overwrite(self, df: DataFrame, version: int, timestamp) -> None:
        """Replace the rows; the commit deletes the old ones and inserts the new."""
        spark = df.sparkSession
        self.mend(spark)
        before = read_table(spark, self.path, self.schema)
        # The feed reads the old rows, so it goes first.
        feed = overwrite_changes(before, df.to(self.schema))
        write_commit(feed, self.log, version, timestamp)
        self.bring_in(spark, version)

    def mend(self, spark: SparkSession) -> list[int]:
        """Bring in the commits that the log has and the table lacks, in their order; gives their versions."""
        store = Store(spark, self.path)
        held = set(store.children(self._done)) if store.exists(self._done) else set()
        there = store.children(self.log) if store.exists(self.log) else []
        versions = sorted(int(n.partition("=")[2]) for n in there if n.startswith("_commit_version="))
        lacking = [v for v in versions if str(v) not in held]
        for version in lacking:
            self.bring_in(spark, version)
        return lacking

    def bring_in(self, spark: SparkSession, version: int) -> None:
        """Carry commit ``version`` over to the table's files, from wherever a lost run stopped.

        A commit that deletes rows is one that replaced the table. Its old files go before its own come,
        so a batch read in between sees fewer rows; a stream sees each file once.
        """
        store = Store(spark, self.path)
        if store.exists(f"{self._done}/{version}"):
            return
        staged, own = f"{self.path}/_commit-{version}", f"commit-{version}-"
        # Once some files have moved, the others must be those of the same write.
        if not store.exists(f"{staged}/_ready"):
            self._changed(spark, version, INSERT).write.mode("overwrite").parquet(staged)
            store.make(f"{staged}/_ready")
        if self._changed(spark, version, DELETE).limit(1).count():
            for name in store.children(self.path):
                if not name.startswith(("_", ".", own)):
                    store.remove(f"{self.path}/{name}")
        for name in store.children(staged):
            if not name.startswith(("_", ".")):
                store.move(f"{staged}/{name}", f"{self.path}/{own}{name}")
        store.make(f"{self._done}/{version}")
        store.remove(staged)

    @property
    def _done(self) -> str:
        return f"{self.path}/_commits"

    def _changed(self, spark: SparkSession, version: int, kind: str) -> DataFrame:
        commit = spark.read.schema(change_feed(self.schema)).parquet(
            f"{self.log}/_commit_version={version}"
        )
        return commit.where(F.col("_change_type") == kind).select(*[col(f.name) for f in self.schema])


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    comment: str | None = None,
    properties: dict[str, str] | None = None,
) -> None:
    """Give a Parquet folder a table name, a comment and properties in the catalog."""
    spark.catalog.createTable(name, path=path, source="parquet", description=comment or "")
    if properties:
        pairs = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def table_properties(spark: SparkSession, name: str) -> DataFrame:
    """The properties set on a registered table."""
    return spark.sql(f"SHOW TBLPROPERTIES {name}")
