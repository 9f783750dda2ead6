"""The two pipelines, each one call: bronze, silver, gold, in the order of their data.

A call takes in what is new since the last one. A full refresh is a call with a new ``run`` name: the
layers are rebuilt from the sources in folders of their own, and the old ones stay readable meanwhile. The
run that ended last is the one that ``Folders.live`` gives, and that the names in the catalog show.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import rules, schemas
from lamina.operators.append import append_silver, append_transactions
from lamina.operators.bronze import enrich_changes
from lamina.operators.heavy import HOT_ROWS
from lamina.operators.quality import expect_all, observed_report
from lamina.plans.gold import cust_tran_profile, ticker_dist_geo
from lamina.sources.changelog import read_change_stream
from lamina.sources.tables import SourceTable, read_append_stream, register_table
from lamina.sources.versions import Versions, read_view, refresh_view, show_version
from lamina.streaming.history import (
    PLACES,
    apply_changes,
    keep_layout,
    place_changes,
    placed_schema,
    read_history,
)
from lamina.streaming.landing import land, merge_parts, read_landed_stream
from lamina.streaming.tables import (
    BATCH,
    read_counts,
    replace_counts,
    stream_to_table,
    stream_with_quality,
)


#: The run of folders that no refresh has ended in.
NO_RUN = ""


@dataclass(frozen=True)
class Folders:
    """Where the tables of one pipeline lie, below a base every executor can reach."""

    base: str
    run: str = "run"

    def source(self, name: str, schema: T.StructType) -> SourceTable:
        return SourceTable(f"{self.base}/source/{name}", f"{self.base}/log/{name}", schema)

    def at(self, layer: str, name: str) -> str:
        return f"{self.base}/{self.run}/{layer}/{name}"

    @property
    def quality(self) -> str:
        return f"{self.base}/{self.run}/quality"

    def full_refresh(self, run: str) -> Folders:
        return replace(self, run=run)

    def cut_over(self, spark: SparkSession) -> None:
        """Make this run the one that readers are given."""
        if self.live(spark).run != self.run:
            refresh_view(spark.createDataFrame([(self.run,)], "run STRING"), f"{self.base}/live")

    def live(self, spark: SparkSession) -> Folders:
        """The folders of the run that readers are given; its name is empty before any has ended."""
        if Versions(spark, f"{self.base}/live").current() is None:
            return replace(self, run=NO_RUN)
        return replace(self, run=read_view(spark, f"{self.base}/live").first()["run"])


# Per table: its name, columns, flow, and the name under which bronze knows the source.
CDC_TABLES = (
    ("src_accounts", schemas.ACCOUNTS, rules.ACCOUNTS_FLOW, "accounts"),
    ("src_customer", schemas.CUSTOMER, rules.CUSTOMERS_FLOW, "customer"),
    ("src_acct_tx", schemas.TRANSACTIONS, rules.TRANSACTIONS_FLOW, "transactions"),
)
COORDINATES = {"longitude": "double", "latitude": "double"}


def refresh_cdc(
    spark: SparkSession,
    folders: Folders,
    buckets: int,
    unit: str = "MONTH",
    current_transactions_only: bool = False,
    hot_rows: int | None = HOT_ROWS,
    register_as: str | None = None,
) -> DataFrame:
    """Change feeds through bronze into SCD2 tables and the profile over their open versions.

    Every version of a transaction counts, unless ``current_transactions_only``. With ``register_as``,
    a database, all tables get names, comments and properties there. Another ``unit`` or number of
    ``buckets`` than the tables have raises ValueError before anything is written.
    """
    for _, _, flow, _ in CDC_TABLES:
        keep_layout(spark, folders.at("silver", flow.name), buckets, unit)
    for name, schema, flow, source_file in CDC_TABLES:
        bronze = folders.at("bronze", name)
        feed = read_change_stream(spark, folders.source(name, schema).log, schema)
        casts = COORDINATES if source_file == "customer" else None
        land(
            place_changes(enrich_changes(feed, source_file, casts), flow, buckets, unit),
            bronze,
            folders.at("checkpoints", f"{name}_bronze"),
            PLACES,
        )
        placed = placed_schema(schemas.bronze(schema))
        apply_changes(
            read_landed_stream(spark, bronze, placed),
            bronze,
            folders.at("silver", flow.name),
            folders.at("checkpoints", f"{flow.name}_cdc_flow"),
            flow,
            buckets,
            unit,
            folders.quality,
            hot_rows=hot_rows,
        )
        merge_parts(spark, bronze, placed, PLACES)
    only_current = (True, True, current_transactions_only)
    accounts, customers, tx = (
        read_history(
            spark, folders.at("silver", flow.name), schemas.bronze(schema), flow, only_open
        )
        for (_, schema, flow, _), only_open in zip(CDC_TABLES, only_current)
    )
    profile = cust_tran_profile(accounts, customers, tx, F.current_timestamp(), hot_rows)
    gold = _refresh_gold(folders, "cust_tran_profile", profile, rules.PROFILE)
    folders.cut_over(spark)
    if register_as:
        for name, _, flow, _ in CDC_TABLES:
            _show(spark, folders, register_as, "bronze", name, PLACES)
            _show(spark, folders, register_as, "silver", flow.name, PLACES)
        _show(spark, folders, register_as, "gold", "cust_tran_profile")
    return gold


def refresh_append(
    spark: SparkSession,
    folders: Folders,
    hot_rows: int | None = HOT_ROWS,
    register_as: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """New rows of the sources through plain bronze copies into stamped silver and two views."""
    steps = (
        ("src_accounts", schemas.ACCOUNTS, "accounts", rules.ACCOUNTS),
        ("src_customer", schemas.CUSTOMER, "customers", rules.CUSTOMERS),
        ("src_acct_tx", schemas.TRANSACTIONS, "transactions", rules.TRANSACTIONS_APPEND),
    )
    stamped = {
        "accounts": lambda df: append_silver(df, doubles=["balance"]),
        "customers": lambda df: append_silver(df, doubles=["longitude", "latitude"]),
        "transactions": append_transactions,
    }
    silver = {}
    for name, schema, target, expectations in steps:
        bronze = folders.at("bronze", name)
        stream_to_table(
            read_append_stream(spark, folders.source(name, schema).path, schema),
            bronze,
            folders.at("checkpoints", f"{name}_bronze"),
        )
        path = folders.at("silver", target)
        stream_with_quality(
            stamped[target](read_append_stream(spark, bronze, schema)),
            path,
            folders.at("checkpoints", target),
            target,
            expectations,
            folders.quality,
        )
        silver[target] = spark.read.parquet(path).drop(BATCH)
    accounts = silver["accounts"].where("is_current")
    customers = silver["customers"].where("is_current")
    now = F.current_timestamp()
    profile = cust_tran_profile(accounts, customers, silver["transactions"], now, hot_rows)
    geo = ticker_dist_geo(customers, silver["transactions"], now, hot_rows)
    views = (
        _refresh_gold(folders, "cust_tran_profile", profile, rules.PROFILE),
        _refresh_gold(folders, "ticker_dist_geo", geo, rules.GEO),
    )
    folders.cut_over(spark)
    if register_as:
        for name, _, target, _ in steps:
            _register(spark, folders, register_as, "bronze", name)
            _register(spark, folders, register_as, "silver", target)
        for view in ("cust_tran_profile", "ticker_dist_geo"):
            _show(spark, folders, register_as, "gold", view)
    return views


def _register(spark: SparkSession, folders: Folders, database: str, layer: str, name: str) -> None:
    """Name a table of the pipeline ``database.layer_name``, unless that name is taken."""
    full = f"{database}.{layer}_{name}"
    if not spark.catalog.tableExists(full):
        register_table(
            spark, full, folders.at(layer, name), rules.COMMENTS[layer], rules.PROPERTIES[layer]
        )
    if any(c.isPartition for c in spark.catalog.listColumns(full)):
        spark.catalog.recoverPartitions(full)


def _show(
    spark: SparkSession,
    folders: Folders,
    database: str,
    layer: str,
    name: str,
    layout: T.StructType | None = None,
) -> None:
    """Have ``database.layer_name`` show the newest version of a table, all at once."""
    table = Versions(spark, folders.at(layer, name), layout)
    show_version(
        spark, f"{database}.{layer}_{name}", table, rules.COMMENTS[layer], rules.PROPERTIES[layer]
    )


def _refresh_gold(
    folders: Folders, name: str, view: DataFrame, expectations: dict[str, str]
) -> DataFrame:
    counted, seen = expect_all(view, expectations)
    path = folders.at("gold", name)
    refresh_view(counted, path)
    report = observed_report(view.sparkSession, name, expectations, seen)
    replace_counts(report, name, folders.quality)
    return read_view(view.sparkSession, path)


def quality_report(spark: SparkSession, folders: Folders) -> DataFrame:
    """What every dataset's expectations have counted, summed over the batches."""
    counts = read_counts(spark, folders.quality).groupBy("dataset", "expectation")
    return counts.agg(
        F.sum("total_rows").alias("total_rows"), F.sum("failed_rows").alias("failed_rows")
    )
