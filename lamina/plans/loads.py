"""The made-up source loads: a first one, then one that overwrites and appends."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lamina import schemas
from lamina.functions import synth
from lamina.plans.refresh import Folders


@dataclass(frozen=True)
class Sizes:
    """Row counts; accounts from ``hot_first`` on get the second, denser batch of transactions."""

    accounts: int = 1000
    transactions: int = 8000
    hot_transactions: int = 2000
    hot_first: int = 100
    hot_count: int = 20
    changed: int = 10
    changed_first: int = 10001
    partitions: int = 4


def ticker_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in synth.TICKERS], "ticker STRING")


def _sources(folders: Folders):
    return (
        folders.source("src_accounts", schemas.ACCOUNTS),
        folders.source("src_customer", schemas.CUSTOMER),
        folders.source("src_acct_tx", schemas.TRANSACTIONS),
    )


def initial_load(
    spark: SparkSession, folders: Folders, tickers: DataFrame, timestamp, sizes: Sizes = Sizes()
) -> None:
    """One customer per account, and two batches of transactions whose ids both start at 0."""
    accounts, customers, tx = _sources(folders)
    ids = synth.row_ids(spark, sizes.accounts, sizes.partitions)
    accounts.append(synth.accounts(ids, 1, 1, sizes.accounts), 0, timestamp)
    customers.append(synth.customers(ids, 1, 1, sizes.accounts), 0, timestamp)
    ids = synth.row_ids(spark, sizes.transactions, sizes.partitions)
    tx.append(synth.transactions(ids, tickers, 1, 1, sizes.accounts), 0, timestamp)
    append_hot(spark, folders, tickers, 1, timestamp, sizes)


def append_hot(
    spark: SparkSession, folders: Folders, tickers: DataFrame, version: int, timestamp, sizes: Sizes
) -> None:
    """Transactions on a few accounts."""
    ids = synth.row_ids(spark, sizes.hot_transactions, sizes.partitions)
    rows = synth.transactions(ids, tickers, 1, sizes.hot_first, sizes.hot_count)
    _sources(folders)[2].append(rows, version, timestamp)


def change_load(
    spark: SparkSession, folders: Folders, tickers: DataFrame, timestamp, later, sizes: Sizes = Sizes()
) -> None:
    """All three tables overwritten by a few new rows at ``timestamp``; then transactions appended at
    ``later`` on accounts that are gone by then."""
    accounts, customers, tx = _sources(folders)
    first, count = sizes.changed_first, sizes.changed
    ids = synth.row_ids(spark, count, sizes.partitions)
    accounts.overwrite(synth.accounts(ids, 10001, first, count), 2, timestamp)
    customers.overwrite(synth.customers(ids, 1001, first, count), 2, timestamp)
    tx.overwrite(synth.transactions(ids, tickers, 1001, first, count), 2, timestamp)
    append_hot(spark, folders, tickers, 3, later, sizes)
