"""Gold views over the silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators.heavy import HOT_ROWS, heavy_keys, skew_join
from lamina.operators.latest import latest_per_group


def cust_tran_profile(
    accounts: DataFrame,
    customers: DataFrame,
    transactions: DataFrame,
    created_at: Column | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Per customer and account: number, value and dates of the transactions, and tickers traded.

    Pass open versions of accounts and customers; all transactions passed are counted. Each table is
    grouped before the joins: one row per account for the transactions, and counts of equal rows for
    the other two, which multiply the totals as the joined rows would have. The joins thus meet no
    account's transactions, and their result needs no further grouping.
    """
    traded = (
        transactions.where(F.col("acct_id").isNotNull())
        .groupBy("acct_id")
        .agg(
            F.count("*").alias("tx_count"),
            F.sum("total_amt").alias("tx_value"),
            F.min("transaction_date").alias("first_transaction_date"),
            F.max("transaction_date").alias("latest_transaction_date"),
            F.count_distinct("ticker_symbol").alias("count_distinct_tickers_traded"),
        )
    )
    held = accounts.groupBy("acct_id", "acct_status", "balance").agg(
        F.count("*").alias("acct_copies")
    )
    holders = customers.groupBy("acct_id", "customer_id").agg(F.count("*").alias("cust_copies"))
    copies = F.col("acct_copies") * F.col("cust_copies")
    profile = skew_join(
        holders, held.join(traded, "acct_id"), ["acct_id"], hot_rows=hot_rows
    ).select(
        "customer_id",
        "acct_id",
        "acct_status",
        "balance",
        (F.col("tx_count") * copies).alias("total_transactions"),
        (F.col("tx_value") * copies).cast("double").alias("total_transactions_value"),
        "first_transaction_date",
        "latest_transaction_date",
        "count_distinct_tickers_traded",
    )
    return _stamped(profile, "profile_created_at", created_at)


# The same view as SQL, over the histories of accounts and customers and the transactions.
PROFILE_SQL = """
WITH traded AS (
  SELECT
    acct_id,
    COUNT(*) AS tx_count,
    SUM(total_amt) AS tx_value,
    MIN(transaction_date) AS first_date,
    MAX(transaction_date) AS latest_date,
    COUNT(DISTINCT ticker_symbol) AS tickers
  FROM {transactions}
  WHERE acct_id IS NOT NULL
  GROUP BY ALL
),
held AS (
  SELECT acct_id, acct_status, balance, COUNT(*) AS copies
  FROM {accounts}
  WHERE __END_AT IS NULL
  GROUP BY ALL
),
holders AS (
  SELECT acct_id, customer_id, COUNT(*) AS copies
  FROM {customers}
  WHERE __END_AT IS NULL
  GROUP BY ALL
)
SELECT
  c.customer_id,
  a.acct_id,
  a.acct_status,
  a.balance,
  t.tx_count * a.copies * c.copies AS total_transactions,
  CAST(t.tx_value * a.copies * c.copies AS DOUBLE) AS total_transactions_value,
  t.first_date AS first_transaction_date,
  t.latest_date AS latest_transaction_date,
  t.tickers AS count_distinct_tickers_traded
  {stamp}
FROM held AS a
INNER JOIN holders AS c ON a.acct_id = c.acct_id
INNER JOIN traded AS t ON a.acct_id = t.acct_id
"""


def cust_tran_profile_sql(
    spark: SparkSession,
    accounts: DataFrame,
    customers: DataFrame,
    transactions: DataFrame,
    stamp: bool = False,
) -> DataFrame:
    """``cust_tran_profile`` in SQL, with the same grouping before the joins.

    Accounts and customers are SCD2 tables, of which the open versions count; all transactions passed
    do. ``stamp`` adds ``profile_created_at``.
    """
    text = PROFILE_SQL.replace(
        "{stamp}", ", current_timestamp() AS profile_created_at" if stamp else ""
    )
    return spark.sql(text, accounts=accounts, customers=customers, transactions=transactions)


PAIR = ["acct_id", "ticker_symbol"]


def ticker_dist_geo(
    customers: DataFrame,
    transactions: DataFrame,
    created_at: Column | None = None,
    hot_rows: int | None = HOT_ROWS,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """The latest holdings per account and ticker with the place of the account's customers.

    Hot accounts are looked for on both sides: among ``transactions`` (or ``hot_from``, a table with
    their ``acct_id`` at less cost), and among customers, where many may share an account.
    """
    columns = ["acct_id", "ticker_symbol", "transaction_date", "total_holdings"]
    # Without a hot account there is no hot pair of account and ticker either.
    hot = heavy_keys(transactions if hot_from is None else hot_from, ["acct_id"], hot_rows)
    crowded = heavy_keys(customers, ["acct_id"], hot_rows)
    if hot is None:
        latest = latest_per_group(transactions.select(*columns), PAIR, "transaction_date", None)
    else:
        # The ids tell equal rows apart, which spreads them.
        columns += [c for c in ("transaction_id",) if c in transactions.columns]
        latest = latest_per_group(transactions.select(*columns), PAIR, "transaction_date", hot_rows)

    def place(rows: DataFrame, people: DataFrame) -> DataFrame:
        if hot is None:
            return rows.join(people, "acct_id")
        return skew_join(rows, people, ["acct_id"], hot_rows=hot_rows, hot=hot)

    if crowded is None:
        placed = place(latest, customers)
    else:
        # An account has one row for each ticker, so its customers are the side to spread.
        full = crowded.select("acct_id")
        spread = skew_join(
            customers.join(full, "acct_id", "left_semi"),
            latest.join(full, "acct_id", "left_semi"),
            ["acct_id"],
            hot_rows=hot_rows,
            hot=crowded,
        )
        usual = place(latest, customers.join(full, "acct_id", "left_anti"))
        placed = usual.unionByName(spread)
    places = placed.select(
        "customer_id",
        "acct_id",
        "ticker_symbol",
        F.col("total_holdings").cast("double").alias("total_holdings"),
        "state_cd",
        "longitude",
        "latitude",
    )
    return _stamped(places, "geo_analysis_created_at", created_at)


def _stamped(df: DataFrame, name: str, when: Column | None) -> DataFrame:
    return df if when is None else df.withColumn(name, when)
