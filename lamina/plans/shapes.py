"""The test tables seen as accounts, customers, transactions and a change feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# The test tables' columns. Without them each read starts a job to look at a file's footer.
SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,"
    " c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,"
    " l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,"
    " p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE,"
    " props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account per customer."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS acct_id",
        "c_name AS acct_name",
        "c_acctbal AS balance",
        "'open' AS acct_status",
        "c_mktsegment AS acct_type",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer per account; the places of nations 0 to 9 have one digit and fail their rule."""
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('1000000', c_custkey) AS customer_id",
        "c_custkey AS acct_id",
        "CAST(c_nationkey AS STRING) AS state_cd",
        "25.0D + c_nationkey AS latitude",
        "-120.0D + c_nationkey AS longitude",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per line item. Their ids repeat."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey")
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_brand")
    return (
        lines.join(orders, "l_orderkey")
        .join(parts, "l_partkey")
        .selectExpr(
            "concat(l_orderkey, '-', l_linenumber) AS transaction_id",
            "o_custkey AS acct_id",
            "p_brand AS ticker_symbol",
            "l_quantity AS quantity",
            "l_quantity AS total_holdings",
            "l_extendedprice AS total_amt",
            "l_shipdate AS transaction_date",
        )
    )


def account_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts as often as they have orders: where the transactions' hot accounts show at less cost."""
    return table(spark, sf_dir, "orders").selectExpr("o_custkey AS acct_id")


def transaction_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions' ids without the joins."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS transaction_id"
    )


def as_history(open_rows: DataFrame, outdated: Column) -> DataFrame:
    """An SCD2 table: the rows as open versions, and before each a closed one with other columns."""
    closed = open_rows.withColumn("acct_id", outdated).withColumn(
        "__END_AT", F.lit("2024-01-01 00:00:00").cast("timestamp")
    )
    return open_rows.withColumn("__END_AT", F.lit(None).cast("timestamp")).unionByName(closed)


def exact(transactions: DataFrame) -> DataFrame:
    """Amounts as decimals, whose sums do not depend on the order of the rows."""
    return transactions.withColumn("total_amt", F.col("total_amt").cast("decimal(18,2)"))


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change feed keyed by user. Commits are whole hours, so changes of a user tie."""
    return (
        table(spark, sf_dir, "events")
        .withColumn("_commit_timestamp", F.expr("date_trunc('HOUR', CAST(ts AS TIMESTAMP))"))
        .selectExpr(
            "user_id",
            "event_id",
            "CAST(floor(value / 25) AS INT) AS band",
            "CASE event_type WHEN 'signup' THEN 'insert' WHEN 'view' THEN 'update_preimage'"
            " WHEN 'error' THEN 'delete' ELSE 'update_postimage' END AS _change_type",
            "timestampdiff(HOUR, TIMESTAMP'2024-01-01', _commit_timestamp) AS _commit_version",
            "_commit_timestamp",
        )
    )
