"""The registered queries: each operator over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lamina import rules
from lamina.functions.hashing import record_hash
from lamina.functions import synth
from lamina.operators.append import append_silver, append_transactions
from lamina.operators.bronze import enrich_changes, enrich_changes_sql
from lamina.operators.diff import diff_snapshots
from lamina.operators.latest import latest_per_group
from lamina.operators.quality import expectation_report
from lamina.operators.scd2 import current, rejected_changes, scd2_history
from lamina.operators.validate import count_spread, missing_keys
from lamina.plans import shapes
from lamina.plans.gold import cust_tran_profile, cust_tran_profile_sql, ticker_dist_geo
from lamina.schemas import CHANGE_COLUMNS
from lamina.schemas import bronze as bronze_schema
from lamina.session import work_dir
from lamina.sources.changelog import read_change_stream, read_changes, write_commits
from lamina.sources.tables import SourceTable, append_table, read_append_stream, read_table
from lamina.sources.versions import Versions
from lamina.streaming.history import (
    LAYOUT,
    PLACES,
    apply_changes,
    apply_flows,
    place_changes,
    placed_schema,
    read_history,
)
from lamina.streaming.landing import land, merge_parts, read_landed_stream
from lamina.streaming.tables import BATCH, read_counts, stream_with_quality

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

USERS_FLOW = rules.ChangeFlow(
    "users",
    ("user_id",),
    rules.FEED_COLUMNS + ("event_id",),
    {"low_band": "band < 3", "even_event": "event_id % 2 = 0"},
)
USER_BUCKETS = 8
# The middle of the feed's thirty daily commits.
HALF_WAY = 15


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        REGISTRY[name] = run
        return run

    return register


def _users_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_changes(shapes.change_feed(spark, sf_dir), "accounts", stamp=False)


def _daily_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = shapes.change_feed(spark, sf_dir)
    return feed.withColumn("_commit_version", F.floor(F.col("_commit_version") / 24))


def _users_history(changes: DataFrame) -> DataFrame:
    return scd2_history(
        changes,
        USERS_FLOW.keys,
        USERS_FLOW.sequence_by,
        USERS_FLOW.apply_as_deletes,
        USERS_FLOW.except_column_list,
        tie_columns=["event_id"],
    )


def _profile_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        shapes.accounts(spark, sf_dir),
        shapes.customers(spark, sf_dir),
        shapes.exact(shapes.transactions(spark, sf_dir)),
    )


# Bronze


@query("bronze_accounts")
def bronze_accounts(spark, sf_dir):
    return _users_bronze(spark, sf_dir)


@query("bronze_accounts_sql")
def bronze_accounts_sql(spark, sf_dir):
    feed = shapes.change_feed(spark, sf_dir)
    return enrich_changes_sql(feed, "accounts").drop("ingestion_timestamp")


def _customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates arrive as text."""
    text = {c: F.col(c).cast("string") for c in ("latitude", "longitude")}
    return shapes.customers(spark, sf_dir).withColumns(
        {
            **text,
            "_change_type": F.lit("insert"),
            "_commit_version": F.lit(0).cast("bigint"),
            "_commit_timestamp": F.lit("2024-01-01 00:00:00").cast("timestamp"),
        }
    )


@query("bronze_customer")
def bronze_customer(spark, sf_dir):
    feed = _customer_feed(spark, sf_dir)
    return enrich_changes(
        feed, "customer", casts={"longitude": "double", "latitude": "double"}, stamp=False
    )


@query("bronze_customer_sql")
def bronze_customer_sql(spark, sf_dir):
    casts = {"longitude": "DOUBLE", "latitude": "DOUBLE"}
    return enrich_changes_sql(_customer_feed(spark, sf_dir), "customer", casts).drop(
        "ingestion_timestamp"
    )


def _tx_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.transactions(spark, sf_dir).withColumns(
        {
            "_change_type": F.lit("insert"),
            "_commit_version": F.year("transaction_date").cast("bigint"),
            "_commit_timestamp": F.col("transaction_date"),
        }
    )


@query("bronze_tx")
def bronze_tx(spark, sf_dir):
    return enrich_changes(_tx_feed(spark, sf_dir), "transactions", stamp=False)


@query("bronze_tx_sql")
def bronze_tx_sql(spark, sf_dir):
    return enrich_changes_sql(_tx_feed(spark, sf_dir), "transactions").drop("ingestion_timestamp")


@query("bronze_from_version")
def bronze_from_version(spark, sf_dir):
    """A stored log read from a version on: the commits before it are other partitions, never read."""
    base = work_dir(spark, "from_version")
    feed = _daily_commits(spark, sf_dir)
    write_commits(feed, f"{base}/log")
    log = read_changes(spark, f"{base}/log", feed.drop(*CHANGE_COLUMNS).schema, HALF_WAY)
    return enrich_changes(log, "accounts", stamp=False)


@query("rejected_changes")
def rejected(spark, sf_dir):
    """Changes that name no key: here a user is known by having signed up."""
    feed = _users_bronze(spark, sf_dir).withColumn(
        "user_id", F.when(F.col("operation_type") != "delete", F.col("user_id"))
    )
    return rejected_changes(feed, ["user_id"], "commit_timestamp")


# Change feeds from snapshots


def _orders_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Old pending orders are finished, low ones among the finished dropped, urgent open ones rekeyed."""
    before = shapes.table(spark, sf_dir, "orders")
    dropped = F.expr("o_orderpriority = '5-LOW' AND o_orderstatus = 'F'")
    after = before.where(~dropped).withColumns(
        {
            "o_orderkey": F.expr(
                "IF(o_orderpriority = '1-URGENT' AND o_orderstatus = 'O',"
                " o_orderkey + 1000000000, o_orderkey)"
            ),
            "o_orderstatus": F.expr(
                "IF(o_orderstatus = 'P' AND o_orderdate < TIMESTAMP_NTZ'1998-01-01 00:00:00',"
                " 'F', o_orderstatus)"
            ),
        }
    )
    return before, after


@query("cdf_diff")
def cdf_diff(spark, sf_dir):
    return diff_snapshots(*_orders_snapshots(spark, sf_dir), ["o_orderkey"])


@query("diff_column_names")
def diff_column_names(spark, sf_dir):
    """The same diff over columns that are called like the operator's own."""
    names = {
        "o_orderkey": "order key",
        "o_custkey": "updated",
        "o_orderstatus": "gone",
        "o_totalprice": "more",
        "o_orderdate": "was",
        "o_orderpriority": "hot_salt",
    }
    before, after = (d.withColumnsRenamed(names) for d in _orders_snapshots(spark, sf_dir))
    back = {new: old for old, new in names.items()}
    return diff_snapshots(before, after, ["order key"], hot_rows=1).withColumnsRenamed(back)


@query("overwrite_feed")
def overwrite_feed(spark, sf_dir):
    """The stored feed of a table that was loaded and then overwritten."""
    base = work_dir(spark, "overwrite_feed")
    before, after = _orders_snapshots(spark, sf_dir)
    table = SourceTable(f"{base}/table", f"{base}/log", before.schema)
    table.append(before, 0, "2024-01-01 00:00:00")
    table.overwrite(after, 1, "2024-01-02 00:00:00")
    return read_changes(spark, f"{base}/log", before.schema)


@query("schema_merge_append")
def schema_merge_append(spark, sf_dir):
    """Suppliers appended to a table of customers, with a column the table did not have."""
    path = work_dir(spark, "schema_merge")
    append_table(shapes.accounts(spark, sf_dir), path)
    suppliers = shapes.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("acct_id"),
        F.col("s_name").alias("acct_name"),
        F.col("s_acctbal").alias("balance"),
        F.col("s_nationkey").alias("nation"),
    )
    append_table(suppliers, path)
    return read_table(spark, path).select(
        "acct_id", "acct_name", "balance", "acct_status", "acct_type", "nation"
    )


# Silver


@query("append_silver")
def append_silver_accounts(spark, sf_dir):
    silver = append_silver(shapes.accounts(spark, sf_dir), doubles=["balance"])
    return silver.where("is_current").drop("__START_AT")


@query("append_silver_customers")
def append_silver_customers(spark, sf_dir):
    """Coordinates that arrive as text."""
    text = {c: F.col(c).cast("string") for c in ("latitude", "longitude")}
    customers = shapes.customers(spark, sf_dir).withColumns(text)
    silver = append_silver(customers, doubles=["longitude", "latitude"])
    return silver.where("is_current").drop("__START_AT")


@query("append_tx")
def append_tx(spark, sf_dir):
    silver = append_transactions(shapes.transactions(spark, sf_dir))
    return silver.withColumn("transaction_date", F.col("transaction_date").cast("string"))


@query("scd2_history")
def scd2_users(spark, sf_dir):
    return _users_history(_users_bronze(spark, sf_dir))


@query("scd2_current")
def scd2_current(spark, sf_dir):
    return current(_users_history(_users_bronze(spark, sf_dir))).drop("__END_AT")


@query("scd2_out_of_order")
def scd2_out_of_order(spark, sf_dir):
    """Days that arrive in another order than they happened, through the incremental history."""
    base = work_dir(spark, "out_of_order")
    feed = shapes.change_feed(spark, sf_dir).withColumn(
        "_commit_version", F.pmod(7 * F.floor(F.col("_commit_version") / 24), F.lit(3))
    )
    columns = feed.drop(*CHANGE_COLUMNS).schema
    for version in (1, 0, 2):
        write_commits(feed.where(F.col("_commit_version") == version), f"{base}/log")
        history = run_users_pipeline(spark, base, columns, 1000, 1000)
    return history


@query("scd2_hot_keys")
def scd2_hot_keys(spark, sf_dir):
    """The same history with every user treated as a hot key."""
    return scd2_history(
        _users_bronze(spark, sf_dir),
        USERS_FLOW.keys,
        USERS_FLOW.sequence_by,
        USERS_FLOW.apply_as_deletes,
        USERS_FLOW.except_column_list,
        tie_columns=["event_id"],
        hot_rows=20,
    )


@query("scd2_every_change")
def scd2_every_change(spark, sf_dir):
    """Versions of unchanged rows kept."""
    return scd2_history(
        _users_bronze(spark, sf_dir),
        USERS_FLOW.keys,
        USERS_FLOW.sequence_by,
        USERS_FLOW.apply_as_deletes,
        USERS_FLOW.except_column_list,
        tie_columns=["event_id"],
        collapse_unchanged=False,
    )


def _sparse_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users' changes as updates of single columns: what an update doesn't touch is null."""
    band = F.when(F.col("event_id") % 3 > 0, F.col("band"))
    grade = F.when(F.col("event_id") % 5 > 1, F.col("event_id") % 4)
    return _users_bronze(spark, sf_dir).withColumns({"band": band, "grade": grade})


def _sparse_history(changes: DataFrame, hot_rows: int | None) -> DataFrame:
    return scd2_history(
        changes,
        USERS_FLOW.keys,
        USERS_FLOW.sequence_by,
        USERS_FLOW.apply_as_deletes,
        USERS_FLOW.except_column_list,
        tie_columns=["event_id"],
        hot_rows=hot_rows,
        ignore_nulls=True,
    )


@query("scd2_ignore_nulls")
def scd2_ignore_nulls(spark, sf_dir):
    """A null leaves the value that was there."""
    return _sparse_history(_sparse_feed(spark, sf_dir), None)


@query("scd2_ignore_nulls_hot")
def scd2_ignore_nulls_hot(spark, sf_dir):
    """The same with most keys cut into stretches."""
    return _sparse_history(_sparse_feed(spark, sf_dir), 5)


@query("scd2_tx")
def scd2_tx(spark, sf_dir):
    tx = shapes.transactions(spark, sf_dir)
    return scd2_history(
        tx,
        ["transaction_id"],
        "transaction_date",
        except_column_list=["transaction_date"],
        hot_from=shapes.transaction_keys(spark, sf_dir),
    )


@query("scd2_composite_key")
def scd2_composite_key(spark, sf_dir):
    """Orders by customer and priority: a key of two columns, deleted when an order is finished."""
    orders = shapes.table(spark, sf_dir, "orders")
    return scd2_history(
        orders,
        ["o_custkey", "o_orderpriority"],
        "o_orderdate",
        apply_as_deletes="o_orderstatus = 'F'",
        except_column_list=["o_orderdate", "o_orderkey"],
        tie_columns=["o_orderkey"],
    )


# Streams


def run_users_pipeline(
    spark: SparkSession,
    base: str,
    columns: StructType,
    log_files: int,
    bronze_files: int,
    quality: str | None = None,
) -> DataFrame:
    """What is new in the users' log, through bronze into their history."""
    log = read_change_stream(spark, f"{base}/log", columns, max_files=log_files)
    bronze = place_changes(enrich_changes(log, "accounts"), USERS_FLOW, USER_BUCKETS, "WEEK")
    land(bronze, f"{base}/bronze", f"{base}/checkpoints/bronze", PLACES)
    schema = placed_schema(bronze_schema(columns))
    apply_changes(
        read_landed_stream(spark, f"{base}/bronze", schema, bronze_files),
        f"{base}/bronze",
        f"{base}/silver",
        f"{base}/checkpoints/silver",
        USERS_FLOW,
        buckets=USER_BUCKETS,
        unit="WEEK",
        quality=quality,
        tie_columns=["event_id"],
    )
    return read_history(spark, f"{base}/silver", schema, USERS_FLOW)


@query("stream_scd2")
def stream_scd2(spark, sf_dir):
    """The feed as a log of daily commits, taken in several batches through bronze into the history."""
    base = work_dir(spark, "stream_scd2")
    feed = _daily_commits(spark, sf_dir)
    write_commits(feed, f"{base}/log")
    return run_users_pipeline(spark, base, feed.drop(*CHANGE_COLUMNS).schema, 12, 30)


@query("bronze_merged")
def bronze_merged(spark, sf_dir):
    """The feed landed commit by commit, its parts merged as they add up."""
    base = work_dir(spark, "bronze_merged")
    feed = _daily_commits(spark, sf_dir)
    write_commits(feed, f"{base}/log")
    columns = feed.drop(*CHANGE_COLUMNS).schema
    log = read_change_stream(spark, f"{base}/log", columns, max_files=5)
    bronze = enrich_changes(log, "accounts", stamp=False)
    placed = place_changes(bronze, USERS_FLOW, USER_BUCKETS, "YEAR")
    land(placed, f"{base}/bronze", f"{base}/checkpoints/bronze", PLACES)
    merge_parts(spark, f"{base}/bronze", placed.schema, PLACES, fan=3, keep=1)
    return Versions(spark, f"{base}/bronze", PLACES).read(placed.schema).drop(*LAYOUT)


@query("stream_two_flows")
def stream_two_flows(spark, sf_dir):
    """Two logs that share keys, taken in by turns into one history."""
    base = work_dir(spark, "two_flows")
    feed = _daily_commits(spark, sf_dir)
    columns = feed.drop(*CHANGE_COLUMNS).schema
    schema = placed_schema(bronze_schema(columns))
    odd = F.col("event_id") % 2 == 1
    for name, part in (("odd", odd), ("even", ~odd)):
        write_commits(feed.where(part), f"{base}/log_{name}")
        log = read_change_stream(spark, f"{base}/log_{name}", columns)
        placed = place_changes(enrich_changes(log, "accounts"), USERS_FLOW, USER_BUCKETS, "WEEK")
        land(placed, f"{base}/{name}", f"{base}/checkpoints/{name}", PLACES)
    flows = {name: f"{base}/{name}" for name in ("odd", "even")}
    for name in flows:
        apply_flows(
            spark,
            flows,
            schema,
            f"{base}/silver",
            f"{base}/checkpoints/silver",
            USERS_FLOW,
            USER_BUCKETS,
            "WEEK",
            only=[name],
            tie_columns=["event_id"],
        )
    return read_history(spark, f"{base}/silver", schema, USERS_FLOW)


@query("stream_append_silver")
def stream_append_silver(spark, sf_dir):
    """Accounts streamed into an append-mode silver table."""
    base = work_dir(spark, "stream_append")
    accounts = shapes.accounts(spark, sf_dir)
    append_table(accounts, f"{base}/source")
    stream_with_quality(
        append_silver(
            read_append_stream(spark, f"{base}/source", accounts.schema), doubles=["balance"]
        ),
        f"{base}/silver",
        f"{base}/checkpoints/silver",
        "accounts",
        rules.ACCOUNTS,
        f"{base}/quality",
    )
    silver = spark.read.parquet(f"{base}/silver")
    return silver.where("is_current").drop("__START_AT", BATCH)


@query("stream_quality")
def stream_quality(spark, sf_dir):
    """The counts that the stream of accounts leaves behind."""
    base = work_dir(spark, "stream_quality")
    customers = shapes.customers(spark, sf_dir)
    append_table(customers, f"{base}/source")
    stream_with_quality(
        append_silver(read_append_stream(spark, f"{base}/source", customers.schema)),
        f"{base}/silver",
        f"{base}/checkpoints/silver",
        "customers",
        rules.CUSTOMERS,
        f"{base}/quality",
    )
    counts = read_counts(spark, f"{base}/quality").groupBy("dataset", "expectation")
    return counts.agg(
        F.sum("total_rows").alias("total_rows"), F.sum("failed_rows").alias("failed_rows")
    )


@query("cdc_quality")
def cdc_quality(spark, sf_dir):
    """The counts that the users' history leaves: its expectations, and rows it cannot place."""
    base = work_dir(spark, "cdc_quality")
    feed = _daily_commits(spark, sf_dir)
    write_commits(feed, f"{base}/log")
    run_users_pipeline(
        spark, base, feed.drop(*CHANGE_COLUMNS).schema, 1000, 1000, f"{base}/quality"
    )
    counts = read_counts(spark, f"{base}/quality").groupBy("dataset", "expectation")
    return counts.agg(
        F.sum("total_rows").alias("total_rows"), F.sum("failed_rows").alias("failed_rows")
    )


# Gold


@query("cust_tran_profile")
def profile(spark, sf_dir):
    return cust_tran_profile(*_profile_inputs(spark, sf_dir))


@query("cust_tran_profile_sql")
def profile_sql(spark, sf_dir):
    """Over histories, of which closed versions must not count."""
    accounts, customers, tx = _profile_inputs(spark, sf_dir)
    other = F.col("acct_id") + 1
    return cust_tran_profile_sql(
        spark, shapes.as_history(accounts, other), shapes.as_history(customers, other), tx
    )


def _tx_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = shapes.transactions(spark, sf_dir).withColumn("seq", F.col("transaction_date"))
    return scd2_history(
        tx,
        ["transaction_id"],
        "seq",
        except_column_list=["seq"],
        hot_from=shapes.transaction_keys(spark, sf_dir),
    )


@query("cust_tran_profile_cdc")
def profile_cdc(spark, sf_dir):
    """Over SCD2 transactions, where every version of a transaction counts."""
    accounts, customers, _ = _profile_inputs(spark, sf_dir)
    return cust_tran_profile(accounts, customers, shapes.exact(_tx_history(spark, sf_dir)))


@query("cust_tran_profile_current")
def profile_current(spark, sf_dir):
    """Over the open versions of the transactions only."""
    accounts, customers, _ = _profile_inputs(spark, sf_dir)
    opened = current(_tx_history(spark, sf_dir))
    return cust_tran_profile(accounts, customers, shapes.exact(opened))


@query("cust_tran_profile_append")
def profile_append(spark, sf_dir):
    """Append mode: accounts loaded twice double every total."""
    accounts, customers, tx = _profile_inputs(spark, sf_dir)
    held = append_silver(accounts.unionByName(accounts), doubles=["balance"]).where("is_current")
    holders = append_silver(customers).where("is_current")
    cents = tx.withColumn("total_amt", F.col("total_amt") * 100)
    gold = cust_tran_profile(held, holders, append_transactions(cents))
    dates = ("first_transaction_date", "latest_transaction_date")
    return gold.withColumns({c: F.col(c).cast("string") for c in dates})


@query("latest_per_group")
def latest_holdings(spark, sf_dir):
    tx = shapes.transactions(spark, sf_dir).drop("total_amt")
    return latest_per_group(tx, ["acct_id", "ticker_symbol"], "transaction_date")


@query("latest_per_group_hot")
def latest_holdings_hot(spark, sf_dir):
    """The same with most groups treated as hot."""
    tx = shapes.transactions(spark, sf_dir).drop("total_amt")
    return latest_per_group(tx, ["acct_id", "ticker_symbol"], "transaction_date", hot_rows=1)


@query("ticker_dist_geo")
def geo(spark, sf_dir):
    return ticker_dist_geo(
        shapes.customers(spark, sf_dir),
        shapes.transactions(spark, sf_dir),
        hot_from=shapes.account_keys(spark, sf_dir),
    )


@query("ticker_dist_geo_hot")
def geo_hot(spark, sf_dir):
    """The same with most accounts treated as hot."""
    return ticker_dist_geo(
        shapes.customers(spark, sf_dir), shapes.transactions(spark, sf_dir), hot_rows=20
    )


# Expectations


@query("expect_accounts")
def expect_accounts(spark, sf_dir):
    return expectation_report(shapes.accounts(spark, sf_dir), "accounts", rules.ACCOUNTS)


@query("expect_customers")
def expect_customers(spark, sf_dir):
    return expectation_report(shapes.customers(spark, sf_dir), "customers", rules.CUSTOMERS)


@query("expect_tx")
def expect_tx(spark, sf_dir):
    return expectation_report(shapes.transactions(spark, sf_dir), "transactions", rules.TRANSACTIONS)


@query("expect_tx_append")
def expect_tx_append(spark, sf_dir):
    silver = append_transactions(shapes.transactions(spark, sf_dir))
    return expectation_report(silver, "transactions", rules.TRANSACTIONS_APPEND)


@query("expect_profile")
def expect_profile(spark, sf_dir):
    return expectation_report(profile(spark, sf_dir), "cust_tran_profile", rules.PROFILE)


@query("expect_geo")
def expect_geo(spark, sf_dir):
    return expectation_report(geo(spark, sf_dir), "ticker_dist_geo", rules.GEO)


# Checks across tables


@query("val_accounts_without_customer")
def val_accounts_without_customer(spark, sf_dir):
    """Accounts nobody acts on: the customers of this check are the users of the feed."""
    users = shapes.change_feed(spark, sf_dir).select(F.col("user_id").alias("acct_id"))
    return missing_keys(shapes.accounts(spark, sf_dir), users, "acct_id")


@query("val_customers_without_account")
def val_customers_without_account(spark, sf_dir):
    """Customers whose account is not, or no longer, open in the history."""
    opened = scd2_current(spark, sf_dir).select(F.col("user_id").alias("acct_id"))
    return missing_keys(shapes.customers(spark, sf_dir), opened, "acct_id")


@query("val_accounts_without_tx")
def val_accounts_without_tx(spark, sf_dir):
    """Orders without line items."""
    orders = shapes.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("acct_id"))
    lines = shapes.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("acct_id"))
    return missing_keys(orders, lines, "acct_id")


@query("val_orphan_tx")
def val_orphan_tx(spark, sf_dir):
    """Accounts with transactions that are not open in the history."""
    opened = scd2_current(spark, sf_dir).select(F.col("user_id").alias("acct_id"))
    return missing_keys(shapes.transactions(spark, sf_dir), opened, "acct_id")


@query("val_tx_count_spread")
def val_tx_count_spread(spark, sf_dir):
    return count_spread(shapes.transactions(spark, sf_dir), "acct_id")


# Functions and synthesis


@query("record_hash")
def customer_hash(spark, sf_dir):
    return shapes.customers(spark, sf_dir).select(
        "customer_id", record_hash("customer_id", "acct_id", "state_cd").alias("record_hash")
    )


def _ids(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return shapes.table(spark, sf_dir, name).select(F.col(key).alias("id"))


def _tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.table(spark, sf_dir, "part").select(F.col("p_brand").alias("ticker"))


@query("synth_accounts")
def synth_accounts(spark, sf_dir):
    """Accounts made up for the ids of the customers."""
    made = synth.accounts(_ids(spark, sf_dir, "customer", "c_custkey"), seed=1)
    # Closing dates run past what a pandas timestamp can hold.
    return made.withColumn("closed_date", F.col("closed_date").cast("string"))


@query("synth_customers")
def synth_customers(spark, sf_dir):
    return synth.customers(_ids(spark, sf_dir, "customer", "c_custkey"), seed=1)


@query("synth_transactions")
def synth_transactions(spark, sf_dir):
    ids = _ids(spark, sf_dir, "events", "event_id")
    return synth.transactions(ids, _tickers(spark, sf_dir), seed=1)


@query("synth_dim_choice")
def synth_dim_choice(spark, sf_dir):
    ids = _ids(spark, sf_dir, "orders", "o_orderkey")
    return synth.choose_from(ids, _tickers(spark, sf_dir), "ticker", "ticker_symbol", seed=1)


@query("synth_derived")
def synth_derived(spark, sf_dir):
    """Columns that build on one another, made for the ids of the orders."""
    spec = {
        "fee": synth.From(("amount", "rate"), "amount * rate"),
        "fee_class": synth.From(("fee", "order_type"), "concat(order_type, if(fee < 100, '-low', '-high'))"),
        "rate": synth.From(("order_type",), "if(order_type = 'market', 0.25D, 0.125D)", shown=False),
        "amount": synth.uniform_double("amount", 1, 0.0, 1000.0),
        "order_type": synth.choice("order_type", 1, synth.ORDER_TYPES),
    }
    return synth.synthesize(_ids(spark, sf_dir, "orders", "o_orderkey"), spec)
