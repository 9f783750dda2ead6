"""Both pipelines from made-up loads to gold, and the loads themselves."""

import pytest
from pyspark.sql import functions as F

from lamina import rules, schemas
from lamina.functions import synth
from lamina.operators.bronze import enrich_changes
from lamina.operators.scd2 import current, scd2_history
from lamina.operators.validate import missing_keys
from lamina.plans.loads import Sizes, append_hot, change_load, initial_load, ticker_table
from lamina.plans.refresh import (
    Folders,
    quality_report,
    refresh_append,
    refresh_cdc,
)
from lamina.sources.changelog import read_changes
from lamina.sources.tables import read_table
from lamina.streaming.history import read_history

SMALL = Sizes(
    accounts=40, transactions=300, hot_transactions=80, hot_first=10, hot_count=4, partitions=2
)
T0, T1, T2 = "2025-01-10 00:00:00", "2025-02-10 00:00:00", "2025-02-11 00:00:00"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def naive_profile(accounts, customers, tx):
    """The view as first written: join everything, then group."""
    return (
        accounts.alias("a")
        .join(customers.alias("c"), F.col("a.acct_id") == F.col("c.acct_id"))
        .join(tx.alias("t"), F.col("a.acct_id") == F.col("t.acct_id"))
        .groupBy("c.customer_id", "a.acct_id", "a.acct_status", "a.balance")
        .agg(
            F.count("*"),
            F.round(F.sum("t.total_amt"), 2),
            F.min("t.transaction_date"),
            F.max("t.transaction_date"),
            F.countDistinct("t.ticker_symbol"),
        )
    )


def shown(profile):
    value = F.round("total_transactions_value", 2).alias("total_transactions_value")
    return profile.drop("profile_created_at").withColumn("total_transactions_value", value)


@pytest.fixture(scope="module")
def cdc(spark, tmp_path_factory):
    """Refreshed after the first load, and again after the overwrite and the append."""
    folders = Folders(str(tmp_path_factory.mktemp("cdc")))
    tickers = ticker_table(spark)
    initial_load(spark, folders, tickers, T0, SMALL)
    first = rows(shown(refresh_cdc(spark, folders, buckets=2)))
    change_load(spark, folders, tickers, T1, T2, SMALL)
    second = refresh_cdc(spark, folders, buckets=2)
    return folders, first, second


def batch_history(spark, folders, name, schema, flow):
    log = read_changes(spark, folders.source(name, schema).log, schema)
    return scd2_history(
        enrich_changes(log, name), flow.keys, flow.sequence_by, flow.apply_as_deletes,
        flow.except_column_list,
    )


TABLES = [
    ("src_accounts", schemas.ACCOUNTS, rules.ACCOUNTS_FLOW),
    ("src_customer", schemas.CUSTOMER, rules.CUSTOMERS_FLOW),
    ("src_acct_tx", schemas.TRANSACTIONS, rules.TRANSACTIONS_FLOW),
]


@pytest.mark.parametrize("name, schema, flow", TABLES)
def test_silver_is_the_batch_history(spark, cdc, name, schema, flow):
    folders, _, _ = cdc
    silver = read_history(spark, folders.at("silver", flow.name), schemas.bronze(schema), flow)
    want = batch_history(spark, folders, name, schema, flow)
    assert silver.columns == want.columns
    text = [F.col(c).cast("string") for c in want.columns]
    assert rows(silver.select(*text)) == rows(want.select(*text))


def test_gold_after_each_refresh(spark, cdc):
    folders, first, second = cdc
    assert len(first) > 0
    accounts, customers, tx = (
        read_history(spark, folders.at("silver", flow.name), schemas.bronze(schema), flow)
        for _, schema, flow in TABLES
    )
    want = rows(naive_profile(current(accounts), current(customers), tx))
    assert rows(shown(second)) == want
    assert rows(shown(second)) != first
    # The overwrite left ten accounts and closed the rest.
    assert current(accounts).count() == 10
    assert accounts.count() == 50


def test_open_versions_are_the_source(spark, cdc):
    folders, _, _ = cdc
    source = read_table(spark, folders.source("src_customer", schemas.CUSTOMER).path, schemas.CUSTOMER)
    path = folders.at("silver", "customers")
    bronze = schemas.bronze(schemas.CUSTOMER)
    opened = current(read_history(spark, path, bronze, rules.CUSTOMERS_FLOW))
    columns = [c for c in source.columns if c != "created_at"]
    assert rows(opened.select(*columns)) == rows(source.select(*columns))


def test_orphans_of_the_change_load(spark, cdc):
    folders, _, _ = cdc
    source = {n: read_table(spark, folders.source(n, s).path, s) for n, s, _ in TABLES}
    accounts, customers, tx = (source[n] for n, _, _ in TABLES)
    assert missing_keys(accounts, customers, "acct_id").count() == 0
    assert missing_keys(customers, accounts, "acct_id").count() == 0
    assert missing_keys(tx, accounts, "acct_id").count() == SMALL.hot_count


def test_quality_of_every_dataset(spark, cdc):
    folders, _, _ = cdc
    report = {(r.dataset, r.expectation): r for r in quality_report(spark, folders).collect()}
    assert {d for d, _ in report} == {"accounts", "customers", "transactions", "cust_tran_profile"}
    assert report["accounts", "valid_balance"].total_rows == 50
    assert report["accounts", "valid_balance"].failed_rows == 0


def test_profile_over_open_transactions(spark, cdc):
    """The last append reuses the ids on other accounts, so the open accounts have none left open."""
    folders, _, second = cdc
    opened = refresh_cdc(
        spark, folders.full_refresh("open"), buckets=1, current_transactions_only=True
    )
    assert second.agg(F.sum("total_transactions")).first()[0] == SMALL.changed
    assert opened.count() == 0


def test_full_refresh_gives_the_same_gold(spark, cdc):
    folders, _, second = cdc
    again = refresh_cdc(spark, folders.full_refresh("again"), buckets=3, unit="DAY")
    assert rows(shown(again)) == rows(shown(second))


def test_append_pipeline(spark, tmp_path):
    folders = Folders(str(tmp_path))
    tickers = ticker_table(spark)
    initial_load(spark, folders, tickers, T0, SMALL)
    profile, _ = refresh_append(spark, folders)
    assert profile.agg(F.sum("total_transactions")).first()[0] == 380
    append_hot(spark, folders, tickers, 2, T1, SMALL)
    profile, geo = refresh_append(spark, folders)
    source = {n: read_table(spark, folders.source(n, s).path, s) for n, s, _ in TABLES}
    accounts, customers, tx = (source[n] for n, _, _ in TABLES)
    tx = tx.withColumn("transaction_date", F.col("transaction_date").cast("date"))
    assert rows(shown(profile)) == rows(naive_profile(accounts, customers, tx))
    best = tx.groupBy("acct_id", "ticker_symbol").agg(F.max("transaction_date").alias("transaction_date"))
    want = tx.join(best, ["acct_id", "ticker_symbol", "transaction_date"]).join(customers, "acct_id")
    columns = geo.drop("geo_analysis_created_at").columns
    assert rows(geo.select(*columns)) == rows(want.select(*columns))
    report = {(r.dataset, r.expectation): r for r in quality_report(spark, folders).collect()}
    assert report["transactions", "valid_total_holdings"].total_rows == 460
    assert ("ticker_dist_geo", "positive_holdings") in report


def test_accounts_loaded_twice_multiply(spark):
    """Append mode keeps every load current, so totals double with the accounts."""
    from lamina.plans.gold import cust_tran_profile, cust_tran_profile_sql

    accounts = spark.createDataFrame(
        [("a", "open", 1.0), ("a", "open", 1.0), ("a", "shut", 1.0), (None, "open", 0.0)],
        "acct_id STRING, acct_status STRING, balance DOUBLE",
    )
    customers = spark.createDataFrame(
        [("c", "a"), ("d", "a"), ("c", "a"), ("e", None), ("f", "z")],
        "customer_id STRING, acct_id STRING",
    )
    tx = spark.createDataFrame(
        [("a", 2.0, 1, "X"), ("a", 3.0, 4, None), ("a", None, 2, "Y"), (None, 1.0, 1, "X")],
        "acct_id STRING, total_amt DOUBLE, transaction_date INT, ticker_symbol STRING",
    )
    want = rows(naive_profile(accounts, customers, tx))
    assert len(want) == 4
    for hot_rows in (None, 1):
        assert rows(cust_tran_profile(accounts, customers, tx, hot_rows=hot_rows)) == want
    histories = []
    for table in (accounts, customers):
        closed = table.where("acct_id = 'a'").withColumn("__END_AT", F.lit(1))
        histories.append(table.withColumn("__END_AT", F.lit(None).cast("int")).unionByName(closed))
    assert rows(cust_tran_profile_sql(spark, *histories, tx)) == want
    stamped = cust_tran_profile_sql(spark, *histories, tx, stamp=True)
    assert stamped.columns[-1] == "profile_created_at"
    assert rows(stamped.drop("profile_created_at")) == want


def test_loads_do_not_depend_on_partitions(spark):
    tickers = ticker_table(spark)
    for make in (
        lambda ids: synth.accounts(ids, 7).withColumn("closed_date", F.col("closed_date").cast("string")),
        lambda ids: synth.customers(ids, 7),
        lambda ids: synth.transactions(ids, tickers, 7),
    ):
        one, many = (make(synth.row_ids(spark, 300, n)) for n in (1, 7))
        assert rows(one) == rows(many)


def test_specs_are_made_in_the_order_of_their_needs(spark):
    spec = {
        "last": synth.From(("twice", "Joined"), "twice + joined"),
        "twice": synth.From(("once",), F.col("once") * 2, shown=False),
        "joined": synth.From(("once",), lambda df: df.withColumn("joined", F.col("once") + 100)),
        "once": F.col("id") + 1,
        "a `b`.c": synth.From(("ID",), "id"),
    }
    assert synth.layers(spec) == [["once", "a `b`.c"], ["twice", "joined"], ["last"]]
    made = synth.synthesize(spark.range(3).withColumn("other", F.lit(1)), spec)
    assert made.columns == ["id", "last", "joined", "once", "a `b`.c"]
    assert sorted(tuple(r) for r in made.collect()) == [(i, 3 * i + 103, i + 101, i + 1, i) for i in range(3)]
    assert synth.synthesize(spark.range(0), spec).count() == 0
    assert synth.synthesize(spark.range(2), {}).columns == ["id"]


@pytest.mark.parametrize(
    "spec, told",
    [
        ({"a": synth.From(("b",), "b"), "b": synth.From(("a",), "a"), "c": synth.From((), "1")}, "circle: a, b"),
        ({"a": synth.From(("a",), "a")}, "circle: a"),
        ({"a": synth.From(("gone",), "gone")}, "a needs gone"),
        ({"a": synth.From((), "1"), "A": synth.From((), "2")}, "must differ"),
        ({"ID": synth.From((), "1")}, "must differ"),
    ],
)
def test_specs_that_cannot_be_made(spec, told):
    with pytest.raises(ValueError, match=told):
        synth.layers(spec)


def test_load_values(spark):
    ids = synth.row_ids(spark, 2000)
    accounts = synth.accounts(ids, 1)
    assert accounts.select("acct_id").distinct().count() == 1000
    low = accounts.agg(F.min("balance"), F.max("balance"), F.min("acct_number"), F.max("acct_number"))
    a, b, c, d = low.first()
    assert 500_000 <= a < 520_000 and 2_480_000 < b <= 2_500_000
    assert 1_000_000_000 <= c and d <= 2_000_000_000
    assert {r[0] for r in accounts.select("risk_tolerance").distinct().collect()} == set(synth.RISK)
    years = accounts.agg(F.min(F.year("closed_date")), F.max(F.year("closed_date"))).first()
    assert years[0] >= 2080 and 2780 < years[1] <= 2800
    customers = synth.customers(ids, 1)
    assert customers.select("state_cd").distinct().count() == len(synth.STATES)
    place = {code: (lat, lon) for code, lat, lon in synth.STATES}
    for row in customers.collect():
        lat, lon = place[row.state_cd]
        assert abs(row.latitude - lat) <= 0.01 and abs(row.longitude - lon) <= 0.01
    assert customers.where("phone_number = '+1-555-0007'").count() == 1
    assert customers.where("customer_id = '100000042'").first().email == "user42@demo.com"


def test_a_long_dimension(spark):
    """Every row gets the value at its own place in order, however many values there are."""
    values = spark.range(0, 200_000, 1, 7).select(F.format_string("v%06d", "id").alias("ticker"))
    got = synth.choose_from(spark.range(3000), values.union(values), "ticker", "t", 1)
    want = spark.range(3000).select(
        "id", F.format_string("v%06d", synth._below("t", 1, 200_000)).alias("t")
    )
    assert rows(got) == rows(want)
