"""Diff, latest rows, skewed joins, expectations, validation, bronze, append silver."""

import random
from collections import Counter

import pytest

from lamina import rules
from lamina.functions.hashing import record_hash
from lamina.operators.append import append_silver, append_transactions
from lamina.operators.bronze import add_bucket, enrich_changes, enrich_changes_sql
from lamina.operators.diff import append_changes, diff_snapshots, overwrite_changes
from lamina.operators.heavy import heavy_keys, skew_join
from lamina.operators import heavy, latest
from lamina.operators.latest import latest_per_group
from lamina.operators.quality import expect_all, expectation_report, observed_report
from lamina.operators.scd2 import current, scd2_history
from lamina.operators.validate import count_spread, missing_keys
from lamina.streaming.tables import stream_to_table


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


KV = "k INT, v STRING"


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_diff(spark, hot_rows):
    before = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], KV)
    after = spark.createDataFrame([(2, "z"), (3, None), (4, "w")], KV)
    assert rows(diff_snapshots(before, after, ["k"], hot_rows)) == [
        (1, "x", "delete"),
        (2, "y", "update_preimage"),
        (2, "z", "update_postimage"),
        (4, "w", "insert"),
    ]


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_diff_repeated_and_null_keys(spark, hot_rows):
    """A repeated key gives its changed rows once each, not one per pair; null keys match nothing."""
    before = spark.createDataFrame([(1, f"a{i}") for i in range(30)] + [(None, "n")], KV)
    after = spark.createDataFrame([(1, f"b{i}") for i in range(20)] + [(None, "m")], KV)
    found = Counter(row[2] for row in diff_snapshots(before, after, ["k"], hot_rows).collect())
    assert found == {"update_preimage": 30, "update_postimage": 20, "delete": 1, "insert": 1}


def test_diff_then_history_gives_the_later_snapshot(spark):
    rng = random.Random(2)
    first = {i: rng.choice("abc") for i in range(200)}
    second = {i: rng.choice("abc") for i in range(50, 250)}
    before = spark.createDataFrame(list(first.items()), KV)
    after = spark.createDataFrame(list(second.items()), KV)
    log = (
        append_changes(before)
        .selectExpr("*", "0 AS seq")
        .unionByName(diff_snapshots(before, after, ["k"]).selectExpr("*", "1 AS seq"))
        .withColumnRenamed("_change_type", "operation_type")
    )
    history = scd2_history(
        log, ["k"], "seq", "operation_type = 'delete'", ["seq", "operation_type"]
    )
    assert rows(current(history).select("k", "v")) == rows(after)
    overwritten = (
        append_changes(before)
        .selectExpr("*", "0 AS seq")
        .unionByName(overwrite_changes(before, after).selectExpr("*", "1 AS seq"))
        .withColumnRenamed("_change_type", "operation_type")
    )
    same = scd2_history(
        overwritten, ["k"], "seq", "operation_type = 'delete'", ["seq", "operation_type"]
    )
    assert rows(same) == rows(history)


@pytest.mark.parametrize("hot_rows", [None, 1, 40])
def test_latest_keeps_ties_and_loses_nulls(spark, hot_rows):
    rng = random.Random(4)
    data = [
        (
            rng.choice(["a", "a", "a", "b", "c", None]),
            rng.choice(["t", "u", None]),
            rng.choice([1, 2, 3, 4, None]),
            i,
        )
        for i in range(400)
    ]
    df = spark.createDataFrame(data, "acct STRING, ticker STRING, day INT, id INT")
    best = {}
    for a, t, d, _ in data:
        if None not in (a, t, d):
            best[a, t] = max(best.get((a, t), 0), d)
    want = [r for r in data if None not in r[:3] and best[r[0], r[1]] == r[2]]
    got = latest_per_group(df, ["acct", "ticker"], "day", hot_rows)
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("counted", [0, 10])
def test_latest_moves_rows_once_with_many_hot_groups(spark, monkeypatch, counted):
    """A list of hot groups too long to broadcast; keys and dates are odd."""
    for module in (heavy, latest):
        monkeypatch.setattr(module, "BROADCAST_KEYS", 2, raising=False)
    monkeypatch.setattr(latest, "SAMPLE_AT_THRESHOLD", counted, raising=False)
    draw = random.Random(5)
    days = [1.5, -2.0, float("inf"), float("nan"), None]
    data = [(draw.choice(["a", "b", "c", "d", None]), draw.choice(days), i // 2) for i in range(300)]
    data += [("only", -2.0, 1), ("only", -2.0, 1), ("one", 1.5, 2)]
    df = spark.createDataFrame(data, "`a b` STRING, hot_best DOUBLE, id INT")
    got = latest_per_group(df, ["a b"], "hot_best", 1)
    assert got.columns == df.columns
    assert repr(rows(got)) == repr(rows(latest_per_group(df, ["a b"], "hot_best", None)))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [None, 1, 100])
def test_skew_join(spark, how, hot_rows):
    many = [(1 if i % 3 else i if i % 7 else None, i) for i in range(600)]
    one = [(1, "a"), (1, "b"), (3, "c"), (None, "n"), (9999, "z")]
    left = spark.createDataFrame(many, "k INT, m INT")
    right = spark.createDataFrame(one, "k INT, o STRING")
    assert rows(skew_join(left, right, ["k"], how, hot_rows)) == rows(left.join(right, "k", how))


def test_expectations_count_nulls_and_keep_rows(spark):
    df = spark.createDataFrame(
        [(1, 5.0, "CA"), (None, -1.0, "CAL"), (2, None, None)],
        "acct_id INT, balance DOUBLE, state_cd STRING",
    )
    wanted = {
        "valid_acct_id": "acct_id IS NOT NULL",
        "valid_balance": "balance >= 0.0",
        "valid_state_cd": rules.CUSTOMERS["valid_state_cd"],
    }
    want = [
        ("accounts", "valid_acct_id", 3, 1),
        ("accounts", "valid_balance", 3, 2),
        ("accounts", "valid_state_cd", 3, 2),
    ]
    assert rows(expectation_report(df, "accounts", wanted)) == want
    counted, seen = expect_all(df, wanted)
    assert rows(counted) == rows(df)
    assert rows(observed_report(spark, "accounts", wanted, seen)) == want


def test_expectations_on_an_empty_table(spark):
    df = spark.createDataFrame([], "acct_id INT, balance DOUBLE, acct_status STRING")
    found = rows(expectation_report(df, "accounts", rules.ACCOUNTS))
    assert [r[2:] for r in found] == [(0, 0)] * 3


def test_missing_keys(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k INT")
    right = spark.createDataFrame([(2,), (3,)], "k INT")
    assert rows(missing_keys(left, right, "k")) == rows(spark.createDataFrame([(1,), (None,)], "k INT"))
    assert rows(missing_keys(left, left, "k")) == []


def test_count_spread(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "k INT")
    assert rows(count_spread(df, "k")) == [(1, 3)]


def test_enrich(spark):
    feed = spark.createDataFrame(
        [("a", "1.5", "insert", 3)], "k STRING, lat STRING, _change_type STRING, _commit_version INT"
    ).selectExpr("*", "TIMESTAMP'2024-01-01' AS _commit_timestamp")
    got = enrich_changes(feed, "accounts", {"lat": "double"})
    assert got.columns == [
        "k", "lat", "operation_type", "commit_version", "commit_timestamp", "source_file",
        "ingestion_timestamp",
    ]
    row = got.first()
    assert (row.lat, row.operation_type, row.source_file) == (1.5, "insert", "accounts")


def test_bucket_depends_on_the_key(spark):
    df = add_bucket(spark.range(1000).selectExpr("id % 50 AS k", "id"), ["k"], 8)
    assert df.select("k", "b").distinct().count() == 50
    assert {r.b for r in df.select("b").distinct().collect()} <= set(range(8))


def test_append_silver(spark):
    df = spark.sql("SELECT 'a' AS acct_id, '12' AS balance, 'f' AS source_file")
    row = append_silver(df, doubles=["balance"]).first()
    assert (row.balance, row["__END_AT"], row.is_current) == (12.0, None, True)
    assert row["__START_AT"] is not None
    assert "source_file" not in row
    tx = spark.sql(
        "SELECT 1 AS total_amt, 2 AS total_holdings, TIMESTAMP'2022-03-04 05:06:07' AS transaction_date,"
        " 1 AS created_date"
    )
    assert append_transactions(tx).dtypes == [
        ("total_amt", "double"),
        ("total_holdings", "double"),
        ("transaction_date", "date"),
    ]


def test_record_hash_skips_nulls(spark):
    df = spark.sql("SELECT 'a' AS x, CAST(NULL AS INT) AS y, 3 AS z")
    same = spark.sql("SELECT sha2('a|3', 256) AS h")
    assert rows(df.select(record_hash("x", "y", "z"))) == rows(same)


def test_hot_keys_from_a_sample(spark):
    """Above the sample's size the counts are estimates, and cold keys stay off the list."""
    df = spark.range(200_000).selectExpr("IF(id % 2 = 0, 0, id) AS k")
    hot = heavy_keys(df, ["k"], 40_000).collect()
    assert [r.k for r in hot] == [0]
    assert 90_000 < hot[0].hot_n < 110_000
    assert heavy_keys(df, ["k"], 150_000) is None


def test_enrich_in_sql(spark):
    feed = spark.sql(
        "SELECT 'a' AS k, 'delete' AS _change_type, 3L AS _commit_version,"
        " TIMESTAMP'2024-01-01' AS _commit_timestamp"
    )
    one, other = (
        f(feed, "accounts").drop("ingestion_timestamp") for f in (enrich_changes, enrich_changes_sql)
    )
    assert rows(one.select(*other.columns)) == rows(other)


def test_enrich_in_sql_on_a_stream(spark, tmp_path):
    feed = spark.sql(
        "SELECT 'a' AS k, 'insert' AS _change_type, 3L AS _commit_version,"
        " TIMESTAMP'2024-01-01' AS _commit_timestamp"
    )
    feed.write.parquet(str(tmp_path / "feed"))
    stream = spark.readStream.schema(feed.schema).parquet(str(tmp_path / "feed"))
    out = str(tmp_path / "bronze")
    stream_to_table(enrich_changes_sql(stream, "accounts"), out, str(tmp_path / "checkpoint"))
    row = spark.read.parquet(out).first()
    assert (row.k, row.source_file, row.operation_type) == ("a", "accounts", "insert")
    assert row.ingestion_timestamp is not None
