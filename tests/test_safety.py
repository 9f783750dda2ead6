"""No rows and no columns are lost without an error: layouts, names, copies, plans."""

import itertools
import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_streaming import BUCKETS, COLUMNS, DAYS, FLOW, Pipe, rows, some

from lamina.operators import diff, heavy
from lamina.operators.bronze import enrich_changes
from lamina.operators.diff import diff_snapshots
from lamina.operators.heavy import heavy_keys, skew_join
from lamina.operators.latest import latest_per_group
from lamina.operators.quality import expect_all, expectation_report, observed_report
from lamina.operators.scd2 import scd2_history
from lamina.operators.validate import missing_keys
from lamina.plans import catalogue, shapes
from lamina.plans.gold import ticker_dist_geo
from lamina.plans.loads import Sizes, initial_load, ticker_table
from lamina.plans.refresh import Folders, refresh_append, refresh_cdc
from lamina.session import work_dir
from lamina.sources import tables
from lamina.sources.files import Store
from lamina.sources.tables import (
    SourceTable,
    read_append_stream,
    read_table,
    register_table,
    table_properties,
)
from lamina.sources.versions import read_view, refresh_view
from lamina.streaming import history
from lamina.streaming.history import keep_layout, period_of, place_changes

# Names the operators use themselves, and one that needs quotes.
NAMES = ["present", "latest_rank", "hot_salt", "updated", "gone", "was", "more", "a b", "step"]


def named(spark, n, keys=4):
    draw = random.Random(n)
    made = [(draw.randrange(keys), *[draw.randrange(3) for _ in NAMES], i) for i in range(n)]
    fields = ", ".join(f"`{c}` INT" for c in ["the key", *NAMES, "at"])
    return spark.createDataFrame(made, fields)


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_columns_of_any_name_stay(spark, hot_rows):
    df = named(spark, 40)
    found = scd2_history(df, ["the key"], "at", hot_rows=hot_rows, collapse_unchanged=False)
    assert found.columns == ["the key", *NAMES, "at", "__START_AT", "__END_AT"]
    assert rows(found.select(*df.columns)) == rows(df)
    latest = latest_per_group(df, ["the key", "a b"], "at", hot_rows)
    assert latest.columns == df.columns
    best = {}
    for row in df.collect():
        best[row["the key"], row["a b"]] = row  # rows come in the order of ``at``
    assert rows(latest) == sorted(map(tuple, best.values()), key=repr)
    one = df.groupBy("the key").agg(F.max("at").alias("hot_salts"))
    joined = skew_join(df, one, ["the key"], hot_rows=hot_rows)
    assert joined.columns == [*df.columns, "hot_salts"]
    assert rows(joined) == rows(df.join(one, "the key"))


def test_a_table_with_only_a_column_present(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, None, 2)], "k INT, present INT, at INT")
    found = scd2_history(df, ["k"], "at", except_column_list=["at"])
    assert found.columns == ["k", "present", "__START_AT", "__END_AT"]
    keys = scd2_history(df, ["k"], "at", except_column_list=["at", "present"])
    assert keys.columns == ["k", "__START_AT", "__END_AT"] and keys.count() == 1


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_diff_counts_copies(spark, hot_rows):
    old, new = named(spark, 30), named(spark, 45)
    before = old.union(old).union(old.limit(7))
    after = new.union(old)
    got = Counter(tuple(r) for r in diff_snapshots(before, after, ["the key"], hot_rows).collect())
    was, now = (Counter(map(tuple, d.collect())) for d in (before, after))
    less, more = was - now, now - was
    both = {r[0] for r in less} & {r[0] for r in more}
    want = Counter()
    for changed, kinds in ((less, ("update_preimage", "delete")), (more, ("update_postimage", "insert"))):
        for row, n in changed.items():
            want[*row, kinds[row[0] not in both]] += n
    assert got == want


def test_two_equal_rows_before_and_one_after(spark, monkeypatch):
    monkeypatch.setattr(diff, "COPIES", 3)
    row = spark.createDataFrame([(1, "x")], "k INT, v STRING")
    many = row.crossJoin(spark.range(8).select()).select("k", "v")
    got = diff_snapshots(many, row, ["k"]).collect()
    assert [tuple(r) for r in got] == [(1, "x", "delete")] * 7


def test_an_expectation_may_have_any_name(spark):
    df = spark.createDataFrame([(1,), (2,)], "v INT")
    rules = {"total_rows": "v = 1", "it's `odd`": "v > 0"}
    want = [("d", "total_rows", 2, 1), ("d", "it's `odd`", 2, 0)]
    assert [tuple(r) for r in expectation_report(df, "d", rules).collect()] == want
    counted, seen = expect_all(df, rules)
    counted.collect()
    assert [tuple(r) for r in observed_report(spark, "d", rules, seen).collect()] == want


def test_missing_keys_of_two_columns(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (None, "c")], "k INT, `a b` STRING")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, `a b` STRING")
    assert rows(missing_keys(left, right, ["k", "a b"])) == rows(left.where("`a b` <> 'a'").distinct())


# Periods and buckets


@pytest.mark.parametrize("unit", ["day", "Week", "month", "quarter", "YEAR"])
def test_units_in_any_case(spark, unit):
    df = spark.createDataFrame([("2024-05-17 10:00:00",)], "t STRING").select(F.col("t").cast("timestamp"))
    kind = df.schema["t"].dataType
    got, want = (df.select(period_of("t", kind, u)).first()[0] for u in (unit, unit.upper()))
    assert got == want is not None


def test_an_unknown_unit_raises_before_anything_is_written(spark, tmp_path):
    pipe = Pipe(spark, tmp_path)
    pipe.commit(0, [("a", 1, "insert")], DAYS[0])
    log = enrich_changes(
        spark.read.parquet(pipe.at("log")), "things"
    )
    with pytest.raises(ValueError):
        place_changes(log, FLOW, BUCKETS, "HOUR")
    with pytest.raises(ValueError):
        keep_layout(spark, pipe.at("silver"), BUCKETS, "HOUR")
    with pytest.raises(ValueError):
        refresh_cdc(spark, Folders(str(tmp_path / "cdc")), 2, "HOUR")
    assert not (tmp_path / "silver").exists() and not (tmp_path / "cdc").exists()


def test_another_layout_is_refused(spark, tmp_path):
    target = str(tmp_path / "silver")
    keep_layout(spark, target, 3, "month")
    keep_layout(spark, target, 3, "MONTH")
    for buckets, unit in ((4, "MONTH"), (3, "DAY")):
        with pytest.raises(ValueError):
            keep_layout(spark, target, buckets, unit)


@pytest.mark.parametrize("wrong", [{"unit": "DAY"}, {"buckets": BUCKETS + 1}])
def test_rows_placed_otherwise_are_refused(spark, tmp_path, monkeypatch, wrong):
    pipe = Pipe(spark, tmp_path)
    pipe.commit(0, [("a", 1, "insert"), ("b", 2, "insert"), ("c", 2, "insert")], DAYS[1])
    place = place_changes

    def misplaced(bronze, flow, buckets, unit="MONTH"):
        return place(bronze, flow, **{"buckets": buckets, "unit": unit, **wrong})

    monkeypatch.setattr("test_streaming.place_changes", misplaced)
    with pytest.raises(Exception, match="placed"):
        pipe.run()
    assert pipe.silver() == []


def test_every_change_kept_incrementally(spark, tmp_path, monkeypatch):
    pipe = Pipe(spark, tmp_path)
    apply = history.apply_changes
    monkeypatch.setattr(
        "test_streaming.apply_changes", lambda *a, **k: apply(*a, **k, collapse_unchanged=False)
    )
    draw = random.Random(3)
    for version, day in zip(itertools.count(), [DAYS[3], DAYS[0], DAYS[5]]):
        pipe.commit(version, some(draw, 25), day)
        pipe.run()
    log = enrich_changes(spark.read.parquet(pipe.at("log")), "things")
    batch = scd2_history(
        log, FLOW.keys, FLOW.sequence_by, FLOW.apply_as_deletes, FLOW.except_column_list,
        collapse_unchanged=False,
    )
    assert pipe.silver() == rows(batch)


# Sources


def test_rows_that_change_when_asked_again(spark, tmp_path):
    schema = spark.createDataFrame([], "id BIGINT, v DOUBLE").schema
    table = SourceTable(str(tmp_path / "t"), str(tmp_path / "log"), schema)
    table.append(spark.range(50).select("id", F.rand().alias("v")), 0, DAYS[0])
    first = rows(read_table(spark, table.path, schema))
    table.overwrite(spark.range(50).select("id", F.rand().alias("v")), 1, DAYS[1])
    log = spark.read.parquet(table.log)
    kinds = {v: rows(log.where(f"_commit_version = {v} AND _change_type = 'insert'").select("id", "v")) for v in (0, 1)}
    assert kinds[0] == first
    assert kinds[1] == rows(read_table(spark, table.path, schema)) != first
    assert rows(log.where("_change_type = 'delete'").select("id", "v")) == first


@pytest.mark.parametrize("lost", range(7))
@pytest.mark.parametrize("change", ["append", "overwrite"])
def test_a_lost_change_of_a_source_table_is_mended(spark, tmp_path, monkeypatch, change, lost):
    """The run is lost before the ``lost``-th step on the store once the commit is in the log."""
    schema = spark.createDataFrame([], "id BIGINT, v DOUBLE").schema
    table = SourceTable(str(tmp_path / "t"), str(tmp_path / "log"), schema)

    def some_rows(first):
        return spark.range(first, first + 40, 1, 2).select("id", F.rand().alias("v"))

    table.append(some_rows(0), 0, DAYS[0])
    table.append(some_rows(100), 1, DAYS[1])
    steps = itertools.count()

    def losing(real):
        def step(*args):
            if next(steps) >= lost:
                raise OSError("lost")
            return real(*args)

        return step

    class Flaky(Store):
        move, make, remove = losing(Store.move), losing(Store.make), losing(Store.remove)

    with monkeypatch.context() as m:
        m.setattr(tables, "Store", Flaky)
        try:
            getattr(table, change)(some_rows(200), 2, DAYS[2])
        except OSError:
            pass
    with pytest.raises(FileExistsError):
        table.append(some_rows(200), 2, DAYS[2])
    assert table.mend(spark) == []  # the refused append has mended the table
    table.append(some_rows(300), 3, DAYS[3])
    log = spark.read.parquet(table.log).where("_change_type = 'insert'")
    kept = log if change == "append" else log.where("_commit_version >= 2")
    assert rows(read_table(spark, table.path, schema)) == rows(kept.select("id", "v"))
    names = {f.name.split("-")[1] for f in (tmp_path / "t").glob("commit-*")}
    assert names == ({"0", "1", "2", "3"} if change == "append" else {"2", "3"})


def test_a_stream_of_a_mended_table_has_each_row_once(spark, tmp_path, monkeypatch):
    schema = spark.createDataFrame([], "id BIGINT").schema
    table = SourceTable(str(tmp_path / "t"), str(tmp_path / "log"), schema)
    table.append(spark.range(0, 10, 1, 3), 0, DAYS[0])

    def taken():
        stream = read_append_stream(spark, table.path, schema).writeStream.format("parquet")
        query = stream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
        query.start(str(tmp_path / "out")).awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect())

    moved = itertools.count()
    real = Store.move

    def losing(store, source, target):
        if "/commit-1-" in target and next(moved) == 1:
            raise OSError("lost")
        real(store, source, target)

    monkeypatch.setattr(Store, "move", losing)
    with pytest.raises(OSError):
        table.append(spark.range(10, 20, 1, 3), 1, DAYS[1])
    assert len(taken()) > 10
    assert table.mend(spark) == [1]
    assert taken() == list(range(20))


def test_a_failed_refresh_leaves_the_old_view(spark, tmp_path):
    path = str(tmp_path / "view")
    refresh_view(spark.range(3), path)
    with pytest.raises(Exception, match="broken"):
        refresh_view(spark.range(9).select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert read_view(spark, path).count() == 3
    held = read_view(spark, path)
    refresh_view(spark.range(5), path)
    # Who began to read the old view can go on.
    assert held.count() == 3 and read_view(spark, path).count() == 5
    refresh_view(spark.range(6), path)
    assert len(list(tmp_path.glob("view/rows/*/*"))) == 2


def test_tables_by_name(spark, tmp_path):
    path = str(tmp_path / "named")
    spark.range(4).write.parquet(path)
    spark.sql("DROP TABLE IF EXISTS by_name")
    register_table(spark, "by_name", path, "it's here", {"who": "o'neil \\ co", "k": "v"})
    held = {r["key"]: r["value"] for r in table_properties(spark, "by_name").collect()}
    assert held["who"] == "o'neil \\ co" and held["k"] == "v"
    assert read_table(spark, "by_name").count() == 4
    stream = read_append_stream(spark, "by_name", spark.range(0).schema)
    query = stream.writeStream.format("parquet").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "c")
    ).start(str(tmp_path / "copy"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 4
    spark.sql("DROP TABLE by_name")


def test_pipelines_register_their_tables(spark, tmp_path):
    folders = Folders(str(tmp_path / "p"))
    initial_load(spark, folders, ticker_table(spark), DAYS[0], Sizes(accounts=20, transactions=60, hot_transactions=10, hot_first=10, hot_count=5))
    spark.sql("DROP DATABASE IF EXISTS finance CASCADE")
    spark.sql("CREATE DATABASE finance")
    for _ in range(2):
        refresh_cdc(spark, replace(folders, run="cdc"), 2, hot_rows=None, register_as="finance")
    names = {t.name for t in spark.catalog.listTables("finance")}
    assert {"bronze_src_accounts", "silver_accounts", "silver_transactions", "gold_cust_tran_profile"} <= names
    assert spark.catalog.getTable("finance.silver_accounts").description
    assert {r["key"]: r["value"] for r in table_properties(spark, "finance.bronze_src_acct_tx").collect()}["quality"] == "bronze"
    assert spark.table("finance.silver_accounts").where("acct_id IS NOT NULL").count() == 20
    spark.sql("DROP DATABASE finance CASCADE")
    refresh_append(spark, replace(folders, run="append"), hot_rows=None)


class Elsewhere:
    """A session on another master, without a shared folder."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = type("Context", (), {"master": master})


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", ""])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError):
        work_dir(Elsewhere(master), "x")


def test_the_shared_folder_is_used():
    session = Elsewhere("yarn")
    session.conf["spark.checkpoint.dir"] = "s3a://bucket/shared/"
    assert work_dir(session, "x").startswith("s3a://bucket/shared/x-")


# Plans


def test_hot_keys_are_looked_for_without_the_upstream(spark, monkeypatch):
    """What is sampled holds no join and no grouping."""
    looked = []

    def look(df, keys, hot_rows):
        if hot_rows is not None:
            looked.append(df._jdf.queryExecution().executedPlan().toString())
        return heavy_keys(df, keys, hot_rows)

    for module in ("diff", "latest", "scd2"):
        monkeypatch.setattr(f"lamina.operators.{module}.heavy_keys", look)
    monkeypatch.setattr("lamina.plans.gold.heavy_keys", look)
    for name in ("cdf_diff", "ticker_dist_geo", "scd2_tx", "cust_tran_profile_cdc"):
        looked.clear()
        catalogue.REGISTRY[name](spark, "/root/testdata/sf0.001")
        assert looked and not any("Exchange" in plan or "Join" in plan for plan in looked)


def test_more_hot_keys_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(heavy, "BROADCAST_KEYS", 3)
    df = spark.range(400).select((F.col("id") % 20).alias("k"), "id")
    one = spark.range(25).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert heavy_keys(df, ["k"], 10).count() == 20
    assert rows(skew_join(df, one, ["k"], hot_rows=10)) == rows(df.join(one, "k"))


def test_crowded_accounts(spark):
    sf_dir = "/root/testdata/sf0.001"
    customers = shapes.customers(spark, sf_dir)
    crowd = customers.withColumn("acct_id", F.when(F.col("acct_id") < 50, 7).otherwise(F.col("acct_id")))
    tx = shapes.transactions(spark, sf_dir)
    want = rows(ticker_dist_geo(crowd, tx, hot_rows=None))
    assert len(want) > 100
    for hot_rows in (5, 40):
        assert rows(ticker_dist_geo(crowd, tx, hot_rows=hot_rows)) == want
    assert rows(ticker_dist_geo(crowd, tx, hot_rows=40, hot_from=tx.limit(0))) == want


