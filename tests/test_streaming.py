"""Streams: several runs, late data, restarts, retried batches, quality counts."""

import random

import pytest
from pyspark.sql import functions as F

from lamina import rules
from lamina.operators.append import append_silver
from lamina.operators.bronze import enrich_changes
from lamina.operators.scd2 import current, scd2_history
from lamina.schemas import bronze as bronze_schema
from lamina.sources.changelog import (
    has_change_feed,
    read_change_stream,
    read_changes,
    write_commit,
    write_commits,
)
from lamina.sources.tables import (
    append_table,
    read_append_stream,
    read_table,
    register_table,
    table_properties,
    ticker_list,
)
from lamina.streaming import history as streaming
from lamina.sources.versions import Versions
from lamina.streaming.history import (
    PLACES,
    apply_changes,
    place_changes,
    placed_schema,
    read_history,
)
from lamina.streaming.landing import land, landed_folder, read_landed_stream
from lamina.streaming.tables import stream_to_table, stream_with_quality

FLOW = rules.ChangeFlow("things", ("k",), rules.FEED_COLUMNS, {"small": "v < 2"})
COLUMNS = "k STRING, v INT"
BUCKETS = 3


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


class Pipe:
    """A log, its bronze and its history in one folder."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, str(base)
        self.schema = spark.createDataFrame([], COLUMNS).schema

    def at(self, name):
        return f"{self.base}/{name}"

    def commit(self, version, changes, day):
        feed = self.spark.createDataFrame(changes, COLUMNS + ", _change_type STRING")
        write_commit(feed, self.at("log"), version, day)

    def run(self, max_files=None, hot_rows=None):
        log = read_change_stream(self.spark, self.at("log"), self.schema)
        placed = place_changes(enrich_changes(log, "things"), FLOW, BUCKETS)
        land(placed, self.at("bronze"), self.at("checkpoints/bronze"), PLACES)
        schema = placed_schema(bronze_schema(self.schema))
        return apply_changes(
            read_landed_stream(self.spark, self.at("bronze"), schema, max_files),
            self.at("bronze"),
            self.at("silver"),
            self.at("checkpoints/silver"),
            FLOW,
            BUCKETS,
            quality=self.at("quality"),
            hot_rows=hot_rows,
        )

    def bronze(self):
        schema = placed_schema(bronze_schema(self.schema))
        return Versions(self.spark, self.at("bronze"), PLACES).read(schema)

    def silver(self):
        return rows(read_history(self.spark, self.at("silver"), bronze_schema(self.schema), FLOW))

    def batch(self):
        log = enrich_changes(read_changes(self.spark, self.at("log"), self.schema), "things")
        return rows(
            scd2_history(
                log, FLOW.keys, FLOW.sequence_by, FLOW.apply_as_deletes, FLOW.except_column_list
            )
        )


@pytest.fixture
def pipe(spark, tmp_path):
    return Pipe(spark, tmp_path)


def some(rng, n, keys=12):
    ops = ["insert", "update_postimage", "update_postimage", "delete", "update_preimage"]
    return [(f"k{rng.randrange(keys)}", rng.choice([None, 1, 2]), rng.choice(ops)) for _ in range(n)]


DAYS = [
    "2024-01-05 00:00:00", "2024-01-31 23:59:59", "2024-02-01 00:00:00", "2024-03-15 12:00:00",
    "2024-03-16 12:00:00", "2024-06-01 00:00:00",
]


def test_in_order(pipe):
    rng = random.Random(1)
    for version, day in enumerate(DAYS[1:5]):
        pipe.commit(version, some(rng, 15), day)
        pipe.run()
        assert pipe.silver() == pipe.batch()


@pytest.mark.parametrize("seed", [2, 3])
def test_any_order_and_split(pipe, seed):
    """Commits arrive in any order, some together, some taken file by file."""
    rng = random.Random(seed)
    commits = [(v, some(rng, 8), d) for v, d in enumerate(DAYS)]
    rng.shuffle(commits)
    while commits:
        for _ in range(rng.choice([1, 2])):
            if commits:
                pipe.commit(*commits.pop())
        pipe.run(max_files=rng.choice([None, 3]), hot_rows=rng.choice([None, 2]))
    assert pipe.silver() == pipe.batch()


def test_late_change_removes_versions(pipe):
    """A late change may empty a partition that held closed versions."""
    pipe.commit(0, [("a", 1, "insert")], DAYS[0])
    pipe.commit(2, [("a", 2, "update_postimage")], DAYS[3])
    pipe.commit(3, [("a", 3, "update_postimage")], DAYS[5])
    pipe.run()
    pipe.commit(1, [("a", 3, "update_postimage")], DAYS[2])
    pipe.commit(4, [("a", 3, "update_postimage")], DAYS[3])
    pipe.run()
    assert pipe.silver() == pipe.batch()
    assert len(pipe.silver()) == 2


def test_all_deleted(pipe):
    pipe.commit(0, [("a", 1, "insert"), ("b", 1, "insert")], DAYS[0])
    pipe.run()
    pipe.commit(1, [("a", 1, "delete"), ("b", 1, "delete")], DAYS[3])
    pipe.run()
    assert pipe.silver() == pipe.batch()
    assert all(row[-1] is not None for row in pipe.silver())


def test_open_versions_alone(pipe, spark):
    rng = random.Random(8)
    for version, day in enumerate(DAYS[:3]):
        pipe.commit(version, some(rng, 20), day)
    pipe.run()
    schema = bronze_schema(pipe.schema)
    opened = read_history(spark, pipe.at("silver"), schema, FLOW, only_current=True)
    assert rows(opened) == rows(current(read_history(spark, pipe.at("silver"), schema, FLOW)))
    assert opened.count() > 0
    plan = opened._jdf.queryExecution().executedPlan().toString()
    assert "_period" in plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]


def test_old_partitions_are_left_alone(pipe, tmp_path):
    pipe.commit(0, [("a", 1, "insert")], DAYS[0])
    pipe.commit(1, [("a", 2, "update_postimage")], DAYS[2])
    pipe.run()
    old = "silver/rows/*/*/_bucket=*/_period=2024-02-01/*.parquet"
    before = set(tmp_path.glob(old))
    pipe.commit(2, [("a", 3, "update_postimage")], DAYS[5])
    pipe.run()
    assert before and before == set(tmp_path.glob(old))
    assert pipe.silver() == pipe.batch()


@pytest.mark.parametrize("where", ["rows", "before", "after"])
def test_failed_batch_runs_again(pipe, monkeypatch, where):
    """A batch that stops among its partitions, before or after its list, is whole when it is run again;
    readers have the old history until the list is there."""
    rng = random.Random(5)
    pipe.commit(0, some(rng, 30), DAYS[1])
    pipe.run()
    old = pipe.silver()
    pipe.commit(1, some(rng, 30), DAYS[3])
    with monkeypatch.context() as patch:
        put, write = Versions._list, Versions._write

        def failing(self, *args):
            if "silver" in self.path and where != "rows":
                if where == "after":
                    put(self, *args)
                raise RuntimeError("lost")
            return put(self, *args)

        def half(self, changed, origin, part):
            if "silver" in self.path and where == "rows":
                write(self, changed.where("__END_AT IS NULL"), origin, part)
                raise RuntimeError("lost")
            return write(self, changed, origin, part)

        patch.setattr(Versions, "_list", failing)
        patch.setattr(Versions, "_write", half)
        with pytest.raises(Exception, match="lost"):
            pipe.run()
    assert pipe.silver() == (pipe.batch() if where == "after" else old)
    pipe.run()
    assert pipe.silver() == pipe.batch()


def test_a_commit_cannot_be_written_twice(pipe):
    rng = random.Random(6)
    changes = some(rng, 40)
    pipe.commit(0, changes, DAYS[0])
    pipe.run()
    want, bronze = pipe.silver(), pipe.bronze().count()
    feed = pipe.spark.createDataFrame(changes, COLUMNS + ", _change_type STRING")
    with pytest.raises(FileExistsError):
        write_commit(feed, pipe.at("log"), 0, DAYS[0])
    stamped = feed.withColumn("_commit_timestamp", F.lit(DAYS[0]).cast("timestamp"))
    both = stamped.crossJoin(pipe.spark.createDataFrame([(0,), (1,)], "_commit_version BIGINT"))
    with pytest.raises(FileExistsError):
        write_commits(both, pipe.at("log"))
    pipe.run()
    assert pipe.silver() == want
    assert pipe.bronze().count() == bronze


def test_commits_of_many_versions_follow_each_other(pipe):
    rng = random.Random(7)
    for first in (0, 2):
        feeds = []
        for version in (first, first + 1):
            feed = pipe.spark.createDataFrame(some(rng, 10), COLUMNS + ", _change_type STRING")
            feeds.append(
                feed.withColumn("_commit_version", F.lit(version).cast("bigint")).withColumn(
                    "_commit_timestamp", F.lit(DAYS[version]).cast("timestamp")
                )
            )
        write_commits(feeds[0].union(feeds[1]), pipe.at("log"))
        pipe.run()
        assert pipe.silver() == pipe.batch()


def test_counts_of_what_enters(pipe, spark):
    changes = [
        ("a", 1, "insert"),
        ("b", 5, "insert"),
        ("b", 5, "update_preimage"),
        ("b", None, "update_postimage"),
        ("c", 9, "delete"),
        (None, 1, "delete"),
    ]
    pipe.commit(0, changes, DAYS[0])
    pipe.run()
    report = spark.read.parquet(pipe.at("quality"))
    found = rows(report.select("dataset", "expectation", "total_rows", "failed_rows"))
    assert found == [("things", "has_key_and_sequence", 5, 1), ("things", "small", 3, 2)]


def test_starting_version(pipe, spark):
    for version in range(3):
        pipe.commit(version, [("a", version, "insert")], DAYS[version])
    late = read_changes(spark, pipe.at("log"), pipe.schema, 1)
    assert sorted(r.v for r in late.collect()) == [1, 2]
    assert has_change_feed(late)
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "_commit_version" in plan.split("PartitionFilters")[1].split("]")[0]
    stream = read_change_stream(spark, pipe.at("log"), pipe.schema, 2, max_files=1)
    stream_to_table(stream, pipe.at("copy"), pipe.at("checkpoints/copy"))
    assert [r.v for r in spark.read.parquet(pipe.at("copy")).collect()] == [2]


def test_append_stream_takes_new_rows_only(spark, tmp_path):
    base = str(tmp_path)
    rules_ = {"valid_balance": "balance >= 0.0"}

    def run():
        stream = read_append_stream(spark, f"{base}/src", schema)
        stream_with_quality(
            append_silver(stream), f"{base}/silver", f"{base}/cp", "accounts", rules_, f"{base}/q"
        )

    first = spark.createDataFrame([("a", 1.0), ("b", -1.0)], "acct_id STRING, balance DOUBLE")
    schema = first.schema
    append_table(first, f"{base}/src")
    run()
    append_table(spark.createDataFrame([("c", None)], schema), f"{base}/src")
    run()
    run()
    silver = spark.read.parquet(f"{base}/silver")
    assert rows(silver.select("acct_id", "balance")) == [("a", 1.0), ("b", -1.0), ("c", None)]
    counts = spark.read.parquet(f"{base}/q")
    assert sorted((r.total_rows, r.failed_rows) for r in counts.collect()) == [(1, 1), (2, 1)]


def test_schema_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    append_table(spark.sql("SELECT 1 AS a"), path)
    append_table(spark.sql("SELECT 2 AS a, 'x' AS b"), path)
    assert rows(read_table(spark, path).select("a", "b")) == [(1, None), (2, "x")]


def test_registered_table(spark, tmp_path):
    path = str(tmp_path / "tickers")
    append_table(spark.createDataFrame([("BLK",), ("MS",)], "ticker STRING"), path)
    spark.sql("DROP TABLE IF EXISTS tickers")
    register_table(spark, "tickers", path, "what is traded", {"layer": "bronze"})
    assert rows(ticker_list(spark, "tickers")) == [("BLK",), ("MS",)]
    found = {r.key: r.value for r in table_properties(spark, "tickers").collect()}
    assert found["layer"] == "bronze"
    assert spark.catalog.getTable("tickers").description == "what is traded"
    spark.sql("DROP TABLE tickers")


def test_nothing_to_do(pipe):
    """An empty feed makes an empty history."""
    pipe.commit(0, [], DAYS[0])
    pipe.run()
    assert pipe.silver() == []


@pytest.mark.parametrize("unit", ["DAY", "WEEK", "MONTH", "YEAR"])
def test_periods_do_not_depend_on_the_time_zone(spark, unit):
    df = spark.sql(
        "SELECT explode(sequence(TIMESTAMP'1969-12-30 00:00:00Z', TIMESTAMP'1970-02-03 00:00:00Z',"
        " INTERVAL 7 HOURS)) AS t"
    )
    got = {}
    for zone in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            period = streaming.period_of("t", df.schema["t"].dataType, unit).alias("p")
            got[zone] = rows(df.select(F.unix_seconds("t").alias("t"), period))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got["UTC"] == got["Asia/Tokyo"]
    periods = [p for _, p in got["UTC"]]
    by_time = [p for _, p in sorted(got["UTC"])]
    assert by_time == sorted(periods)


def test_only_touched_partitions_are_read(spark, pipe):
    pipe.commit(0, [("a", 1, "insert")], DAYS[0])
    pipe.run()
    schema = placed_schema(bronze_schema(pipe.schema))
    log = spark.read.schema(schema).parquet(landed_folder(pipe.at("bronze")))
    condition = streaming._since({"2024-02-01": [0, 1], "2024-03-01": [2]})
    plan = log.where(condition)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "_bucket" in filters and "_period" in filters
