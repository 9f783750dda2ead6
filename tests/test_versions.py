"""Versioned tables, landed parts and several flows: whole states, bounded files, equal rows."""

import random
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_streaming import BUCKETS, COLUMNS, DAYS, FLOW, Pipe, rows, some

from lamina.operators.bronze import enrich_changes
from lamina.operators.scd2 import scd2_history
from lamina.plans.loads import Sizes, initial_load, ticker_table
from lamina.plans.refresh import Folders, refresh_cdc
from lamina.schemas import bronze as bronze_schema
from lamina.sources.changelog import read_change_stream, read_changes, write_commit, write_commits
from lamina.sources.files import Store, replace_folder
from lamina.sources.versions import Versions, read_view, show_version
from lamina.streaming import tables
from lamina.streaming.history import (
    PLACES,
    apply_changes,
    apply_flows,
    place_changes,
    placed_schema,
    read_history,
)
from lamina.streaming.landing import land, merge_parts, read_landed_stream
from lamina.streaming.tables import keep_counts, read_counts, stream_with_quality

PLACE = T.StructType().add("p", "string").add("q", "integer")
TABLE = T.StructType().add("v", "integer").add("p", "string").add("q", "integer")
REPORT = "dataset STRING, expectation STRING, total_rows BIGINT, failed_rows BIGINT"


# Versions


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.lists(st.tuples(st.integers(0, 9), st.sampled_from(["a", "b", None]), st.integers(0, 1)), max_size=6),
            st.sampled_from([None, "p = 'a'", "q = 1", "p <=> NULL", "true"]),
        ),
        min_size=1,
        max_size=4,
    )
)
def test_versions_as_in_a_plain_list(spark, tmp_path_factory, steps):
    table = Versions(spark, str(tmp_path_factory.mktemp("v")), PLACE)
    meant = {"p = 'a'": lambda r: r[1] == "a", "q = 1": lambda r: r[2] == 1, "p <=> NULL": lambda r: r[1] is None}
    held, states = [], []
    for new, replaced in steps:
        gone = (lambda r: replaced == "true") if replaced in (None, "true") else meant[replaced]
        held = [r for r in held if not gone(r)] + new
        condition = None if replaced is None else F.expr(replaced)
        number = table.publish(spark.createDataFrame(new, TABLE), condition)
        states.append(sorted(held, key=repr))
        assert number == len(states) - 1
    for number, state in enumerate(states):
        assert rows(table.read(TABLE, version=number)) == state
    some_rows = table.read(TABLE, F.expr("q = 1"))
    assert rows(some_rows) == [r for r in states[-1] if r[2] == 1]
    table.clean(keep=1)
    assert table.numbers() == [len(steps) - 1]
    assert rows(table.read(TABLE)) == states[-1]


def test_only_dead_partitions_go(spark, tmp_path):
    table = Versions(spark, str(tmp_path), PLACE)
    table.publish(spark.createDataFrame([(1, "a", 0), (2, "b", 0)], TABLE))
    table.publish(spark.createDataFrame([(3, "a", 0)], TABLE), F.expr("p = 'a'"))
    table.publish(spark.createDataFrame([(4, "b", 1)], TABLE))
    table.clean(keep=2)
    assert table.numbers() == [1, 2]
    assert rows(table.read(TABLE, version=1)) == [(2, "b", 0), (3, "a", 0)]
    left = {str(p.parent.relative_to(tmp_path / "rows")) for p in tmp_path.glob("rows/**/*.parquet")}
    assert left == {"_from=rows/_part=0/p=b/q=0", "_from=rows/_part=1/p=a/q=0", "_from=rows/_part=2/p=b/q=1"}


def test_a_reader_goes_on_with_what_it_began(spark, tmp_path):
    table = Versions(spark, str(tmp_path), PLACE)
    table.publish(spark.createDataFrame([(1, "a", 0), (2, "b", 0)], TABLE))
    begun = table.read(TABLE)
    table.publish(spark.createDataFrame([(9, "a", 0)], TABLE), F.lit(True))
    assert rows(begun) == [(1, "a", 0), (2, "b", 0)]
    assert rows(table.read(TABLE)) == [(9, "a", 0)]


def test_a_lost_list_is_written_over(spark, tmp_path, monkeypatch):
    table = Versions(spark, str(tmp_path), PLACE)
    table.publish(spark.createDataFrame([(1, "a", 0)], TABLE))
    with monkeypatch.context() as patch:
        patch.setattr(Versions, "_list", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.publish(spark.createDataFrame([(2, "b", 0), (3, "c", 0)], TABLE))
    assert rows(table.read(TABLE)) == [(1, "a", 0)]
    table.publish(spark.createDataFrame([(4, "b", 0)], TABLE))
    assert rows(table.read(TABLE)) == [(1, "a", 0), (4, "b", 0)]


def test_no_rows_yet(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "t"), PLACE)
    assert table.current() is None and table.read(TABLE).collect() == []
    show_version(spark, "no_such_view", table)
    assert not spark.catalog.tableExists("no_such_view")
    with pytest.raises(FileNotFoundError):
        read_view(spark, str(tmp_path / "t"))


@pytest.mark.parametrize("lost", [1, 2])
def test_moves_that_fail_lose_nothing(spark, tmp_path, monkeypatch, lost):
    path = str(tmp_path / "t")
    replace_folder(spark, path, lambda fresh: spark.range(3).write.parquet(fresh))
    move, calls = Store.move, []

    def failing(self, source, target):
        calls.append(source)
        if len(calls) == lost:
            raise OSError("lost")
        move(self, source, target)

    with monkeypatch.context() as patch:
        patch.setattr(Store, "move", failing)
        with pytest.raises(OSError, match="lost"):
            replace_folder(spark, path, lambda fresh: spark.range(5).write.parquet(fresh))
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_names_change_over_with_a_full_refresh(spark, tmp_path):
    folders = Folders(str(tmp_path / "p"), "one")
    sizes = Sizes(accounts=20, transactions=60, hot_transactions=10, hot_first=10, hot_count=5)
    initial_load(spark, folders, ticker_table(spark), DAYS[0], sizes)
    spark.sql("DROP DATABASE IF EXISTS versioned CASCADE")
    spark.sql("CREATE DATABASE versioned")
    assert folders.live(spark).run == ""
    refresh_cdc(spark, folders, 2, hot_rows=None, register_as="versioned")
    assert folders.live(spark) == folders
    first = rows(spark.table("versioned.silver_accounts").select("acct_id", "__START_AT", "__END_AT"))
    again = folders.full_refresh("two")
    assert folders.live(spark).run == "one"
    refresh_cdc(spark, again, 3, "DAY", hot_rows=None, register_as="versioned")
    assert folders.live(spark) == again
    table = spark.table("versioned.silver_accounts")
    assert rows(table.select("acct_id", "__START_AT", "__END_AT")) == first and len(first) == 20
    assert all("/two/" in f for f in table.inputFiles())
    spark.sql("DROP DATABASE versioned CASCADE")


# Landed parts


def test_fifty_refreshes_leave_few_files(spark, tmp_path):
    pipe = Pipe(spark, tmp_path)
    draw = random.Random(9)
    schema = placed_schema(bronze_schema(pipe.schema))
    most = 0
    for run in range(5):
        made = [(*row, v, DAYS[v % 2]) for v in range(10 * run, 10 * run + 10) for row in some(draw, 4)]
        feed = spark.createDataFrame(made, f"{COLUMNS}, _change_type STRING, _commit_version BIGINT, at STRING")
        stamped = feed.withColumn("_commit_timestamp", F.col("at").cast("timestamp")).drop("at")
        write_commits(stamped, pipe.at("log"))
        log = read_change_stream(spark, pipe.at("log"), pipe.schema, max_files=1)
        placed = place_changes(enrich_changes(log, "things"), FLOW, 1, "YEAR")
        land(placed, pipe.at("bronze"), pipe.at("cp"), PLACES)
        merge_parts(spark, pipe.at("bronze"), schema, PLACES, fan=4, keep=1)
        live = Versions(spark, pipe.at("bronze"), PLACES)
        most = max(most, live.live().count())
        files = len(list(tmp_path.glob("bronze/rows/**/*.parquet")))
        assert files <= 4 and len(live.numbers()) == 1
    assert most <= 4
    log = enrich_changes(read_changes(spark, pipe.at("log"), pipe.schema), "things")
    columns = [c for c in log.columns if c != "ingestion_timestamp"]
    assert rows(live.read(schema).select(*columns)) == rows(log.select(*columns))
    assert log.count() == 200


def test_history_over_merged_parts(spark, tmp_path):
    pipe = Pipe(spark, tmp_path)
    draw = random.Random(10)
    schema = placed_schema(bronze_schema(pipe.schema))
    for version in (0, 2, 1, 4, 3):
        pipe.commit(version, some(draw, 20), DAYS[version])
        pipe.run()
        merge_parts(spark, pipe.at("bronze"), schema, PLACES, fan=2, keep=1)
        assert pipe.silver() == pipe.batch()


@pytest.mark.parametrize("listed", [False, True])
def test_a_batch_lands_once(spark, tmp_path, monkeypatch, listed):
    pipe = Pipe(spark, tmp_path)
    pipe.commit(0, [("a", 1, "insert"), ("b", 1, "insert")], DAYS[0])
    put = Versions._list

    def failing(self, *args):
        if listed:
            put(self, *args)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Versions, "_list", failing)
        with pytest.raises(Exception, match="lost"):
            pipe.run()
    pipe.run()
    assert pipe.bronze().count() == 2 and pipe.silver() == pipe.batch()


def test_another_checkpoint_is_refused(spark, tmp_path):
    pipe = Pipe(spark, tmp_path)
    pipe.commit(0, [("a", 1, "insert")], DAYS[0])
    pipe.run()
    placed = place_changes(
        enrich_changes(read_change_stream(spark, pipe.at("log"), pipe.schema), "things"), FLOW, BUCKETS
    )
    with pytest.raises(ValueError, match="another checkpoint"):
        land(placed, pipe.at("bronze"), pipe.at("new"), PLACES)
    source = spark.createDataFrame([("a", 1.0)], "acct_id STRING, balance DOUBLE")
    source.write.parquet(pipe.at("src"))

    def stream(checkpoint):
        taken = spark.readStream.schema(source.schema).parquet(pipe.at("src"))
        stream_with_quality(taken, pipe.at("t"), checkpoint, "t", {"any": "true"}, pipe.at("q"))

    stream(pipe.at("cp1"))
    stream(pipe.at("cp1"))
    with pytest.raises(ValueError, match="another checkpoint"):
        stream(pipe.at("cp2"))
    assert spark.read.parquet(pipe.at("t")).count() == 1


# Counts


def test_counts_are_added_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MERGED_COUNTS", 3)
    quality = str(tmp_path / "q")

    def report(dataset, n):
        return spark.createDataFrame([(dataset, "x", n, 1), (dataset, "y", n, 0)], REPORT)

    def sums():
        counts = read_counts(spark, quality).groupBy("dataset", "expectation")
        return rows(counts.agg(F.sum("total_rows"), F.sum("failed_rows")))

    for batch in range(10):
        keep_counts(report("d", batch + 1), "d", quality, batch)
        keep_counts(report("d", batch + 1), "d", quality, batch)  # a retry
        total = (batch + 1) * (batch + 2) // 2
        assert sums() == [("d", "x", total, batch + 1), ("d", "y", total, 0)]
        assert len(list(tmp_path.glob("q/source=d/batch=*"))) <= 3
    keep_counts(report("e", 5), "e", quality, 0)
    assert ("e", "x", 5, 1) in sums()
    # Removal was lost: folders that a later one has added up don't count again.
    with monkeypatch.context() as patch:
        patch.setattr(Store, "remove", lambda *_: None)
        for batch in range(10, 14):
            keep_counts(report("d", 0), "d", quality, batch)
    assert len(list(tmp_path.glob("q/source=d/batch=*"))) > 3
    assert sums()[0] == ("d", "x", 55, 14)


# Several flows


class Flows:
    def __init__(self, spark, base, names):
        self.spark, self.base = spark, str(base)
        self.schema = spark.createDataFrame([], COLUMNS).schema
        self.paths = {name: f"{self.base}/{name}" for name in names}

    def commit(self, name, version, changes, day):
        feed = self.spark.createDataFrame(changes, COLUMNS + ", _change_type STRING")
        write_commit(feed, f"{self.base}/log_{name}", version, day)

    def run(self, *names, flow=FLOW):
        placed = placed_schema(bronze_schema(self.schema))
        for name in names:
            log = read_change_stream(self.spark, f"{self.base}/log_{name}", self.schema)
            bronze = place_changes(enrich_changes(log, "things"), flow, BUCKETS)
            land(bronze, self.paths[name], f"{self.base}/cp/{name}_bronze", PLACES)
        apply_flows(
            self.spark, self.paths, placed, f"{self.base}/silver", f"{self.base}/cp/silver", flow, BUCKETS,
            only=names, quality=f"{self.base}/quality", hot_rows=None,
        )

    def silver(self):
        return rows(read_history(self.spark, f"{self.base}/silver", bronze_schema(self.schema), FLOW))

    def batch(self, names, **options):
        log = None
        for name in names:
            part = enrich_changes(read_changes(self.spark, f"{self.base}/log_{name}", self.schema), "things")
            log = part if log is None else log.unionByName(part)
        return rows(
            scd2_history(
                log, FLOW.keys, FLOW.sequence_by, FLOW.apply_as_deletes, FLOW.except_column_list, **options
            )
        )


@pytest.mark.parametrize("overlapping", [True, False])
def test_flows_in_turns(spark, tmp_path, overlapping):
    flows = Flows(spark, tmp_path, ["left", "right"])
    draw = random.Random(11)

    def changes(name):
        made = some(draw, 12, keys=8)
        return made if overlapping else [(f"{name}{k}", v, op) for k, v, op in made]

    flows.commit("left", 0, changes("left"), DAYS[2])
    flows.commit("right", 0, changes("right"), DAYS[0])
    for name in ("left", "right"):
        flows.run(name)
    assert flows.silver() == flows.batch(["left", "right"])
    flows.commit("left", 1, changes("left"), DAYS[1])
    flows.commit("right", 1, changes("right"), DAYS[4])
    flows.run("right")
    flows.run("right")
    flows.run("left")
    assert flows.silver() == flows.batch(["left", "right"])
    counted = {r[0] for r in read_counts(spark, f"{tmp_path}/quality").select("dataset").collect()}
    assert counted == {"things_left", "things_right"}


def test_a_flow_that_is_added_later(spark, tmp_path):
    flows = Flows(spark, tmp_path, ["left"])
    flows.commit("left", 0, [("a", 1, "insert"), ("b", 1, "insert")], DAYS[2])
    flows.run("left")
    flows.paths["right"] = f"{tmp_path}/right"
    flows.commit("right", 0, [("a", 2, "insert"), ("b", None, "delete"), ("c", 2, "insert")], DAYS[0])
    flows.run("right")
    assert flows.silver() == flows.batch(["left", "right"])


def test_a_lost_flow_does_not_disturb_another(spark, tmp_path, monkeypatch):
    flows = Flows(spark, tmp_path, ["left", "right"])
    flows.commit("left", 0, [("a", 1, "insert"), ("b", 1, "insert")], DAYS[2])
    flows.commit("right", 0, [("a", 2, "update_postimage"), ("b", 1, "delete")], DAYS[0])
    flows.run("left")
    put = Versions._list

    def failing(self, *args):
        if "silver" in self.path:
            raise RuntimeError("lost")
        put(self, *args)

    with monkeypatch.context() as patch:
        patch.setattr(Versions, "_list", failing)
        with pytest.raises(Exception, match="lost"):
            flows.run("right")
    flows.commit("left", 1, [("a", 2, "update_postimage")], DAYS[4])
    flows.run("left")
    flows.run("right")
    assert flows.silver() == flows.batch(["left", "right"])


# Nulls that leave what was there


def test_nulls_incrementally(spark, tmp_path):
    flow = replace(FLOW, ignore_null_updates=True)
    flows = Flows(spark, tmp_path, ["one"])
    draw = random.Random(12)
    for version, day in enumerate([DAYS[1], DAYS[3], DAYS[0], DAYS[5], DAYS[4]]):
        changes = [(k, draw.choice([None, None, v, 3]), op) for k, v, op in some(draw, 14, keys=5)]
        flows.commit("one", version, changes, day)
        flows.run("one", flow=flow)
        assert flows.silver() == flows.batch(["one"], ignore_nulls=True)
    assert flows.silver() != flows.batch(["one"])


def test_streams_do_not_see_merged_parts(spark, tmp_path):
    pipe = Pipe(spark, tmp_path)
    schema = placed_schema(bronze_schema(pipe.schema))
    for version in range(3):
        pipe.commit(version, [("a", version, "insert")], DAYS[0])
        pipe.run()
    assert merge_parts(spark, pipe.at("bronze"), schema, PLACES, fan=2, keep=1) == 1
    query = pipe.run()
    assert not query.recentProgress or query.recentProgress[-1]["numInputRows"] == 0
    taken = read_landed_stream(spark, pipe.at("bronze"), schema)
    assert taken.columns == schema.names
    apply_changes(
        taken, pipe.at("bronze"), pipe.at("again"), pipe.at("cp_again"), FLOW, BUCKETS, hot_rows=None
    )
