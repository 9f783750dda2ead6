"""History: worked examples, a brute-force model, and what must hold of any history."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lamina.operators.scd2 import current, rejected_changes, scd2_history

LOG = "k STRING, v INT, seq INT, operation_type STRING"
INS, PRE, POST, DEL = "insert", "update_preimage", "update_postimage", "delete"

EXAMPLES = {
    "plain": ([(1, 1, INS), (1, 2, PRE), (2, 2, POST)], [(1, 1, 2), (2, 2, None)]),
    "delete": ([(1, 1, INS), (1, 5, DEL)], [(1, 1, 5)]),
    "reinsert": ([(1, 1, INS), (1, 3, DEL), (1, 6, INS)], [(1, 1, 3), (1, 6, None)]),
    "late_delete": ([(1, 5, DEL), (1, 3, INS)], [(1, 3, 5)]),
    "overwrite_commit": ([(1, 1, INS), (1, 2, DEL), (9, 2, INS)], [(1, 1, 2), (9, 2, None)]),
    "overwrite_same": ([(1, 1, INS), (1, 2, DEL), (1, 2, INS)], [(1, 1, None)]),
    "noop_update": ([(1, 1, INS), (1, 4, POST), (2, 6, POST)], [(1, 1, 6), (2, 6, None)]),
    "null_update": ([(1, 1, INS), (None, 4, POST)], [(1, 1, 4), (None, 4, None)]),
    "null_first": ([(None, 1, INS), (None, 2, POST)], [(None, 1, None)]),
    "snapshot_dup_key": ([(1, 1, INS), (2, 1, INS)], [(2, 1, None)]),
    "delete_only": ([(None, 4, DEL)], []),
    "replay": ([(1, 1, INS), (1, 1, INS), (2, 2, POST)], [(1, 1, 2), (2, 2, None)]),
}


def history(df, hot_rows=None, **options):
    return scd2_history(
        df,
        ["k"],
        "seq",
        "operation_type = 'delete'",
        ["seq", "operation_type"],
        hot_rows=hot_rows,
        **options,
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def model(log, collapse=True):
    """The rules of the module, one key and one change at a time."""
    out = []
    for key in {k for k, *_ in log}:
        winners = {}
        for k, v, seq, op in log:
            if k != key or op == PRE:
                continue
            rank = (op != DEL, v is not None, v or 0)
            if seq not in winners or rank > winners[seq][0]:
                winners[seq] = (rank, v, op == DEL)
        line = []
        for seq in sorted(winners):
            _, v, gone = winners[seq]
            state = ("gone",) if gone else ("live", v)
            if collapse and line and line[-1][1] == state:
                continue
            line.append((seq, state))
        for i, (seq, state) in enumerate(line):
            if state[0] == "live":
                until = line[i + 1][0] if i + 1 < len(line) else None
                out.append((key, state[1], seq, until))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_rows", [None, 1, 2])
def test_examples(spark, hot_rows):
    log = [(name, *change) for name, (changes, _) in EXAMPLES.items() for change in changes]
    want = [(name, *v) for name, (_, versions) in EXAMPLES.items() for v in versions]
    df = spark.createDataFrame(log, LOG)
    assert rows(history(df, hot_rows)) == sorted(want, key=repr)


change = st.tuples(
    st.sampled_from("ab"),
    st.sampled_from([None, 1, 2]),
    st.integers(0, 12),
    st.sampled_from([INS, PRE, POST, DEL]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(change, min_size=1, max_size=40), st.sampled_from([None, 1, 3]), st.booleans())
def test_any_log(spark, log, hot_rows, collapse):
    df = spark.createDataFrame(log, LOG)
    assert rows(history(df, hot_rows, collapse_unchanged=collapse)) == model(log, collapse)


def skewed_log(n=4000, seed=3):
    rng = random.Random(seed)
    return [
        (
            "hot" if rng.random() < 0.4 else f"k{rng.randrange(300)}",
            rng.choice([None, 1, 2]),
            rng.randrange(900),
            rng.choice([INS, POST, POST, DEL, PRE]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("hot_rows", [None, 5, 100, 1000])
@pytest.mark.parametrize("collapse", [True, False])
def test_hot_key(spark, hot_rows, collapse):
    """A key with a large share of the rows, cut into many, some and few stretches."""
    log = skewed_log()
    df = spark.createDataFrame(log, LOG).repartition(7)
    assert rows(history(df, hot_rows, collapse_unchanged=collapse)) == model(log, collapse)


def test_many_changes_at_one_instant(spark):
    log = [("hot", i, 7, POST) for i in range(500)] + [("hot", 3, 9, DEL)]
    df = spark.createDataFrame(log, LOG)
    assert rows(history(df, 10)) == [("hot", 499, 7, 9)]


def test_intervals(spark):
    """Versions of a key do not overlap, and at most one is open."""
    found = rows(history(spark.createDataFrame(skewed_log(), LOG), 50))
    by_key = {}
    for k, _, start, end in found:
        by_key.setdefault(k, []).append((start, end))
    for spans in by_key.values():
        spans.sort()
        assert all(end is not None and end <= start for (_, end), (start, _) in zip(spans, spans[1:]))
        assert all(end is None or start < end for start, end in spans)


def test_order_of_arrival_and_replay(spark):
    log = skewed_log(1500)
    want = model(log)
    twice = log + log
    random.Random(1).shuffle(twice)
    assert rows(history(spark.createDataFrame(twice, LOG), 50)) == want


def test_composite_key_and_ties(spark):
    log = [("a", 1, 10, "x", 1), ("a", 2, 10, "y", 1), ("a", 1, 11, "z", 2), ("a", 1, 9, "w", 2)]
    df = spark.createDataFrame(log, "k STRING, n INT, tie INT, v STRING, seq INT")
    got = scd2_history(df, ["k", "n"], "seq", except_column_list=["seq", "tie"], tie_columns=["tie"])
    assert rows(got) == [("a", 1, "x", 1, 2), ("a", 1, "z", 2, None), ("a", 2, "y", 1, None)]


def test_keys_alone(spark):
    log = [("a", 1, INS), ("a", 2, DEL), ("a", 4, INS), ("a", 5, POST)]
    df = spark.createDataFrame(log, "k STRING, seq INT, operation_type STRING")
    assert rows(history(df)) == [("a", 1, 2), ("a", 4, None)]


def test_rejected_and_current(spark):
    log = [(None, 1, 1, INS), ("a", 1, None, INS), ("b", 1, 1, INS), ("b", 2, 2, POST)]
    df = spark.createDataFrame(log, LOG)
    assert rows(rejected_changes(df, ["k"], "seq")) == rows(df.where("k IS NULL OR seq IS NULL"))
    assert rows(current(history(df))) == [("b", 2, 2, None)]


def test_one_shuffle(spark, tmp_path):
    """Keys that fit a task cost one exchange, and excluded columns are not read."""
    path = str(tmp_path / "log")
    spark.createDataFrame(skewed_log(200), LOG).selectExpr("*", "'x' AS extra").write.parquet(path)
    df = spark.read.parquet(path)
    got = scd2_history(
        df, ["k"], "seq", "operation_type = 'delete'", ["seq", "operation_type", "extra"]
    )
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.count("Sort ") == 1
    assert "extra" not in plan.split("ReadSchema")[1]


# Nulls that leave what was there

SPARSE = "k STRING, a INT, `b.c` INT, seq INT, operation_type STRING"


def sparse_model(log, kept):
    """One change at a time; ``kept`` are the places of the columns in which nulls leave the value."""
    out = []
    for key in {row[0] for row in log}:
        winners = {}
        for k, a, b, seq, op in log:
            if k != key or op == PRE:
                continue
            rank = (op != DEL, a is not None, a or 0, b is not None, b or 0)
            if seq not in winners or rank > winners[seq][0]:
                winners[seq] = (rank, None if op == DEL else [a, b])
        line, state = [], None
        for seq in sorted(winners):
            new = winners[seq][1]
            if new is not None and state is not None:
                new = [old if v is None and i in kept else v for i, (v, old) in enumerate(zip(new, state))]
            if not line or new != state:
                line.append((seq, new))
            state = new
        for (seq, held), (until, _) in zip(line, [*line[1:], (None, None)]):
            if held is not None:
                out.append((key, *held, seq, until))
    return sorted(out, key=repr)


sparse_logs = st.lists(
    st.tuples(
        st.sampled_from(["x", "y"]),
        st.one_of(st.none(), st.integers(0, 2)),
        st.one_of(st.none(), st.integers(0, 2)),
        st.integers(1, 12),
        st.sampled_from([INS, POST, POST, PRE, DEL]),
    ),
    max_size=40,
)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sparse_logs, st.sampled_from([True, ["a"], ["b.c"]]), st.sampled_from([None, 3]))
def test_nulls_leave_the_value_that_was_there(spark, log, ignored, hot_rows):
    kept = {True: (0, 1), "a": (0,), "b.c": (1,)}[ignored if ignored is True else ignored[0]]
    df = spark.createDataFrame(log, SPARSE)
    assert rows(history(df, hot_rows, ignore_nulls=ignored)) == sparse_model(log, kept)


def test_only_stored_columns_can_keep_their_values(spark):
    df = spark.createDataFrame([], LOG)
    with pytest.raises(ValueError, match="not stored columns: seq"):
        history(df, ignore_nulls=["seq"])
