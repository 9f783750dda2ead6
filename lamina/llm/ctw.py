"""Language-model scores by context-tree weighting over the bits of bytes.

A text's bytes, A-Z lowered, are predicted bit by bit from the ``DEPTH`` bytes before, with an end symbol
after the last. A cell is a context and a place within the next byte; it has a Krichevsky-Trofimov
estimate. Its block probability is half its own and half the product of its children's, and the
prediction mixes the estimates of all depths along the context with the weights that follow.

The tree has every context that training holds at least ``LEAST`` times, so it grows with the corpus;
rarer ones below a node share one further child. It is never in one place:

* ``count_runs``: tasks count runs of DEPTH + 1 symbols, the sums are shuffled and stored;
* ``climb``: the runs whose contexts end in the same ``TOP`` bytes make a subtree, worked out in a task
  of its own up to one number for each place; the driver gets these, at most 255 for each pair of bytes;
* ``descend``: the mix of the depths above ``TOP``, at most 255 numbers for each byte, is broadcast, and
  each subtree's task goes down again and gives one log probability for each run.

A subtree's size follows the distinct runs below two bytes and not the rows that have them. The runs of
texts that only are to be scored are in the table too, without counts. The ``most`` most frequent
runs are broadcast for scoring (``frequent``); whoever scores joins the others to the table.

Null texts are empty: their code is the end symbol's. Without training texts all bits have probability
one half. A very long text is worked on in stretches of ``CHUNK`` symbols. Repeated rows get equal scores.
An empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.arrow import slices

DEPTH = 5
#: Bytes that the contexts of one subtree end in.
TOP = 2
#: How often training holds a context that has a node of its own.
LEAST = 2
#: Runs that are broadcast for scoring.
MOST = 1 << 20
#: Counts are parted at a step of this many to a doubling, to find the most frequent runs.
STEPS = 16
#: No UTF-8 text holds these bytes.
START, END = 0xFE, 0xFF
CHUNK = 1 << 20
FLUSH = 2_000_000


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' symbols, each text with DEPTH starts before and an end after; and where texts begin."""
    held = [(t or "").encode().lower() for t in texts]
    joined = b"".join(bytes([START]) * DEPTH + t + bytes([END]) for t in held)
    sizes = np.array([len(t) + 1 for t in held], np.int64)
    return np.frombuffer(joined, np.uint8), np.concatenate([[0], np.cumsum(sizes + DEPTH)])


def runs_of(texts: list[str | None]):
    """(runs, texts' numbers) of all symbols that are predicted, a stretch at a time."""
    found, begins = symbols(texts)
    text = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(begins))
    for at in range(0, len(found) - DEPTH, CHUNK):
        wide = found[at : at + CHUNK + DEPTH].astype(np.int64)
        size = len(wide) - DEPTH
        run = np.zeros(size, np.int64)
        for i in range(DEPTH + 1):
            run = (run << 8) | wide[i : i + size]
        real = wide[DEPTH:] != START
        yield run[real], text[at + DEPTH : at + DEPTH + size][real]


def count_runs(docs: DataFrame) -> DataFrame:
    """(run, n): how often the texts of ``docs`` (text, learn) that are learned from hold each run of
    DEPTH + 1 symbols. Runs that only the other texts have come with 0."""

    def counts(batches):
        runs, times = [], []

        def add(run, n):
            runs.append(run)
            times.append(n)

        def merged():
            every, back = np.unique(np.concatenate(runs), return_inverse=True)
            total = np.bincount(back, np.concatenate(times), len(every)).astype(np.int64)
            runs.clear()
            times.clear()
            return every, total

        def out(run, n):
            return pa.RecordBatch.from_arrays([pa.array(run), pa.array(n)], names=["run", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                learn = np.array(part.column("learn").to_pylist(), bool)
                for run, text in runs_of(part.column("text").to_pylist()):
                    used = learn[text]
                    add(*np.unique(run[used], return_counts=True))
                    other = np.unique(run[~used])
                    add(other, np.zeros(len(other), np.int64))
                    if sum(map(len, runs)) > FLUSH:
                        run, n = merged()
                        if len(run) > FLUSH // 2:
                            yield out(run, n)
                        else:
                            add(run, n)
        if runs:
            yield out(*merged())

    learned = docs.select("text", F.coalesce("learn", F.lit(False)).alias("learn"))
    return learned.mapInArrow(counts, "run long, n long").groupBy("run").agg(F.sum("n").alias("n"))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after moving small values up by eight."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def kt(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log block probability, and the probability that the next bit is one."""
    total = zeros + ones
    block = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(total + 1) - np.log(np.pi)
    return block, (ones + 0.5) / (total + 1)


class Cells(NamedTuple):
    """The cells of one depth by key (context, then place as in a heap), and whether they have a node."""

    depth: int
    keys: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    kept: np.ndarray


def cells(depth: int, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> Cells:
    """Summed by key. A context's first place has all its symbols."""
    held, at = np.unique(keys, return_inverse=True)
    # Without keys bincount gives whole numbers.
    zeros, ones = (np.bincount(at, x, len(held)).astype(float) for x in (zeros, ones))
    times = (zeros + ones)[np.searchsorted(held, held >> 8 << 8 | 1)]
    return Cells(depth, held, zeros, ones, (times >= LEAST) | (depth == 0))


def above(keys: np.ndarray, depth: int) -> np.ndarray:
    """The keys of the cells of ``depth`` on the way to these."""
    return keys & ((1 << 8 * (depth + 1)) - 1)


def place(run: np.ndarray, bit: int) -> np.ndarray:
    return 1 << bit | (run & 255) >> (8 - bit)


def levels_of(run: np.ndarray, n: np.ndarray, least: int) -> list[Cells]:
    """The cells of depths ``least`` to DEPTH of sorted or unsorted runs."""
    run, n = run[n > 0], n[n > 0]
    keys = np.concatenate([run >> 8 << 8 | place(run, i) for i in range(8)])
    bit = np.concatenate([run >> (7 - i) & 1 for i in range(8)])
    times = np.tile(n, 8)
    held = [cells(DEPTH, keys, times * (1 - bit), times * bit)]
    for depth in range(DEPTH - 1, least - 1, -1):
        low = held[0]
        held.insert(0, cells(depth, above(low.keys, depth), low.zeros, low.ones))
    return held


class Node(NamedTuple):
    """By cell: the weight of its own estimate, that estimate, and that of the child that rare ones share."""

    weight: np.ndarray
    one: np.ndarray
    rest: np.ndarray


def climb(levels: list[Cells], block: np.ndarray | None = None) -> tuple[list[Node], np.ndarray]:
    """Bottom up: the nodes, and the log block probabilities of the first level's cells.

    With ``block``, the last level's block probabilities, that level gets no nodes.
    """
    nodes: list[Node] = []
    for i in range(len(levels) - 1, -1, -1):
        level = levels[i]
        if i == len(levels) - 1 and block is not None:
            continue
        own, one = kt(level.zeros, level.ones)
        if level.depth == DEPTH:
            nodes.insert(0, Node(np.ones_like(own), one, one))
            block = own
            continue
        low = levels[i + 1]
        at = np.searchsorted(level.keys, above(low.keys[low.kept], level.depth))

        def summed(values: np.ndarray) -> np.ndarray:
            return np.bincount(at, values[low.kept], len(level.keys)).astype(float)

        rest_block, rest = kt(level.zeros - summed(low.zeros), level.ones - summed(low.ones))
        children = summed(block) + rest_block
        weight = 1 / (1 + np.exp(np.clip(children - own, -700, 700)))
        nodes.insert(0, Node(weight, one, rest))
        block = np.logaddexp(own, children) - np.log(2)
    return nodes, block


class Mix(NamedTuple):
    """By cell, predictions if the next context is a rare one, and if it has a node that lacks the place;
    what the depths so far add to the prediction, and how much the next one counts."""

    depth: int
    keys: np.ndarray
    kept: np.ndarray
    rare: np.ndarray
    fresh: np.ndarray
    fixed: np.ndarray
    scale: np.ndarray


def descend(levels: list[Cells], nodes: list[Node], over: Mix | None = None) -> list[Mix]:
    """Top down from the root, or from the level ``over`` the first."""
    found: list[Mix] = []
    for level, node in zip(levels, nodes):
        if over is None:
            fixed, scale = np.zeros(len(level.keys)), np.ones(len(level.keys))
        else:
            at = np.searchsorted(over.keys, above(level.keys, over.depth))
            fixed, scale = over.fixed[at], over.scale[at]
        fixed = fixed + scale * node.weight * node.one
        scale = scale * (1 - node.weight)
        over = Mix(
            level.depth, level.keys, level.kept, fixed + scale * node.rest, fixed + scale / 2, fixed, scale
        )
        found.append(over)
    return found


def find(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where sorted ``keys`` have what is asked for, -1 if nowhere."""
    if not len(keys):
        return np.full(len(asked), -1)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, at, -1)


def log_runs(mixes: list[Mix], run: np.ndarray) -> np.ndarray:
    """log10 probability of each run's last symbol after the others, from the mixes of all depths."""
    contexts, noded = [], []
    for mix in mixes:
        contexts.append(above(run >> 8 << 8, mix.depth))
        first = find(mix.keys, contexts[-1] | 1)
        noded.append(first >= 0)
        noded[-1][noded[-1]] = mix.kept[first[noded[-1]]]
    total = np.zeros(len(run))
    for i in range(8):
        one, fresh = np.full(len(run), 0.5), np.full(len(run), 0.5)
        live = np.ones(len(run), bool)
        for mix, context, there in zip(mixes, contexts, noded):
            at = find(mix.keys, context | place(run, i))
            lacking = live & there & (at < 0)
            one[lacking] = fresh[lacking]
            live &= there & (at >= 0)
            one[live], fresh[live] = mix.rare[at[live]], mix.fresh[at[live]]
        one = np.clip(one, 1e-12, 1 - 1e-12)
        total += np.log10(np.where(run >> (7 - i) & 1, one, 1 - one))
    return total


def fit(docs: DataFrame, folder: str) -> DataFrame:
    """(run, n, log): each run of ``docs`` (text, learn), its count in training and its log10 probability.

    Tables are stored in ``folder``.
    """
    spark = docs.sparkSession
    count_runs(docs).write.parquet(f"{folder}/runs")
    last = F.shiftright("run", 8).bitwiseAND((1 << 8 * TOP) - 1)
    runs = spark.read.parquet(f"{folder}/runs").withColumn("last", last)

    def arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return table.column("run").to_numpy(), table.column("n").to_numpy()

    def up(table: pa.Table) -> pa.Table:
        levels = levels_of(*arrays(table), TOP)
        _, block = climb(levels)
        top = levels[0]
        return pa.table({"cell": top.keys, "zeros": top.zeros, "ones": top.ones, "block": block})

    found = (
        runs.where(F.col("n") > 0)
        .groupBy("last")
        .applyInArrow(up, "cell long, zeros double, ones double, block double")
        .toArrow()
        .sort_by("cell")
    )
    keys, zeros, ones, block = (found.column(i).to_numpy() for i in range(4))
    levels = [cells(TOP, keys, zeros, ones)]
    for depth in range(TOP - 1, -1, -1):
        low = levels[0]
        levels.insert(0, cells(depth, above(low.keys, depth), low.zeros, low.ones))
    nodes, _ = climb(levels, block)
    held = spark.sparkContext.broadcast([tuple(m) for m in descend(levels[:TOP], nodes)])

    def down(table: pa.Table) -> pa.Table:
        top = [Mix(*m) for m in held.value]
        run, n = arrays(table)
        own = levels_of(run, n, TOP)
        mixes = top + descend(own, climb(own)[0], top[-1])
        return pa.table({"run": run, "n": n, "log": log_runs(mixes, run)})

    runs.groupBy("last").applyInArrow(down, "run long, n long, log double").write.parquet(
        f"{folder}/logs"
    )
    return spark.read.parquet(f"{folder}/logs")


class Frequent(NamedTuple):
    """Runs and their log probabilities, found through tables of places: what finds its place taken in
    one table is in the next. An empty place names the first run, which is not the one asked for."""

    run: np.ndarray
    log: np.ndarray
    tables: list[np.ndarray]


def spread(run: np.ndarray, number: int, size: int) -> np.ndarray:
    """A place below ``size``, a power of two, in table ``number``."""
    mixed = (run.view(np.uint64) + np.uint64(number)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed >> np.uint64(32)).astype(np.int64) & (size - 1)


def tabled(run: np.ndarray, log: np.ndarray) -> Frequent:
    left, tables = np.arange(len(run), dtype=np.int32), []
    while len(left):
        table = np.zeros(4 << int(len(left)).bit_length(), np.int32)
        at = spread(run[left], len(tables), len(table))
        table[at] = left
        tables.append(table)
        left = left[table[at] != left]
    return Frequent(run, log, tables)


def frequent(scores: DataFrame, most: int = MOST) -> tuple[Frequent, DataFrame]:
    """The most frequent runs, at most ``most``, which the driver gets; and the table of the others."""
    stepped = scores.withColumn("step", F.floor(STEPS * F.log2(F.col("n") + 1)).cast("int"))
    least = kept = 0
    for r in sorted(stepped.groupBy("step").count().collect(), key=lambda r: -r["step"]):
        kept += r["count"]
        if kept > most:
            least = r["step"] + 1
            break
    held = stepped.where(F.col("step") >= least).select("run", "log").toArrow()
    run, log = held.column("run").to_numpy(), held.column("log").to_numpy()
    return tabled(run, log.astype(np.float32)), stepped.where(F.col("step") < least).select("run", "log")


def look_up(held: Frequent, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities, zero where ``held`` lacks the run; and where that is."""
    log, left = np.zeros(len(run)), np.arange(len(run))
    for number, table in enumerate(held.tables):
        asked = run[left] if number else run
        at = table[spread(asked, number, len(table))]
        hit = held.run[at] == asked
        log[left[hit]] = held.log[at[hit]]
        left = left[~hit]
        if not len(left):
            break
    return log, left


def score_texts(held: Frequent, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, tuple]:
    """By text the log10 probability of what ``held`` has, and the number of symbols (bytes and the end);
    and the other runs as (text, run, how often), by text."""
    total, size = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    others = [np.zeros(0, np.int64)]
    for run, text in runs_of(texts):
        log, left = look_up(held, run)
        total += np.bincount(text, log, len(texts))
        size += np.bincount(text, minlength=len(texts))
        # A run has 48 bits, and a slice few texts.
        others.append(text[left].astype(np.int64) << 48 | run[left])
    pair, n = np.unique(np.concatenate(others), return_counts=True)
    return total, size, (pair >> 48, pair & ((1 << 48) - 1), n)
