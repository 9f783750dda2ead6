"""Periodic runs of words, by a sparse diagonal table.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) of at least
``LEAST`` words and two periods, which no neighbouring word extends at that period. In the table of all
pairs of words it is a diagonal of lag q whose matches go on for q places at least, and for ``WINDOW``.

Words are therefore taken with those that follow, as grams of ``WINDOW``, twice, four times as many words
and so on: grams of k words serve the lags below 2k (from k on, but for the first). A gram's earlier
occurrences in that reach open diagonals where the words before differ; within a stretch that repeats
itself they don't, so that each diagonal is opened once. Its match length then grows in strides, by the
longest equal grams first, and it gives its run at once if it is long enough. Of diagonals that end in one
and the same stretch the least lag is the period. Grams of k words stand in less than 2k places in few
ways unless they repeat themselves, so a text of n words takes some n log n steps, also if it is one word
over and over, where a table that is filled word by word takes n squared.

Words are parted by blanks. Null and empty texts have no words and no runs. A text is worked on in one
task, in memory that follows its length. Repeated rows give repeated rows, rows do not touch each other,
and an empty table gives an empty result. The columns to keep may have any name but ``runs`` and ``kept``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.arrow import map_slices

#: Words that a run has at least.
LEAST = 12
#: A run's diagonal has at least max(q, LEAST - q) matches, hence so many.
WINDOW = LEAST // 2
TABLE = "runs array<struct<start:long,length:long,period:long>>, kept string"


def ranked(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each pair (left[i], right[i]), the same for equal pairs; the places in the order of
    their numbers, then of themselves; and where in that order each number begins."""
    key = left * (int(right.max()) + 1) + right
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order, new


def opened(
    before: np.ndarray, order: np.ndarray, new: np.ndarray, least: int, reach: int
) -> tuple[np.ndarray, np.ndarray]:
    """(earlier, later) places of equal grams, ``least`` to ``reach`` - 1 apart, after different words."""
    at = np.arange(len(order))
    group = np.maximum.accumulate(np.where(new, at, 0))
    prior = before[order]
    # Neighbours of one gram after the same word are skipped together.
    turn = new.copy()
    turn[1:] |= prior[1:] != prior[:-1]
    block = np.maximum.accumulate(np.where(turn, at, 0))
    later = np.flatnonzero(block > group)
    other = block[later] - 1
    found = [np.zeros((2, 0), np.int64)]
    while len(later):
        lag = order[later] - order[other]
        near = lag < reach
        later, other, lag = later[near], other[near], lag[near]
        held = (lag >= least) & (prior[other] != prior[later])
        found.append(np.stack([order[other[held]], order[later[held]]]))
        # A block after the same word opens nothing and is passed over in one step.
        other = np.where(prior[other] == prior[later], block[other], other) - 1
        left = other >= group[later]
        later, other = later[left], other[left]
    earlier, later = np.concatenate(found, axis=1)
    return earlier, later


def runs_of(words: np.ndarray) -> np.ndarray:
    """(start, length, period) of every run in a text's word numbers, by start, then period."""
    n = len(words)
    none = np.zeros((0, 3), np.int64)
    if n < LEAST:
        return none
    before = np.concatenate([[-1], words[:-1]])
    pairs, _, _ = ranked(words[:-1], words[1:])
    number, _, _ = ranked(pairs[:-1], words[2:])
    size = WINDOW // 2
    grams, found = [], []
    while 2 * size <= n:
        number, order, new = ranked(number[:-size], number[size:])
        size *= 2
        if new.all():
            break
        grams.append((size, number))
        if 2 * size <= n:
            least = 1 if size == WINDOW else size
            found.append(opened(before[: len(order)], order, new, least, 2 * size))
    if not found:
        return none
    earlier, later = np.concatenate(found, axis=1)
    length = np.zeros(len(later), np.int64)
    for size, number in reversed(grams):
        open_ = np.flatnonzero(later + length + size <= n)
        a, b = earlier[open_] + length[open_], later[open_] + length[open_]
        length[open_] += size * (number[a] == number[b])
    going = np.arange(len(later))
    for _ in range(WINDOW - 1):
        going = going[later[going] + length[going] < n]
        a, b = earlier[going] + length[going], later[going] + length[going]
        going = going[words[a] == words[b]]
        length[going] += 1
    lag = later - earlier
    enough = length >= np.maximum(lag, LEAST - lag)
    start, lag = earlier[enough], lag[enough]
    stretch = lag + length[enough]
    order = np.lexsort((lag, stretch, start))
    runs = np.stack([start[order], stretch[order], lag[order]], axis=1)
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds beyond its first period, joined by one blank."""
    if not len(runs):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    free = np.flatnonzero(np.cumsum(step[:-1]) == 0)
    return b" ".join([words[i] for i in free])


def text_runs(text: str | None) -> tuple[np.ndarray, bytes]:
    """A text's runs, and the text without what they repeat."""
    words = (text or "").encode().split()
    numbers: dict[bytes, int] = {}
    at = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    runs = runs_of(at)
    return runs, collapsed(words, runs)


def find_runs(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row, its ``runs``, and ``kept``, the text without repeated periods."""
    source = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def make():
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            found = [text_runs(t) for t in part.column("__text").to_pylist()]
            ends = np.cumsum([0, *(len(runs) for runs, _ in found)])
            rows = np.concatenate([runs for runs, _ in found]) if found else np.zeros((0, 3), np.int64)
            structs = pa.StructArray.from_arrays(
                [pa.array(rows[:, i]) for i in range(3)], names=["start", "length", "period"]
            )
            runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)
            kept = pa.array([k.decode() for _, k in found], pa.string())
            columns = [part.column(i) for i in range(len(keep))]
            return pa.RecordBatch.from_arrays(
                [*columns, runs, kept], names=[*keep, "runs", "kept"]
            )

        return work

    return map_slices(source, make, f"{schema}, {TABLE}", "__text")
