"""Python work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Rows and text bytes that are worked on at once, so that memory doesn't follow the batch size.
SLICE_ROWS = 2000
SLICE_BYTES = 16_000_000


def slices(batch: pa.RecordBatch, text: str | None = None) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch``: few rows, and few bytes unless a single text is larger."""
    if text is None:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start = held = 0
    for at, size in enumerate(sizes):
        if at > start and (held + size > SLICE_BYTES or at - start >= SLICE_ROWS):
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)


def map_slices(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: str,
    text: str = "text",
) -> DataFrame:
    """Applies what ``make`` returns, called once in each task, to every slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, text):
                yield work(part)

    return df.mapInArrow(run, schema)


class Rows(dict):
    """Numbers for keys, made when first asked for, and a table of what ``of`` gave for each key.

    ``trim`` forgets everything once there are more than ``most`` keys, which bounds the memory.
    """

    def __init__(self, of: Callable, most: int, dtype, width: tuple[int, ...] = ()):
        super().__init__()
        self.of, self.most, self.fresh = of, most, []
        self.empty = self.held = np.zeros((0, *width), dtype)

    def __missing__(self, key):
        self[key] = at = len(self.held) + len(self.fresh)
        self.fresh.append(self.of(key))
        return at

    def numbers(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))

    def table(self) -> np.ndarray:
        if self.fresh:
            self.held = np.concatenate([self.held, np.array(self.fresh, self.held.dtype)])
            self.fresh.clear()
        return self.held

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()
            self.fresh.clear()
            self.held = self.empty
