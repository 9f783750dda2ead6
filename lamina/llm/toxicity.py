"""Toxicity scores: logistic regression over hashed word n-grams and skip-grams, fitted by FTRL-proximal.

Features are a text's distinct words, pairs of neighbours, and pairs with one or two words between them,
hashed to ``2 ** BITS`` places. FTRL keeps a learning rate for each place, and its L1 term leaves most
weights at zero; the rest, at most ``2 ** BITS``, are broadcast.

The model is fitted on a bounded sample of labelled rows: about ``sample_rows`` of them, picked by the
hash of their ids, and where rows share ids by the hash of id and text, equal ones once. They are dealt to
shards of about ``SHARD_ROWS``, each of which runs FTRL for some
epochs in a task of its own; the weights are the shards' mean. Scoring reads every whole text.

Null and empty texts have no features and get the score of the bias. Rows with a null label teach
nothing; of several labels for an id the highest counts. Without labels every score is 0.5, which counts
as toxic by the contract's threshold. Repeated rows get equal scores. An empty table gives an empty
result. A very long text is one row, of which the distinct features count. Other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.arrow import Rows, map_slices

WORDS = re.compile(r"\w+")
BITS = 20
SKIPS = (1, 2, 3)
SHARD_ROWS = 5000
CACHE = 500_000


def hasher():
    """A function from texts to their features' places, sorted and distinct."""
    rows = Rows(lambda w: zlib.crc32(w.encode()), CACHE, np.uint64)

    def features(texts: list[str | None]) -> list[np.ndarray]:
        rows.trim()
        ids = [rows.numbers(WORDS.findall(t.lower()) if t else []) for t in texts]
        hashes = rows.table()
        return [places(hashes[i]) for i in ids]

    return features


def places(words: np.ndarray) -> np.ndarray:
    """Distinct places of the words' features; ``words`` are 32-bit hashes in text order."""
    odd = np.uint64(0x9E3779B97F4A7C15)
    parts = [words * odd]
    for skip in SKIPS:
        if len(words) > skip:
            pair = words[:-skip] * np.uint64(0xC2B2AE3D27D4EB4F) + words[skip:] + np.uint64(skip << 40)
            parts.append((pair ^ (pair >> np.uint64(29))) * odd)
    return np.unique(np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int32)


def ftrl(
    rows: list[tuple[np.ndarray, int]], epochs: int, alpha: float, beta: float, l1: float, l2: float
) -> tuple[np.ndarray, float]:
    """Weights by place and the bias, which isn't regularised."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = bias = 0.0

    def weights(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        steep = (beta + np.sqrt(n[at])) / alpha + l2
        return np.where(np.abs(zs) > l1, (np.sign(zs) * l1 - zs) / steep, 0.0)

    for _ in range(epochs):
        for at, label in rows:
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
            g = p - label
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / alpha * bias
            bias_n += g * g
            bias = -bias_z / ((beta + np.sqrt(bias_n)) / alpha)
    return weights(np.arange(1 << BITS)), bias


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample_rows: int = 20_000,
    epochs: int = 15,
    alpha: float = 2.0,
    beta: float = 1.0,
    l1: float = 8.0,
    l2: float = 0.0,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Places with weights, the weights, and the bias."""
    named = (
        labels.select(F.col(key).alias("__id"), F.col(label).cast("int").alias("__label"))
        .where(F.col("__label").isNotNull() & F.col("__id").isNotNull())
        .groupBy("__id")
        .agg(F.max("__label").alias("__label"))
    )
    total = named.count()
    nothing = np.zeros(0, np.int32), np.zeros(0, np.float64), 0.0
    if not total:
        return nothing
    at = F.pmod(F.xxhash64("__id"), F.lit(1 << 30))
    drawn = named.where(at < int(min(1.0, sample_rows / total) * (1 << 30)))
    # About sample_rows rows of two numbers.
    rows = docs.select(F.col(key).alias("__id"), F.col(text).alias("text")).join(
        F.broadcast(drawn), "__id"
    )
    # Rows that share a drawn id all come in, so what came in is drawn from again.
    share = min(1.0, sample_rows / max(1, rows.select("__id").count()))
    again = F.pmod(F.xxhash64("__id", "text", F.lit(3)), F.lit(1 << 30))
    rows = rows.where(again < int(share * (1 << 30))).distinct()
    shards = max(1, round(min(total, sample_rows) / SHARD_ROWS))
    dealt = rows.select(
        F.pmod(F.xxhash64("__id", "text", F.lit(1)), F.lit(shards)).cast("int").alias("shard"),
        F.xxhash64("__id", "text", F.lit(2)).alias("at"),
        F.col("__label").alias("label"),
        "text",
    )

    def make():
        features = hasher()

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            found = features(part.column("text").to_pylist())
            return pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), pa.array(found, pa.list_(pa.int32()))],
                names=["shard", "at", "label", "found"],
            )

        return work

    def train(table: pa.Table) -> pa.Table:
        ordered = table.sort_by([("at", "ascending")])
        held = [
            (np.asarray(f, np.int64), y)
            for f, y in zip(
                (x.values.to_numpy(zero_copy_only=False) for x in ordered.column("found")),
                ordered.column("label").to_pylist(),
            )
        ]
        w, bias = ftrl(held, epochs, alpha, beta, l1, l2)
        at = np.flatnonzero(w)
        return pa.table(
            {"place": pa.array([-1, *at], pa.int32()), "weight": pa.array([bias, *w[at]], pa.float64())}
        )

    featured = map_slices(dealt, make, "shard int, at long, label int, found array<int>")
    learned = featured.groupBy("shard").applyInArrow(train, "place int, weight double")
    mean = learned.groupBy("place").agg((F.sum("weight") / shards).alias("weight")).toArrow()
    place = mean.column("place").to_numpy()
    weight = mean.column("weight").to_numpy()
    order = np.argsort(place)
    place, weight = place[order], weight[order]
    if not len(place):
        return nothing
    return place[1:], weight[1:], float(weight[0])


def score(docs: DataFrame, model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row, score and predicted."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def make():
        place, weight, bias = held.value
        table = np.zeros(1 << BITS, np.float32)
        table[place] = weight
        features = hasher()

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            found = features(part.column("__text").to_pylist())
            sums = np.array([table[f].sum() for f in found]) + bias
            scores = 1 / (1 + np.exp(-np.clip(sums.astype(np.float64), -35, 35)))
            columns = [part.column(i) for i in range(len(keep))]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))],
                names=[*keep, "score", "predicted"],
            )

        return work

    return map_slices(source, make, f"{schema}, score double, predicted int", "__text")
