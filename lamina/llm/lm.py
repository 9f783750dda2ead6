"""Scores of texts under the context tree (``ctw``) beside a smoothed count of whole tokens.

Tokens are words between blanks, A-Z lowered, then one end. The counts are those of all training texts.
A token's log10 probability is needed for every token of every document. Tokens that make up at least
1 / ``HEAD`` of the training tokens, at most that many, are broadcast as sorted hashes; for the rest each
document's distinct tokens are shuffled to their counts, and their sums back to the document. Likewise for
the tree's runs of symbols: the most frequent are broadcast, the rest shuffled.

Tokens are told apart by 64-bit hashes. A very long text is one row and is scored in stretches; its distinct
rare tokens and runs are held in memory.

Null texts are empty and have the end alone. A null id counts as the empty text where rows are parted.
Repeated rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm import ctw
from lamina.llm.arrow import Rows, map_slices

HEAD = 1 << 20
CACHE = 400_000
FLUSH = 400_000
#: The seed of Spark's xxhash64.
SEED = 42
#: Holds a blank, so it is no word.
END_TOKEN = b" "


def tokens(text: str | None) -> list[bytes]:
    """bytes.lower and bytes.split know A-Z and the six blanks only."""
    return [*(text or "").encode().lower().split(), END_TOKEN]


def count_tokens(train: DataFrame) -> DataFrame:
    """(token, n) over ``train`` (text)."""

    def counts(batches):
        found: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                names=["token", "n"],
            )
            found.clear()
            return out

        for batch in batches:
            for text in batch.column("text"):
                found.update(tokens(text.as_py()))
                if len(found) > FLUSH:
                    yield flush()
        yield flush()

    return train.mapInArrow(counts, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def score(
    docs: DataFrame,
    train: Column,
    folder: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` of every row with its scores, learned from the rows where ``train`` holds.

    n_tokens, n_known (tokens that training has), train_tokens, base_score, score (log10 probability of
    the text's bytes and its end), n_symbols (both), bits_per_byte. Intermediate tables go to ``folder``.
    """
    spark = docs.sparkSession
    learned = docs.where(train).select(F.col(text).alias("text"))
    count_tokens(learned).select("n", F.xxhash64("token").alias("hash")).write.parquet(f"{folder}/tokens")
    counted = spark.read.parquet(f"{folder}/tokens")
    n_all, distinct = counted.agg(F.sum("n"), F.count("n")).first()
    n_all = n_all or 0
    least = max(1, -(-n_all // HEAD))
    top = counted.where(F.col("n") >= least).toArrow()
    order = np.argsort(top.column("hash").to_numpy())
    head = top.column("hash").to_numpy()[order], top.column("n").to_numpy()[order]
    smooth = n_all + 0.1 * (distinct + 1)
    marked = docs.select(F.col(text).alias("text"), train.alias("learn"))
    most, rare = ctw.frequent(ctw.fit(marked, folder))
    held = spark.sparkContext.broadcast((head, tuple(most)))

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    source = docs.select(
        *keep, F.monotonically_increasing_id().alias("__row"), F.col(text).alias("__text")
    )

    def make():
        (hashes, times), known_runs = held.value[0], ctw.Frequent(*held.value[1])
        rows = Rows(lambda t: xxhash.xxh64_intdigest(t, SEED), CACHE, np.uint64)

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = part.column("__text").to_pylist()
            rows.trim()
            found = [Counter(tokens(t)) for t in texts]
            ids = rows.numbers([t for c in found for t in c])
            own = rows.table()[ids].view(np.int64)
            n = np.array([x for c in found for x in c.values()], np.int64)
            row = np.repeat(np.arange(len(found)), [len(c) for c in found])
            at = np.searchsorted(hashes, own)
            at[at == len(hashes)] = 0
            known = hashes[at] == own if len(hashes) else np.zeros(len(own), bool)
            logs = np.log10((times[at[known]] + 0.1) / smooth)
            size = len(texts)
            rest = ~known
            rest_sizes = np.bincount(row[rest], minlength=size)
            ends = pa.array(np.concatenate([[0], np.cumsum(rest_sizes)]), pa.int32())
            code, symbols, (of, run, often) = ctw.score_texts(known_runs, texts)
            run_ends = pa.array(np.searchsorted(of, np.arange(size + 1)), pa.int32())
            columns = [part.column(i) for i in range(len(keep) + 1)]
            more = [
                pa.array(np.bincount(row, n, size).astype(np.int64)),
                pa.array(np.bincount(row[known], n[known], size).astype(np.int64)),
                pa.array(np.bincount(row[known], n[known] * logs, size), pa.float64()),
                pa.array(code, pa.float64()),
                pa.array(symbols),
                pa.ListArray.from_arrays(ends, pa.array(own[rest])),
                pa.ListArray.from_arrays(ends, pa.array(n[rest])),
                pa.ListArray.from_arrays(run_ends, pa.array(run)),
                pa.ListArray.from_arrays(run_ends, pa.array(often)),
            ]
            names = ["n_tokens", "head_known", "head_score", "head_code", "symbols"]
            names += ["rest", "rest_n", "runs", "runs_n"]
            return pa.RecordBatch.from_arrays([*columns, *more], names=[*keep, "__row", *names])

        return work

    schema = (
        f"{kept}, __row long, n_tokens long, head_known long, head_score double, head_code double, "
        "symbols long, rest array<long>, rest_n array<long>, runs array<long>, runs_n array<long>"
    )
    map_slices(source, make, schema, "__text").write.parquet(f"{folder}/scored")
    scored = spark.read.parquet(f"{folder}/scored")
    rest = scored.select("__row", F.explode(F.arrays_zip("rest", "rest_n")).alias("r")).select(
        "__row", F.col("r.rest").alias("hash"), F.col("r.rest_n").alias("times")
    )
    tail = counted.where(F.col("n") < least)
    count = F.coalesce("n", F.lit(0))
    by_row = (
        rest.join(tail, "hash", "left")
        .groupBy("__row")
        .agg(
            F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("tail_known"),
            F.sum(F.col("times") * F.log10((count + 0.1) / F.lit(smooth))).alias("tail_score"),
        )
    )
    asked = scored.select("__row", F.explode(F.arrays_zip("runs", "runs_n")).alias("r")).select(
        "__row", F.col("r.runs").alias("run"), F.col("r.runs_n").alias("times")
    )
    code = (
        asked.join(rare, "run")
        .groupBy("__row")
        .agg(F.sum(F.col("times") * F.col("log")).alias("tail_code"))
    )
    base = F.col("head_score") + F.coalesce("tail_score", F.lit(0.0))
    whole = F.col("head_code") + F.coalesce("tail_code", F.lit(0.0))
    narrow = scored.drop("rest", "rest_n", "runs", "runs_n")
    return narrow.join(by_row, "__row", "left").join(code, "__row", "left").select(
        *keep,
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        whole.alias("score"),
        F.col("symbols").alias("n_symbols"),
        (-whole * math.log2(10) / F.col("symbols")).alias("bits_per_byte"),
    )
