"""Centroid clustering by Lloyd's rounds, sharded by dimension, in whole numbers.

A vector's components become floor(``SCALE`` * x). Vectors are packed into chunks, and a chunk's columns
are cut into blocks of ``BLOCK``; a shard is all blocks of the same columns. In each round

1. the tasks of each shard work out exact partial squared distances of its blocks to its own slice of the
   centroids, which is all of the centroids that they get;
2. the partial distances are shuffled by chunk, added over the blocks, and give each vector's nearest
   centroid, at equal distance the one with the smaller number;
3. each shard sums its blocks by cluster and moves its own slice to floor(sum / count). A cluster without
   vectors stays. Only the slices, 64 numbers a centroid, pass through the driver.

The shards are stored bucketed by chunk, so that the assignments, a byte or so a vector, are all that moves
when they meet the blocks again. Chunks are never merged or split, and each round ends in a written table.

Vectors with a null or non-finite component, of another width, or null are left out. A component's whole
number is held within +-``MOST``, so that all sums of squares fit 64 bits. A null id is no first centroid
unless ids run out; of rows with one id the lesser vector comes first. Repeated rows are vectors of their
own. Fewer vectors than centroids give as many centroids as vectors, and an empty table an empty result.
Other columns are left out.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 64
BLOCK = 16
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
#: What seeds the choice of the first centroids.
SEED = "3"
#: Vectors of a chunk. A chunk's blocks and distances are what a task holds of a group.
CHUNK = 4096
MOST = (1 << 27) - 1


def whole_numbers(vector: Column, width: int = WIDTH) -> Column:
    """A vector's whole numbers; null if it doesn't count."""
    x = F.transform(vector, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    ints = F.transform(
        x, lambda v: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(v * SCALE))).cast("int")
    )
    return F.when((F.size(vector) == width) & fine, ints)


def packed(vectors: DataFrame, width: int, block: int) -> DataFrame:
    """``vectors`` (vec_id, x) as chunks: (ids, blocks), a chunk's ids and its columns by blocks."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                x = part.column("x").flatten().to_numpy().astype("<i4").reshape(-1, width)
                blocks = [x[:, i : i + block].tobytes() for i in range(0, width, block)]
                ends = pa.array([0, part.num_rows], pa.int32())
                ids = pa.ListArray.from_arrays(ends, part.column("vec_id"))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([blocks], pa.list_(pa.binary()))], names=["ids", "blocks"]
                )

    return vectors.mapInArrow(run, f"ids array<{kind}>, blocks array<binary>")


def first_centroids(vectors: DataFrame, count: int) -> np.ndarray:
    """The vectors (vec_id, x) with the least hashes of their ids."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("vec_id").cast("string")), 256)
    found = vectors.select(digest.alias("digest"), "x").orderBy(F.asc_nulls_last("digest"), "x")
    return np.array([r["x"] for r in found.limit(count).collect()], np.int64)


def partial_distances(shard: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(chunk, partial) of a shard's rows (chunk, x); ``centroids`` is the shard's own slice."""
    count, width = centroids.shape

    def run(batches):
        for batch in batches:
            out = []
            for held in batch.column("x"):
                x = np.frombuffer(held.as_buffer(), "<i4").reshape(-1, width).astype(np.int64)
                sums = np.empty((len(x), count), np.int64)
                for k in range(count):
                    apart = x - centroids[k]
                    sums[:, k] = np.einsum("ij,ij->i", apart, apart)
                out.append(sums.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("chunk"), pa.array(out, pa.binary())], names=["chunk", "partial"]
            )

    return shard.select("chunk", "x").mapInArrow(run, "chunk long, partial binary")


def nearest(partials: DataFrame, count: int) -> DataFrame:
    """(chunk, cluster, distance): both packed, from the partial distances of all blocks."""

    def add(key: tuple, group: pa.Table) -> pa.Table:
        total = 0
        for held in group.column("partial"):
            total = total + np.frombuffer(held.as_buffer(), np.int64).reshape(-1, count)
        at = total.argmin(axis=1)
        distance = total[np.arange(len(at)), at]
        cluster = at.astype(np.min_scalar_type(max(0, count - 1)).newbyteorder("<"))
        return pa.table(
            {
                "chunk": key[:1],
                "cluster": pa.array([cluster.tobytes()], pa.binary()),
                "distance": pa.array([distance.tobytes()], pa.binary()),
            }
        )

    return partials.groupBy("chunk").applyInArrow(add, "chunk long, cluster binary, distance binary")


def moved(shards: DataFrame, assigned: DataFrame, centroids: np.ndarray, block: int) -> np.ndarray:
    """The centroids after each shard has moved its slice; a cluster without vectors stays."""
    count, width = centroids.shape
    kind = np.min_scalar_type(max(0, count - 1)).newbyteorder("<")

    def sums(batches):
        # One row for each block, cluster and column that the task saw.
        total = np.zeros((width, count), np.int64)
        seen = np.zeros((width, count), np.int64)
        for batch in batches:
            rows = zip(batch.column("block").to_pylist(), batch.column("x"), batch.column("cluster"))
            for at, held, cluster in rows:
                first, last = at * block, min(width, (at + 1) * block)
                x = np.frombuffer(held.as_buffer(), "<i4").reshape(-1, last - first)
                of = np.frombuffer(cluster.as_buffer(), kind)
                for k in np.unique(of):
                    own = x[of == k]
                    total[first:last, k] += own.sum(axis=0, dtype=np.int64)
                    seen[first:last, k] += len(own)
        at, k = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a) for a in (at, k, total[at, k], seen[at, k])],
            names=["at", "cluster", "total", "n"],
        )

    both = shards.join(assigned.select("chunk", "cluster"), "chunk").select("block", "x", "cluster")
    slices = (
        both.mapInArrow(sums, "at long, cluster long, total long, n long")
        .groupBy("at", "cluster")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        # The quotient, rounded down also below zero.
        .select("at", "cluster", F.expr("(total - pmod(total, n)) DIV n").alias("mean"))
    )
    new = centroids.copy()
    for row in slices.collect():
        new[row["cluster"], row["at"]] = row["mean"]
    return new


def lloyd(
    chunks: DataFrame, centroids: np.ndarray, folder: str, rounds: int = ROUNDS, block: int = BLOCK
) -> tuple[DataFrame, np.ndarray]:
    """(chunk, cluster, distance) of ``chunks`` (chunk, blocks) and the last centroids."""
    spark = chunks.sparkSession
    count, width = centroids.shape
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"clusters_{uuid.uuid4().hex}"
    (
        chunks.select("chunk", F.posexplode("blocks").alias("block", "x"))
        .repartition(buckets, "chunk")
        .write.bucketBy(buckets, "chunk")
        .option("path", f"{folder}/shards")
        .saveAsTable(name)
    )
    try:
        shards = spark.table(name)
        for turn in range(rounds + 1):
            parts = [
                partial_distances(shards.where(F.col("block") == b), centroids[:, i : i + block])
                for b, i in enumerate(range(0, width, block))
            ]
            partials = parts[0]
            for more in parts[1:]:
                partials = partials.unionByName(more)
            nearest(partials, count).write.parquet(f"{folder}/assigned{turn}")
            assigned = spark.read.parquet(f"{folder}/assigned{turn}")
            if turn < rounds:
                centroids = moved(shards, assigned, centroids, block)
    finally:
        # The table's files are the caller's; only its name goes.
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return assigned, centroids


def cluster(
    vectors: DataFrame,
    folder: str,
    key: str = "vec_id",
    vector: str = "embedding",
    count: int = CENTROIDS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that counts."""
    spark = vectors.sparkSession
    kept = vectors.select(
        F.col(key).alias("vec_id"), whole_numbers(F.col(vector), width).alias("x")
    ).where(F.col("x").isNotNull())
    kind = kept.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(kept, count)
    if not len(centroids):
        return spark.createDataFrame(
            [],
            f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long,"
            " centroid_sha256 string",
        )
    chunks = packed(kept, width, block).withColumn("chunk", F.monotonically_increasing_id())
    chunks.write.parquet(f"{folder}/chunks")
    chunks = spark.read.parquet(f"{folder}/chunks")
    assigned, centroids = lloyd(chunks.select("chunk", "blocks"), centroids, folder, rounds, block)
    small = np.min_scalar_type(max(0, len(centroids) - 1)).newbyteorder("<")

    def spread(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                of, far = (batch.column(c)[i].as_buffer() for c in ("cluster", "distance"))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[i].values,
                        pa.array(np.frombuffer(of, small).astype(np.int32)),
                        pa.array(np.frombuffer(far, np.int64)),
                    ],
                    names=["vec_id", "cluster", "distance"],
                )

    rows = (
        chunks.select("chunk", "ids")
        .join(assigned, "chunk")
        .select("ids", "cluster", "distance")
        .mapInArrow(spread, f"vec_id {kind}, cluster int, distance long")
    )
    rows.write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    # One row for each centroid that has vectors.
    sums = {
        r["cluster"]: r["s"]
        for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()
    }
    whole = sum(sums.values())
    named = [
        (k, s, whole, hashlib.sha256(",".join(map(str, centroids[k].tolist())).encode()).hexdigest())
        for k, s in sums.items()
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return rows.join(F.broadcast(spark.createDataFrame(named, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
