"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

The words of a source are laid out in shards (its documents by a seeded hash of id, size and text), and
each shard in blocks of ``block`` words, the last one shorter. A source of n documents has about the root
of n shards with about as many documents each, so neither a shard nor a source's list of them is large. Blocks are the seats: first among sources by target, then
among each source's shards by their number of blocks, each time by the highest quotients w / (2k + 1).
A shard with quota q and n blocks takes its blocks at even strides from a seeded start, each of them
floor(q / n) or ceil(q / n) times. How many taken words stand before a place in the shard follows from
the place alone, so no row per block is made.

Null texts have no words, and take none. A null source is a source, ranked last. Null and repeated ids are
told apart by their texts; rows equal in both share a shard, as separate documents of equal size. A very
long text is one row of one shard. Empty tables and sources without words have targets of 0. Results
depend on ids, texts, sources and the seed only; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.text import blank_words, small
from lamina.session import work_dir

#: Fixed values of the contract.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0


def highest_quotients(parties: DataFrame, group: str, party: str) -> DataFrame:
    """``parties`` (group, party, weight, seats) with ``quota``: Sainte-Laguë in each group.

    Party i has at least floor(w(Q - n/2)/W + 1/2) and at most floor(w(Q + n/2)/W + 1/2) of Q seats,
    for n parties of total weight W. Only the seats in between, about n of them, are ranked by quotient.
    """
    of_group = Window.partitionBy(group)
    sized = (
        parties.withColumn("n", F.count(F.lit(1)).over(of_group))
        .withColumn("total", F.sum(F.col("weight").cast("double")).over(of_group))
        .withColumn("share", F.when(F.col("total") > 0, F.col("weight") / F.col("total")).otherwise(0.0))
        .withColumn("half", F.col("n") / 2)
    )
    least = F.floor(F.col("share") * (F.col("seats") - F.col("half")) + 0.5) - 1
    most = F.floor(F.col("share") * (F.col("seats") + F.col("half")) + 0.5) + 1
    bounded = sized.withColumn(
        "base", F.when(F.col("share") > 0, F.greatest(least, F.lit(0))).otherwise(0).cast("long")
    ).withColumn("top", F.when(F.col("share") > 0, most).otherwise(0).cast("long"))
    ranked = bounded.withColumn("left", F.col("seats") - F.sum("base").over(of_group))
    seats = ranked.where(F.col("top") > F.col("base")).select(
        group, party, "weight", "left", F.explode(F.sequence("base", F.col("top") - 1)).alias("k")
    )
    by_quotient = Window.partitionBy(group).orderBy(
        F.desc(F.col("weight") / (2 * F.col("k") + 1)), F.col(party)
    )
    won = (
        seats.withColumn("place", F.row_number().over(by_quotient))
        .where(F.col("place") <= F.col("left"))
        .groupBy(group, party)
        .agg(F.count(F.lit(1)).alias("won"))
        .select(F.col(group).alias("__g"), F.col(party).alias("__p"), "won")
    )
    same = ranked[group].eqNullSafe(won["__g"]) & ranked[party].eqNullSafe(won["__p"])
    return ranked.join(won, same, "left").select(
        *[ranked[c] for c in parties.columns],
        (F.col("base") + F.coalesce("won", F.lit(0))).alias("quota"),
    )


def source_targets(
    sources: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
) -> DataFrame:
    """``sources`` (source, source_size) with ``target`` words.

    Weights go round the sources by code point, null last. All targets are min(cap * size, level *
    weight) with the level at which they add up to ``share`` of all words: sources are taken by
    size / weight, and are capped as long as the level that is left for the others is above them.
    One row per source meets in one task here.
    """
    ranked = sources.withColumn(
        "at", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    )
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") % len(weights)).cast("int") + 1
    )
    held = ranked.withColumn("weight", weight).withColumn("most", cap * F.col("source_size"))
    every = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), "at").rowsBetween(
        Window.unboundedPreceding, -1
    )
    level = (
        (share * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    )
    met = held.withColumn("level", level).withColumn(
        "free", F.col("most") / F.col("weight") > F.col("level")
    )
    last = met.withColumn(
        "level",
        F.min(
            F.when(F.col("free"), F.struct(F.col("most") / F.col("weight"), "at", "level"))
        ).over(every)["level"],
    )
    target = F.when(F.col("free"), F.least("most", F.col("level") * F.col("weight")))
    return last.select("source", "source_size", target.otherwise(F.col("most")).alias("target"))


def in_shards(docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` (doc_id, size, print, shards) with ``shard``, and ``at``, by which a shard is in order."""
    at = F.xxhash64("doc_id", "size", "print", F.lit(seed))
    shard = F.pmod(F.xxhash64("at", F.lit(seed + 1)), F.col("shards"))
    return docs.withColumn("at", at).withColumn("shard", shard)


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    block: int = 16,
    seed: int = 0,
    broadcast_rows: int = 100_000,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, and ``chosen``.

    ``chosen`` lists the document's stretches (start, end, times) in words; nothing is worked out for it
    unless it is read. The table of sources is broadcast while it has at most ``broadcast_rows`` rows and
    joined else.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "mix")
    docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        F.size(blank_words(F.col(text))).cast("long").alias("size"),
        F.xxhash64(F.col(text), F.lit(seed)).alias("print"),
    ).write.parquet(f"{folder}/sizes")
    sizes = spark.read.parquet(f"{folder}/sizes")

    by_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")
    )
    shard_count = F.ceil(F.sqrt("docs")).cast("long")
    targets = source_targets(by_source.select("source", "source_size"), weights, share, cap)
    both = by_source.select(F.col("source").alias("__s"), shard_count.alias("shards"))
    targets.join(both, targets["source"].eqNullSafe(both["__s"])).drop("__s").write.parquet(
        f"{folder}/targets"
    )
    held = spark.read.parquet(f"{folder}/targets")
    side = held.withColumnRenamed("source", "__s")
    if small(held, broadcast_rows):
        side = F.broadcast(side)
    placed = in_shards(sizes.join(side, F.col("source").eqNullSafe(F.col("__s"))).drop("__s"), seed)

    shards = (
        placed.groupBy("source", "shard")
        .agg(F.sum("size").alias("words"), F.first("source_size").alias("source_size"),
             F.first("target").alias("target"))
        .withColumn("weight", F.ceil(F.col("words") / block))
    )
    shards.write.parquet(f"{folder}/shards")
    shards = spark.read.parquet(f"{folder}/shards")
    ideal = F.when(
        F.first("source_size") > 0,
        F.first("target") / F.first("source_size") * F.sum("weight"),
    ).otherwise(0.0)
    parties = (
        shards.groupBy("source")
        .agg(ideal.alias("weight"), F.sum("weight").alias("blocks"))
        .withColumn("all", F.lit(0))
        .withColumn(
            "seats", F.round(F.sum("weight").over(Window.partitionBy("all"))).cast("long")
        )
    )
    quotas = highest_quotients(parties, "all", "source").select(
        F.col("source").alias("__s"),
        F.least("quota", F.floor(cap * F.col("blocks"))).alias("seats"),
    )
    seated = shards.join(quotas, shards["source"].eqNullSafe(quotas["__s"])).select(
        "source", "shard", "weight", "seats"
    )
    highest_quotients(seated, "source", "shard").select(
        F.col("source").alias("__s"), F.col("shard").alias("__h"), F.col("weight").alias("n"), "quota"
    ).write.parquet(f"{folder}/quotas")
    per_shard = spark.read.parquet(f"{folder}/quotas")

    in_shard = Window.partitionBy("source", "shard").orderBy("at", "doc_id", "size", "print")
    laid = placed.withColumn(
        "end", F.sum("size").over(in_shard.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("start", F.col("end") - F.col("size"))
    same = F.col("source").eqNullSafe(F.col("__s")) & (F.col("shard") == F.col("__h"))
    joined = laid.join(per_shard, same, "left").withColumn(
        "first", F.pmod(F.xxhash64("source", "shard", F.lit(seed + 2)), F.greatest("n", F.lit(1)))
    )

    def div(a: Column, b: Column) -> Column:
        return F.call_function("div", a, b)

    def seats_before(i: Column) -> Column:
        return div(i * F.col("quota") + F.col("first"), F.greatest("n", F.lit(1)))

    def times(i: Column) -> Column:
        return seats_before(i + 1) - seats_before(i)

    def words_before(place: str) -> Column:
        i = div(F.col(place), F.lit(block))
        return seats_before(i) * block + (F.col(place) - i * block) * times(i)

    i0 = div(F.col("start"), F.lit(block))
    i1 = div(F.col("end") - 1, F.lit(block))
    stretches = F.filter(
        F.transform(
            F.sequence(i0, i1),
            lambda i: F.struct(
                F.greatest(i * block - F.col("start"), F.lit(0)).alias("start"),
                F.least((i + 1) * block - F.col("start"), F.col("size")).alias("end"),
                times(i).alias("times"),
            ),
        ),
        lambda x: x["times"] > 0,
    )
    return joined.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (words_before("end") - words_before("start")).alias("taken"),
        F.when(F.col("size") > 0, stretches).alias("chosen"),
    )
