"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are ``width`` consecutive words, or the whole item if it has fewer. A window is the set
of its shingles (``shingle`` words, or the whole window if it has fewer) at their places. One pass over
the documents keeps the places where a shingle of the benchmark stands. Then shingles are ordered by how
often they occur in all documents; a window must bring its rarest one, its prefix token (for exact
containment one token is enough). Joining prefix tokens alone gives the candidates: a document, an item
and the offset between both. Windows that would reach over an end of the document fall by the positional
bound, and the rest are verified: the shingles found at that offset must hold every shingle of a window.

Null texts have no words; items without words have no windows. Documents and items are told apart by id,
which may be null, and text, so that two texts under one id are two; a repeated row of a document gives a
result row again, and one of an item counts once. A long text is one row until it is exploded into its
shingles. Empty tables are fine; other columns are left out.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.text import NOT_ALNUM, ascii_lower, let, or_empty, pieces, small
from lamina.session import work_dir

WIDTH = 13
SHINGLE = 5


def alnum_words(text: Column) -> Column:
    return pieces(ascii_lower(or_empty(text)), NOT_ALNUM)


def shingle_hashes(words: Column, sizes: list[int]) -> Column:
    """(at, k, h): the hashes of all runs of k words, for each k of ``sizes``."""

    def of(hashes: Column, k: int) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - k),
            lambda i: F.struct(
                i.alias("at"),
                F.lit(k).alias("k"),
                F.xxhash64(F.lit(k), *[F.get(hashes, i + j) for j in range(k)]).alias("h"),
            ),
        )
        empty = F.array().cast("array<struct<at:int,k:int,h:bigint>>")
        return F.when(F.size(hashes) >= k, runs).otherwise(empty)

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return let(hashed, lambda h: F.concat(*[of(h, k) for k in sizes]))


def same_on(a: DataFrame, b: DataFrame, *names: str) -> Column:
    """Equal in all of ``names``, nulls included."""
    return reduce(and_, [a[n].eqNullSafe(b[n]) for n in names])


def run_text(words: Column, at: Column, k: Column) -> Column:
    return F.array_join(F.slice(words, at + 1, k), " ")


def item_shingles(
    benchmark: DataFrame, key: str, text: str, width: int, shingle: int
) -> DataFrame:
    """(item_id, words, w, k, at, h, shingle): each item's shingles with their places."""
    words = (
        benchmark.select(F.col(key).alias("item_id"), alnum_words(F.col(text)).alias("words"))
        .where(F.size("words") > 0)
        .dropDuplicates(["item_id", "words"])
        .withColumn("w", F.least(F.size("words"), F.lit(width)))
        .withColumn("k", F.least(F.col("w"), F.lit(shingle)))
    )
    every = list(range(1, shingle + 1))
    runs = F.filter(shingle_hashes(F.col("words"), every), lambda r: r["k"] == F.col("k"))
    return words.select("item_id", "words", "w", "k", F.explode(runs).alias("r")).select(
        "item_id",
        F.xxhash64("words").alias("item_text"),
        F.size("words").alias("n"),
        "w",
        "k",
        F.col("r.at").alias("at"),
        F.col("r.h").alias("h"),
        run_text(F.col("words"), F.col("r.at"), F.col("k")).alias("shingle"),
    )


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    shingle: int = SHINGLE,
    broadcast_rows: int = 1_000_000,
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, doc_text, n_words), and (doc_id, doc_text, item_id, start, end): every window that stands in
    a document. ``doc_text`` is a hash of the text.

    The benchmark's shingles are broadcast while they are at most ``broadcast_rows``; beyond that Spark
    joins as it sees fit.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "decontaminate")
    item_shingles(benchmark, item, item_text, width, shingle).write.parquet(f"{folder}/items")
    items = spark.read.parquet(f"{folder}/items")
    lengths = sorted(r[0] for r in items.select("k").distinct().collect()) or [shingle]
    few = small(items, broadcast_rows)

    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    # One pass over the texts. A document's row with place -1 carries its length.
    worded = docs.select(
        F.col(key).alias("doc_id"),
        F.xxhash64(text).alias("doc_text"),
        alnum_words(F.col(text)).alias("words"),
    )
    first = F.array(
        F.struct(F.lit(-1).alias("at"), F.lit(0).alias("k"), F.lit(0).cast("long").alias("h"))
    )
    runs = worded.select(
        "doc_id",
        "doc_text",
        "words",
        F.size("words").alias("n_words"),
        F.explode(F.concat(first, shingle_hashes(F.col("words"), lengths))).alias("r"),
    ).select("doc_id", "doc_text", "words", "n_words", "r.at", "r.k", "r.h")
    known = items.select(F.col("h").alias("b_h"), "shingle").distinct()
    # Texts are compared after the join, so that they are only put together where hashes agree.
    same = run_text(F.col("words"), F.col("at"), F.col("k")) == F.col("shingle")
    found = runs.join(side(known), F.col("h") == F.col("b_h"), "left").where(
        (F.col("at") < 0) | (F.col("b_h").isNotNull() & same)
    )
    found.select("doc_id", "doc_text", "n_words", "at", "h").write.parquet(f"{folder}/found")
    found = spark.read.parquet(f"{folder}/found")
    lengths_of = found.where(F.col("at") < 0).select(
        "doc_id", "doc_text", F.col("n_words").cast("long").alias("n_words")
    )
    places = found.where(F.col("at") >= 0).distinct()

    # The rarest shingle of each window, with the windows that it stands for.
    rarity = places.groupBy("h").agg(F.count(F.lit(1)).alias("times"))
    timed = items.join(rarity, "h", "left").withColumn("times", F.coalesce("times", F.lit(0)))
    token = F.struct("times", "h", "at")
    last = F.col("w") - F.col("k")
    windows = (
        timed.withColumn(
            "start", F.explode(F.sequence(F.greatest(F.col("at") - last, F.lit(0)), F.col("at")))
        )
        .where(F.col("start") + F.col("w") <= F.col("n"))
        .groupBy("item_id", "item_text", "w", "start")
        .agg(F.min(token).alias("token"))
    )
    prefix = windows.groupBy("item_id", "item_text", "w", "token").agg(
        F.min("start").alias("low"), F.max("start").alias("high")
    ).select(
        "item_id",
        "item_text",
        "w",
        "low",
        "high",
        F.col("token.h").alias("h"),
        F.col("token.at").alias("item_at"),
    )
    offset = F.col("at") - F.col("item_at")
    candidates = (
        places.join(side(prefix), "h")
        .withColumn("offset", offset)
        .where(
            (F.col("offset") + F.col("high") >= 0)
            & (F.col("offset") + F.col("low") + F.col("w") <= F.col("n_words"))
        )
        .select("doc_id", "doc_text", "item_id", "item_text", "offset")
        .distinct()
    )

    # Where a candidate's shingles would have to stand; those that do are kept.
    spot = ("doc_id", "doc_text", "item_id", "item_text", "offset")
    own = items.select("item_id", "item_text", "w", "k", F.col("at").alias("item_at"), "h")
    own = side(own)
    expected = candidates.join(own, same_on(candidates, own, "item_id", "item_text")).select(
        *[candidates[c] for c in spot],
        "w",
        "k",
        "item_at",
        "h",
        (F.col("offset") + F.col("item_at")).alias("at"),
    )
    standing = same_on(expected, places, "doc_id", "doc_text", "at", "h")
    held = expected.join(places, standing, "left_semi").groupBy(*spot, "w", "k").agg(
        F.sort_array(F.collect_set("item_at")).alias("ats")
    )
    ahead = F.col("w") - F.col("k")
    whole = F.filter("ats", lambda x, i: F.get(F.col("ats"), i + ahead) == x + ahead)
    windows_found = held.select(
        "doc_id", "doc_text", "item_id", "w", "offset", F.explode(whole).alias("at")
    ).select(
        "doc_id",
        "doc_text",
        "item_id",
        (F.col("offset") + F.col("at")).alias("start"),
        (F.col("offset") + F.col("at") + F.col("w")).alias("end"),
    )
    return lengths_of, windows_found


def contamination(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """A row per document: n_words, n_hit, n_items, items, contaminated (a twentieth of the words hit).

    ``doc_text``, a hash of the text, tells texts under one id apart. A document's hit words are the union of its windows, walked in order of their starts.
    """
    lengths_of, found = hits(docs, benchmark, **names)
    walked = F.aggregate(
        F.sort_array(F.collect_set(F.struct("start", "end"))),
        F.struct(F.lit(0).alias("words"), F.lit(0).alias("reach")),
        lambda a, x: F.struct(
            (
                a["words"] + F.greatest(x["end"] - F.greatest(x["start"], a["reach"]), F.lit(0))
            ).alias("words"),
            F.greatest(a["reach"], x["end"]).alias("reach"),
        ),
        lambda a: a["words"].cast("long"),
    )
    per_doc = found.groupBy("doc_id", "doc_text").agg(
        walked.alias("n_hit"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    docs_of = lengths_of
    same = same_on(docs_of, per_doc, "doc_id", "doc_text")
    hit = F.coalesce("n_hit", F.lit(0))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return docs_of.join(per_doc, same, "left").select(
        docs_of["doc_id"],
        docs_of["doc_text"],
        "n_words",
        hit.cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )
