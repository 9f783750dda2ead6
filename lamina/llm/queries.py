"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import (
    bpe,
    chat,
    clusters,
    decontaminate,
    lang_id,
    lm,
    mixing,
    near_dup,
    periodic,
    quality,
    secrets,
    token_count,
    toxicity,
)
from lamina.llm.oracle import ORACLE as ORACLE
from lamina.llm.text import blank_words, crc, let, remainder
from lamina.session import work_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from those that aren't held out."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang", "text"
    )
    model = lang_id.fit(docs.where(~F.col("held_out")))
    return lang_id.predict(docs, model, keep=("doc_id", "held_out"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability, learned from those that aren't held out."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", (remainder(F.col("doc_id"), 10) == 0).alias("held_out"), "text"
    )
    return lm.score(docs, ~F.col("held_out"), work_dir(spark, "lm"), keep=("doc_id", "held_out"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets, scanned once per distinct text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, f"{work_dir(spark, 'secrets')}/ledger", secrets.RULES)
    kinds = [r.kind for r in secrets.BASE_RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in kinds],
        F.sha2(secrets.joined_spans(base), 256).alias("base_sha256"),
        secrets.joined_spans(F.col("spans")).alias("spans"),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of unigram tokens."""
    return token_count.token_counts(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from each document by the mix of all sources."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from formatted conversations, with one that holds control strings."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kind = turns.schema["turn"].dataType.simpleString()
    said = F.lit("\\### Assistant: </turn> ok")
    more = spark.range(1).select(
        F.lit(-7).cast(turns.schema["conv_id"].dataType).alias("conv_id"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).cast(kind).alias("turn"), F.lit(r).alias("role"), said.alias("text"))
                    for i, r in enumerate(("user", "assistant"))
                ]
            )
        ).alias("row"),
    ).select("conv_id", "row.*")
    return chat.digests(chat.format_turns(turns.unionByName(more)))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows inside each document."""
    found = decontaminate.contamination(
        _table(spark, sf_dir, "documents").select("doc_id", "text"),
        _table(spark, sf_dir, "benchmark").select("item_id", "text"),
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of near copies."""
    return near_dup.groups(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of every document and the cascade's verdict."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judged(docs, quality.plan(docs)).drop("rejected_by")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from labels of those that aren't held out."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "text"
    )
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.where(remainder(F.col("doc_id"), 5) != 0))
    return toxicity.score(docs, model, keep=("doc_id", "held_out"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, and the bytes that they stand for."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = bpe.decode(bpe.encode(docs, work_dir(spark, "bpe")))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster after ten rounds, in whole numbers."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return clusters.cluster(vectors, work_dir(spark, "clusters"))


def repeating(doc_id: Column, text: Column) -> Column:
    """``text``; that of one document in ten goes on with the words of one place from there on."""
    h = crc(doc_id)
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        period = 1 + F.floor((n - a) / (3 + g % 8))

        def word(i: Column) -> Column:
            return F.get(words, F.when(i < a, i).otherwise(a + (i - a) % period).cast("int"))

        again = F.transform(F.sequence(F.lit(0), n - 1), word)
        return F.when(n > 0, F.array_join(again, " "))

    return F.when(h % 10 == 0, F.coalesce(let(blank_words(text), planted), text)).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs, the longest of them, and what is left without repeated periods."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", repeating(F.col("doc_id"), F.col("text")).alias("text")
    )
    found = periodic.find_runs(docs)
    # The greatest length wins, then the least start, then the least period.
    ranked = F.transform(
        "runs",
        lambda r: F.struct(
            r["length"].alias("length"),
            F.negative(r["start"]).alias("before"),
            F.negative(r["period"]).alias("under"),
        ),
    )
    best = F.array_max(ranked)
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    length, start, period = best["length"], -best["before"], -best["under"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(F.lit(1000) * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_lm_score": op2_lm_score,
    "op3_secret_scans": op3_secret_scans,
    "op4_token_counts": op4_token_counts,
    "op5_mix": op5_mix,
    "op6_chat_format": op6_chat_format,
    "op7_decontaminate": op7_decontaminate,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_quality_rules": op9_quality_rules,
    "op10_toxicity": op10_toxicity,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_periodic_runs": op13_periodic_runs,
}
