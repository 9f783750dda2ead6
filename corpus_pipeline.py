"""A training corpus from ``documents``: quality, near copies, benchmark passages, secrets, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import decontaminate, mixing, near_dup, quality, secrets
from lamina.llm.text import spare
from lamina.session import work_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the cascade rejects."""
    verdict = spare(docs, "rejected_by")
    judged = quality.cascade(docs, quality.plan(docs), into=verdict)
    return judged.where(F.col(verdict).isNull()).drop(verdict)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the least id, as one row.

    Null ids come last; equal ids go by the text's hash, and equal texts under one id by all other columns.
    Null texts are no copies and stay. An empty table stays empty.
    """
    found = near_dup.members(docs.select("doc_id", "text")).where(F.col("root").isNotNull())
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "blob")).alias("first")
    kept = found.groupBy("root").agg(first).select("first.doc_id", "first.blob")
    digest = spare(docs, "digest")
    hashed = docs.withColumn(digest, F.sha2("text", 256))
    same = hashed["doc_id"].eqNullSafe(kept["doc_id"]) & (hashed[digest] == kept["blob"])
    # Of rows with one id and text the least in all other columns stays, whatever order they come in.
    others = F.to_json(F.struct(*[c for c in docs.columns if c not in ("doc_id", "text")]))
    row = F.min_by(F.struct(*docs.columns), others).alias("row")
    once = hashed.join(kept, same, "left_semi").groupBy("doc_id", digest).agg(row)
    return once.select("row.*").unionByName(docs.where(F.col("text").isNull()))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more are benchmark words."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = decontaminate.contamination(docs.select("doc_id", "text"), benchmark)
    # Stored, so that its size is known before whole texts would be shuffled to meet it.
    folder = f"{work_dir(spark, 'contaminated')}/gone"
    found.where("contaminated").select("doc_id", "doc_text").distinct().write.parquet(folder)
    gone = spark.read.parquet(folder)
    same = docs["doc_id"].eqNullSafe(gone["doc_id"]) & (F.xxhash64(docs["text"]) == gone["doc_text"])
    return docs.join(gone, same, "left_anti")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; ``n_chars`` follows."""
    ledger = f"{work_dir(spark, 'secrets')}/ledger"
    return secrets.redacted(docs, ledger).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)
    )


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes from each document that is left."""
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("mixing", mixing_sources),
]

#: Order MinHash has no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again."""
    folder = work_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
