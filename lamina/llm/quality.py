"""Quality rules as a short-circuit cascade.

``plan`` runs every rule alone on a sample and orders the rules by how much they reject for their cost;
``cascade`` tries them in that order and stops at a document's first rejection. The order changes how
much work is done, never which documents are rejected.

Null and empty texts have no words and fall to ``few_words``. Repeated rows are judged one by one. An
empty table gives an empty result. Only the text column is read; others pass through.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.text import blank_words, let, or_empty, spare
from lamina.session import work_dir

WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``rejects`` is given the text and its words, and says whether the document goes."""

    name: str
    rejects: Callable[[Column, Column], Column]


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(or_empty(text), r"[^#*$%&|<>]+", "")).cast("long")


def lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(or_empty(text), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier one."""
    return let(lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside windows of ``width`` words that occur at least twice in the text.

    Windows are compared by their 64-bit hashes. Only texts that repeat a window, which is told from
    their distinct hashes, pay for the sort that finds which words are covered.
    """

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - width),
            lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(width)]),
        )

    def starts(found: Column) -> Column:
        by_hash = F.sort_array(
            F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        )
        return let(
            by_hash,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        s,
                        lambda x, i: (F.get(s, i - 1)["h"] == x["h"])
                        | (F.get(s, i + 1)["h"] == x["h"]),
                    ),
                    lambda x: x["at"],
                )
            ),
        )

    def covered(at: Column) -> Column:
        return F.aggregate(
            at,
            F.struct(F.lit(0).alias("words"), F.lit(0).alias("reach")),
            lambda a, x: F.struct(
                (a["words"] + x + width - F.greatest(x, a["reach"])).alias("words"),
                (x + width).alias("reach"),
            ),
            lambda a: a["words"],
        )

    def of(found: Column) -> Column:
        repeats = F.size(F.array_distinct(found)) < F.size(found)
        return F.when(repeats, covered(starts(found))).otherwise(0)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    count = let(hashes, lambda h: let(windows(h), of))
    return F.when(F.size(words) >= width, count).otherwise(0).cast("long")


#: The contract's own rules, and two that tell markup and repeated lines.
BASE_RULES = (
    Rule("few_words", lambda text, words: F.size(words) < 10),
    Rule(
        "repeated_windows", lambda text, words: 100 * n_repeat_words(words) > 20 * F.size(words)
    ),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", lambda text, words: 5 * n_symbols(text) > F.size(words)),
    Rule("repeated_lines", lambda text, words: 2 * n_dup_lines(text) > F.size(lines(text))),
)


def plan(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    text: str = "text",
    sample_rows: int = 2000,
    share: float = 0.2,
    chars: int = 20_000,
    seed: int = 7,
) -> tuple[Rule, ...]:
    """The rules by rejected documents per second, most first, measured on at most ``sample_rows`` rows.

    A rule's cost is the time of a job that applies it alone, less that of one that only reads. The
    sample draws a ``share`` of the rows of as few partitions as fill it, so it costs no pass over the
    table; its texts are cut to ``chars``, so it fits the driver. It decides nothing but the order.
    """
    spark = docs.sparkSession
    cut = F.substring(F.col(text), 1, chars).alias("text")
    drawn = docs.sample(share, seed).select(cut).limit(sample_rows).collect()
    if not drawn:
        return tuple(rules)
    held = spark.createDataFrame(drawn, "text string").repartition(2)
    path = work_dir(spark, "quality_sample")
    held.write.parquet(path)
    sample = spark.read.schema("text string").parquet(path)
    sized = sample.withColumn("words", blank_words(F.col("text"))).where(F.size("words") >= 0)

    def run(rejects: Column) -> tuple[float, int]:
        start = time.perf_counter()
        gone = sized.agg(F.count_if(rejects)).first()[0]
        return time.perf_counter() - start, gone

    idle, _ = min(run(F.size("words") < 0) for _ in range(2))
    rate = {}
    for rule in rules:
        seconds, gone = min(run(rule.rejects(F.col("text"), F.col("words"))) for _ in range(2))
        rate[rule.name] = gone / max(seconds - idle, 1e-3)
    return tuple(sorted(rules, key=lambda r: (-rate[r.name], r.name)))


def cascade(
    docs: DataFrame, rules: tuple[Rule, ...], text: str = "text", into: str = "rejected_by"
) -> DataFrame:
    """``docs`` and the name of the first rule that rejects each document, null if none does.

    The branches of one ``CASE``: a rule is worked out only for documents that all rules before it let
    pass. A column that is called ``into`` is replaced.
    """
    words = spare(docs, "words")
    chain = F
    for rule in rules:
        chain = chain.when(rule.rejects(F.col(text), F.col(words)), F.lit(rule.name))
    verdict = chain if rules else F.lit(None).cast("string")
    split = docs.withColumn(words, blank_words(F.col(text)))
    return split.withColumn(into, verdict).drop(words)


def measures(
    docs: DataFrame, key: str = "doc_id", text: str = "text", verdict: str | None = None
) -> DataFrame:
    """One row per document: its key, the counts of the contract, and the column ``verdict`` if it is given."""
    more = [F.col(verdict).alias("rejected_by")] if verdict else []
    split = docs.select(
        F.col(key).alias("doc_id"),
        F.col(text).alias("text"),
        blank_words(F.col(text)).alias("words"),
        *more,
    )
    return split.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        word_chars(F.col("words")).alias("word_chars"),
        n_symbols(F.col("text")).alias("n_symbols"),
        n_dup_lines(F.col("text")).alias("n_dup_lines"),
        n_repeat_words(F.col("words")).alias("n_repeat_words"),
        *["rejected_by" for _ in more],
    )


def judged(
    docs: DataFrame, order: tuple[Rule, ...], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``measures`` beside the verdict of the cascade: base_failed, kept, and what rejected the document.

    A document that fails the contract's own rules is not kept, whatever rules ``order`` has.
    """
    verdict = spare(docs, "rejected_by")
    found = measures(cascade(docs, order, text, verdict), key, text, verdict)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.withColumn("base_failed", base).withColumn(
        "kept", ~base & F.col("rejected_by").isNull()
    )
