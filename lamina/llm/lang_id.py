"""Language identification, words first, with back-off to shorter and shorter character n-grams.

A known word adds its log10 frequency in each language, and ``PENALTY`` in a language that lacks it. For
an unknown word its 5-grams (blanks at both ends count) are looked up; if none is known, its 4-grams, and
so on to single letters: the mean over those found. A text's language has the greatest sum; ``score`` is
its posterior under equal priors.

The model is fitted on a bounded sample: of each language about ``sample_docs`` distinct texts, picked by
the hash of their text; copies count once. A word is learned in a language if it makes up at least
``word_share`` of the sample's words in that language, and an n-gram if it makes up ``gram_share`` of its
n-grams. So each language has its own quota, 1 / share entries, whatever the others hold. Prediction reads
every whole text, also very long ones.

Null texts and texts without a letter are ``und`` with score 0, as is everything if nothing was learned.
Equal sums go to the first language by code point. Repeated rows get equal results. An empty table gives
an empty result. Columns other than the ones named are not looked at and may have any name.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.arrow import Rows, map_slices, slices
from lamina.session import work_dir

#: Runs of letters and of numbers that aren't digits.
WORDS = re.compile(r"[^\W\d_]+")
LONGEST = 5
PENALTY = -7.0
CACHE = 400_000


def words_of(text: str | None) -> list[str]:
    """Runs of letters; other numbers than digits, as in ``x²``, part them too."""
    found = WORDS.findall(text.lower()) if text else []
    if all(map(str.isalpha, found)):
        return found
    spread = ("".join(c if c.isalpha() else " " for c in w) for w in found)
    return [w for part in spread for w in part.split()]


def grams_of(word: str, n: int) -> list[str]:
    held = f" {word} "
    return [held[i : i + n] for i in range(len(held) - n + 1)]


def _counts(batches):
    """(lang, n, gram, times): words as n = 0 and n-grams, summed within the task."""
    found: Counter = Counter()

    def flush():
        keys = list(found)
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.int32()),
                pa.array([k[2] for k in keys], pa.string()),
                pa.array(list(found.values()), pa.int64()),
            ],
            names=["lang", "n", "gram", "times"],
        )
        found.clear()
        return out

    for batch in batches:
        for part in slices(batch, "text"):
            words: Counter = Counter()
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                words.update((lang, w) for w in words_of(text))
            for (lang, word), times in words.items():
                found[lang, 0, word] += times
                for n in range(1, LONGEST + 1):
                    for gram in grams_of(word, n):
                        if gram != " ":
                            found[lang, n, gram] += times
            if len(found) > 500_000:
                yield flush()
    yield flush()


def fit(
    labelled: DataFrame,
    lang: str = "lang",
    text: str = "text",
    sample_docs: int = 3000,
    word_share: float = 2.0**-19,
    gram_share: float = 2.0**-17,
) -> dict:
    """The model: languages, and for words and n-grams their log10 frequencies by language.

    The sample is counted once, into a table. The driver gets one row for each language and length, and
    for each language at most 1 / word_share words and LONGEST / gram_share n-grams.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull()
    )
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    model = {"langs": langs, "words": ([], None), "grams": ([], None)}
    if not langs:
        return model
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, sample_docs / sizes[k]))])
    drawn = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)
    spark = labelled.sparkSession
    folder = work_dir(spark, "lang_id")
    schema = "lang string, n int, gram string, times long"
    parts = rows.where(F.col("text").isNotNull() & drawn).distinct().mapInArrow(_counts, schema)
    parts.groupBy("lang", "n", "gram").agg(F.sum("times").alias("times")).write.parquet(folder)
    counted = spark.read.parquet(folder)
    of = {k: i for i, k in enumerate(langs)}
    for part, share in (("words", word_share), ("grams", gram_share)):
        kind = counted.where(F.col("n") == 0 if part == "words" else F.col("n") > 0)
        summed = kind.groupBy("lang", "n").agg(F.sum("times").alias("times")).collect()
        totals = {(r["lang"], r["n"]): r["times"] for r in summed}
        if not totals:
            continue
        least = F.create_map(*[F.lit(x) for (k, n), v in totals.items() for x in (f"{n} {k}", v * share)])
        enough = F.col("times") >= least[F.concat_ws(" ", "n", "lang")]
        held = kind.where(enough).select("lang", "n", "gram", "times").toArrow()
        table: dict[str, int] = {}
        at = [table.setdefault(gram, len(table)) for gram in held.column("gram").to_pylist()]
        values = np.full((len(table), len(langs)), PENALTY, np.float32)
        keys = list(zip(held.column("lang").to_pylist(), held.column("n").to_pylist()))
        total = np.array([totals[k] for k in keys])
        values[at, [of[k] for k, _ in keys]] = np.log10(held.column("times").to_numpy() / total)
        model[part] = (list(table), values)
    return model


def scorer(model: dict):
    """A function from texts to (language, score)."""
    langs = model["langs"]
    words = dict(zip(model["words"][0], model["words"][1] if langs else ()))
    grams = dict(zip(model["grams"][0], model["grams"][1] if langs else ()))
    nothing = np.zeros(len(langs), np.float32)

    def value(word: str):
        known = words.get(word)
        if known is not None:
            return known
        for n in range(LONGEST, 0, -1):
            found = [grams[g] for g in grams_of(word, n) if g in grams]
            if found:
                return np.mean(found, axis=0)
        return nothing

    rows = Rows(value, CACHE, np.float64, (len(langs),))

    def score(texts: list[str | None]) -> tuple[list[str], list[float]]:
        rows.trim()
        ids = [rows.numbers(words_of(t)) for t in texts]
        table = rows.table()
        names, scores = [], []
        for own in ids:
            if not len(own) or not langs:
                names.append("und")
                scores.append(0.0)
                continue
            total = table[own].sum(axis=0) * np.log(10)
            best = int(total.argmax())
            names.append(langs[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return names, scores

    return score


def predict(docs: DataFrame, model: dict, text: str = "text", keep: tuple[str, ...] = ("doc_id",)):
    """The columns ``keep`` of every row, lang_pred and score."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def make():
        score = scorer(held.value)

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            names, scores = score(part.column("__text").to_pylist())
            columns = [part.column(i) for i in range(len(keep))]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*keep, "lang_pred", "score"],
            )

        return work

    return map_slices(source, make, f"{schema}, lang_pred string, score double", "__text")
