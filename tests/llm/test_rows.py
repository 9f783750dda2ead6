"""What the operators and stages make of odd letters, own rules, the order of rows and empty tables."""

import random

import corpus_pipeline
import pytest
from lamina.llm import lang_id, quality
from pyspark.sql import functions as F


@pytest.mark.parametrize("text", ["½ ² ①", "①", "12 ½", "Ⅷ ⅔"])
def test_numbers_are_no_letters(text):
    assert lang_id.words_of(text) == []


def test_numbers_part_words():
    assert lang_id.words_of("Ab²cd x½ éé ¾y 7z") == ["ab", "cd", "x", "éé", "y", "z"]


def test_rules_of_ones_own(spark):
    rules = (quality.Rule("shouting", lambda text, words: F.upper(text) == text), *quality.BASE_RULES)
    rows = [(1, "ALL OF THIS IS SAID LOUDER THAN IT HAS TO BE"), (2, "all of this is said as one would say it"), (3, "few")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r["doc_id"]: (r["rejected_by"], r["base_failed"], r["kept"]) for r in quality.judged(docs, rules).collect()}
    assert got == {1: ("shouting", False, False), 2: (None, False, True), 3: ("few_words", True, False)}
    none = {r["doc_id"]: r["kept"] for r in quality.judged(docs, ()).collect()}
    assert none == {1: True, 2: True, 3: False}


def test_the_kept_copy_does_not_depend_on_the_order(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(7, text, "en", s, 5) for s in ("web", "book", "code", None)] + [(8, text, "en", "web", 5), (None, text, "en", "a", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, schema).repartition(3)
        kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
        assert [r["doc_id"] for r in kept] == [7] and kept[0].asDict().keys() == set(docs.columns)
        seen.add(kept[0]["source"])
    assert len(seen) == 1


def test_stages_on_an_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, digest string"
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "digest"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect() == []
