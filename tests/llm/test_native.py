"""The operators made of DataFrame functions, against plain Python, with awkward rows."""

import random
from collections import defaultdict

import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from lamina.llm import chat, decontaminate, mixing, quality, secrets
from pyspark.sql import functions as F

WORDS = "the of Über and Éa x1 stop. {#} it's no-one | $$ the the a b ı".split(" ")


def awkward(seed: int, extra: list[str] = ()) -> list[tuple]:
    """Rows (doc_id, text): nulls, empty, blank, very long and repeated texts, and repeated rows."""
    draw = random.Random(seed)
    made = []
    for _ in range(60):
        text = "".join(
            draw.choice([*WORDS, *extra]) + draw.choice([" ", " ", "\n", "\t ", "  ", "\x0b"])
            for _ in range(draw.randint(0, 60))
        )
        made.append(text)
    long = " ".join(draw.choice(WORDS) + str(draw.randint(0, 500)) for _ in range(30_000))
    texts = [None, "", " \n\t", "\n\n\n", "🎉", "a", long, "z " * 3000, *made, made[0], made[1]]
    rows = [*enumerate(texts), (0, None), (7, "z " * 3000), (None, "one two")]
    return rows


def frame(spark, rows, names="doc_id long, text string"):
    """The rows with columns whose names the operators use themselves."""
    clashing = "words string, size string, spans string, rejected_by string, blob string, found string, taken string"
    return spark.createDataFrame([(*r, *["x"] * 7) for r in rows], f"{names}, {clashing}").repartition(3)


def test_quality_counts(spark):
    rows = awkward(1)
    got = quality.judged(frame(spark, rows), quality.RULES).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    found = sorted((str(r["doc_id"]), *[r[n] for n in names]) for r in got)
    assert found == sorted((str(i), *plain.quality(t)) for i, t in rows)
    assert all(r["kept"] == (not r["base_failed"] and r["rejected_by"] is None) for r in got)


def test_cascade_rejects_the_same_in_any_order(spark):
    rows = awkward(2, ["###"])
    docs = frame(spark, rows)
    verdicts = set()
    for rules in (quality.RULES, quality.RULES[::-1], quality.plan(docs, sample_rows=20)):
        kept = quality.cascade(docs, rules, into="verdict").where("verdict is null")
        assert kept.columns == [*docs.columns, "verdict"]
        verdicts.add(tuple(sorted(str((r["doc_id"], r["text"], r["words"])) for r in kept.collect())))
    assert len(verdicts) == 1
    measured = quality.judged(docs, quality.RULES).where("kept").count()
    assert measured == len(verdicts.pop())


def test_cascade_stops_at_the_first_rejection(spark):
    never = quality.Rule("never", lambda text, words: F.raise_error(F.lit("reached")).isNotNull())
    first = quality.Rule("all", lambda text, words: F.length(text) >= 0)
    docs = spark.createDataFrame([(1, "a"), (2, "")], "doc_id long, text string")
    got = quality.cascade(docs, (first, never)).collect()
    assert [r["rejected_by"] for r in got] == ["all", "all"]


def test_rules_are_ordered_by_rejection_per_cost(spark):
    docs = spark.range(200).select("id", F.concat(F.lit("w "), F.col("id").cast("string")).alias("text"))
    none = quality.Rule("none", lambda text, words: F.lit(False) & text.isNull())
    most = quality.Rule("most", lambda text, words: text.like("w %"))
    assert [r.name for r in quality.plan(docs, (none, most))] == ["most", "none"]
    assert quality.plan(docs.limit(0), (none, most)) == (none, most)


SECRET_WORDS = [
    "password: hunter22", "TOKEN='abc'", "api_key=token=abcdefg", 'Secret" = "a.b-c_d"', "AKIA" + "B" * 16,
    "AKIAAKIA" + "C" * 12, "deadbeef" * 3, "0" * 40, "passwd:abcde", "password=token: abcdefgh",
    "-----BEGIN RSA PRIVATE KEY-----", "token = \"" + "a1" * 20 + "\"",
]


def test_secret_spans(spark, tmp_path):
    rows = awkward(3, SECRET_WORDS * 2)
    got = secrets.scan(frame(spark, rows), str(tmp_path / "ledger"), secrets.BASE_RULES).collect()
    found = []
    for r in got:
        spans = [s.asDict() for s in r["spans"]]
        counts = [sum(s["kind"] == k for s in spans) for k in ("assign", "access", "hex")]
        joined = ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)
        found.append((str(r["doc_id"]), *counts, plain.digest(joined)))
    assert sorted(found) == sorted((str(i), *plain.secrets(t)) for i, t in rows)


def test_ledger_scans_only_unseen_pairs(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    schema = "path string, version int, text string"
    first = spark.createDataFrame([("a", 1, "token=abcdefg"), ("b", 1, "token=abcdefg"), ("c", 1, None)], schema)
    later = spark.createDataFrame([("a", 2, "nothing"), ("d", 1, "token=abcdefg")], schema)
    assert secrets.scan(first, folder).where("size(spans) > 0").count() == 2
    ledger = secrets.BlobLedger(spark, folder)
    assert ledger.read().count() == 2  # the text and the empty one
    both = first.union(later)
    got = {(r["path"], r["version"]): len(r["spans"]) for r in secrets.scan(both, folder).collect()}
    assert got == {("a", 1): 1, ("b", 1): 1, ("c", 1): 0, ("a", 2): 0, ("d", 1): 1}
    assert ledger.read().count() == 3
    assert ledger.read().groupBy("blob", "rule_version").count().where("count > 1").isEmpty()
    changed = (secrets.SecretRule("word", "nothing"),)
    got = {r["path"]: len(r["spans"]) for r in secrets.scan(later, folder, changed).collect()}
    assert got == {"a": 1, "d": 0}
    assert ledger.read().count() == 5


def test_redaction(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "é token=deadbeefdeadbeefdeadbeef0 x"), (2, "clean"), (3, None), (4, "AKIA" + "D" * 16)],
        "doc_id long, text string",
    )
    got = secrets.redacted(docs, str(tmp_path / "ledger"))
    assert got.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "é [secret] x", 2: "clean", 3: None, 4: "[secret]"}


def test_contamination(spark):
    draw = random.Random(5)
    names = [f"w{i}" for i in range(30)]
    items = [(1, None), (2, ""), (3, "One"), (4, "One two-three"), (5, "same " * 20), (6, "Ünï cöde, É x")]
    items += [(10 + i, " ".join(draw.choice(names) for _ in range(draw.randint(3, 40)))) for i in range(12)]
    items.append((40, items[-1][1]))
    rows = awkward(4)
    for i in range(40):
        words = [draw.choice(names) for _ in range(draw.randint(0, 80))]
        text = draw.choice(items)[1] or ""
        cut = text.split()
        part = cut[draw.randint(0, 3) : draw.randint(10, 60)]
        rows.append((1000 + i, " ".join([*words[:20], *part, *words[20:], *part[:5]]).upper()))
    rows.append((2000, "same " * 500))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = plain.benchmark_windows(items)
    want = sorted((str(i), str(plain.contamination(t, windows))) for i, t in rows)
    names = ("n_words", "n_hit", "n_items", "items", "contaminated")
    for most in (1_000_000, 1):
        got = decontaminate.contamination(frame(spark, rows), benchmark, broadcast_rows=most).collect()
        assert sorted((str(r["doc_id"]), str(tuple(r[n] for n in names))) for r in got) == want


def test_contamination_without_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.contamination(none, items).count() == 0
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert decontaminate.contamination(docs, items.limit(0)).first()["n_items"] == 0


def test_chat_reads_back(spark):
    draw = random.Random(6)
    marks = ["<|turn|>", "<|", "\\", "<\\|", "<|end|>", "\\<|", "hi", "\n", "é🎉", "", "<\\\\|"]
    rows = []
    for conv in range(40):
        for turn in range(draw.randint(1, 9)):
            text = draw.choice([None, "".join(draw.choice(marks) for _ in range(draw.randint(0, 8)))])
            rows.append((conv, turn, draw.choice(["user", "assistant", "system", None, "<|x"]), text))
    rows += [(50, None, "assistant", "first"), (50, 1, "assistant", "b"), (50, 1, "assistant", "a"), rows[0]]
    rows += [(60, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(400)]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    by = defaultdict(list)
    for c, *rest in rows:
        by[c].append(rest)
    got = chat.digests(chat.format_turns(turns.withColumn("n", F.lit("x")))).collect()
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert {r["conv_id"]: tuple(r[n] for n in names) for r in got} == {c: plain.chat(r) for c, r in by.items()}


def test_examples_hold_what_was_said_before(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "q"), (1, 1, "assistant", "a<|"), (1, 2, "user", "r"), (1, 3, "assistant", "b"), (1, 4, "user", "s")],
        "conv_id long, turn int, role string, text string",
    )
    formatted = chat.format_turns(turns)
    whole = formatted.first()["formatted"]
    got = chat.examples(formatted).orderBy("n").collect()
    assert [whole.startswith(r["text"]) for r in got] == [True, True]
    assert [r["text"][r["loss_start"] : r["loss_end"]] for r in got] == ["a<\\|", "b"]
    assert [r["text"].count("<|turn|>") for r in got] == [2, 4]
    assert chat.examples(chat.format_turns(turns.limit(0))).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=8), st.integers(0, 120))
def test_highest_quotients(spark, weights, seats):
    if not sum(weights):
        return
    parties = spark.createDataFrame([(0, i, w, seats) for i, w in enumerate(weights)], "g int, p int, weight int, seats long")
    got = {r["p"]: r["quota"] for r in mixing.highest_quotients(parties, "g", "p").collect()}
    assert [got[i] for i in range(len(weights))] == plain.quotas(weights, seats)


@pytest.mark.parametrize("sizes", [[10, 10, 10], [5, 100, 1, 0, 7, 300], [0, 0], [1], [1000, 1, 1, 1]])
def test_targets(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
    table = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
    assert [got[n] for n in names] == pytest.approx(plain.targets(sizes))


def test_mix(spark):
    draw = random.Random(8)
    rows = [
        (i, draw.choice(["a", "a", "a", "b", "c", None]), " ".join("w" * draw.randint(0, 400)))
        for i in range(1500)
    ]
    rows += [(9001, "tiny", "one two three"), (9002, "none", ""), (9003, "none", None), (None, "a", "x y"), rows[0]]
    docs = frame(spark, rows, "doc_id long, source string, text string")
    runs = []
    for parts in (1, 7):
        found = mixing.mix(docs.repartition(parts), broadcast_rows=100_000 if parts == 1 else 0).collect()
        runs.append(sorted(str((r["doc_id"], r["source"], r["size"], r["taken"])) for r in found))
    assert runs[0] == runs[1]
    assert len(found) == len(rows)
    sums = defaultdict(lambda: [0, 0, 0.0])
    for r in found:
        held = sums[r["source"]]
        held[0] += r["size"]
        held[1] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["taken"] == sum((s["end"] - s["start"]) * s["times"] for s in r["chosen"] or [])
        held[2] = r["target"]
    names = sorted((s for s in sums if s is not None)) + [None]
    assert [sums[s][2] for s in names] == pytest.approx(plain.targets([sums[s][0] for s in names]))
    for size, taken, target in sums.values():
        assert abs(taken - target) <= max(64, 0.01 * target)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_rows_without_ids_are_dealt_over_all_shards(spark):
    docs = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
        F.lit(5).cast("long").alias("size"),
        F.xxhash64("id").alias("print"),
        F.lit(77).cast("long").alias("shards"),
    )
    sizes = sorted(r["count"] for r in mixing.in_shards(docs, 0).groupBy("shard").count().collect())
    assert len(sizes) == 77 and sizes[-1] < 3 * sizes[38]
