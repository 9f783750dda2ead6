"""The pipeline's stages, each held against plain Python on its own input."""

from collections import defaultdict

import corpus_pipeline
import plain
import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(name, what went in, what came out) of each stage; three documents get secrets."""
    folder = str(tmp_path_factory.mktemp("tables"))
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    words = F.concat(F.col("text"), F.lit(" token = \"" + "0af1" * 10 + "\" AKIA" + "Q" * 16))
    text = F.when(F.col("doc_id").isin(3, 20, 41), words).otherwise(F.col("text"))
    docs = given.withColumn("text", text).withColumn("n_chars", F.length("text").cast("int"))
    docs.select(*[F.col(c).cast(t) for c, t in given.dtypes]).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = []
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, folder).toPandas()
        found.append((name, docs.toPandas(), rows))
        docs = spark.createDataFrame(rows) if name != "mixing" else None
    return {name: (a, b) for name, a, b in found}


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontamination", "secret_scans", "mixing",
    ]


def test_columns_stay(stages):
    for name, (before, after) in stages.items():
        if name != "mixing":
            assert list(after.columns) == list(before.columns)


def test_quality(stages):
    before, after = stages["quality_rules"]
    want = set()
    for i, text in zip(before.doc_id, before.text):
        n, _, symbols, dup, repeat, failed = plain.quality(text)
        lines = sum(bool(plain.WORD.search(x)) for x in text.split("\n"))
        if not failed and 5 * symbols <= n and 2 * dup <= lines:
            want.add(i)
    assert set(after.doc_id) == want and 0 < len(want) < len(before)


def test_one_of_each_group_stays(stages):
    from test_python import aligned

    before, after = stages["near_duplicates"]
    root = {i: i for i in before.doc_id}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    texts = list(zip(before.doc_id, before.text))
    words = [set(t.lower().split()) for _, t in texts]
    for x in range(len(texts)):
        for y in range(x):
            if len(words[x] & words[y]) > 0.5 * max(len(words[x]), len(words[y])):
                (i, a), (j, b) = texts[x], texts[y]
                if find(i) != find(j) and (a == b or aligned(a, b) > 0.8 - 1e-9):
                    root[max(find(i), find(j))] = min(find(i), find(j))
    assert set(after.doc_id) == {i for i in root if find(i) == i}
    assert len(after) < len(before)


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontamination"]
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()
    windows = plain.benchmark_windows([tuple(r) for r in items])
    gone = {i for i, t in zip(before.doc_id, before.text) if plain.contamination(t, windows)[-1]}
    assert set(before.doc_id) - set(after.doc_id) == gone


def test_secrets_go(stages):
    before, after = stages["secret_scans"]
    assert sorted(before.doc_id) == sorted(after.doc_id)
    old = dict(zip(before.doc_id, before.text))
    changed = 0
    for i, text, size in zip(after.doc_id, after.text, after.n_chars):
        assert size == len(text)
        if sum(plain.secrets(old[i])[:3]):
            changed += 1
            assert sum(plain.secrets(text)[:3]) == 0 and "[secret]" in text
        else:
            assert text == old[i]
    assert changed > 0


def test_mix(stages):
    before, after = stages["mixing"]
    size = {i: len(plain.WORD.findall(t)) for i, t in zip(before.doc_id, before.text)}
    assert dict(zip(after.doc_id, after["size"])) == size
    sums = defaultdict(lambda: [0, 0, 0])
    for row in after.itertuples():
        sums[row.source][0] += row.size
        sums[row.source][1] += row.taken
        sums[row.source][2] = row.target
    names = sorted(sums)
    assert [sums[s][2] for s in names] == pytest.approx(plain.targets([sums[s][0] for s in names]))
    assert all(abs(taken - target) < 64 for _, taken, target in sums.values())


def test_clean_documents_without_or_under_one_id_stay(spark, tmp_path):
    spark.createDataFrame([(1, "b " * 20)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    bad = "b " * 15
    rows = [(None, bad), (None, "clean one"), (None, None), (7, bad), (7, "clean two"), (8, "clean two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()
    want = [r for r in rows if r[1] != bad]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_one_of_each_group_stays_without_or_under_one_id(spark):
    near = " ".join(f"n{i}" for i in range(30))
    other = " ".join(f"m{i}" for i in range(30))
    rows = [(None, "a lone copy"), (None, "a lone copy"), (None, "another"), (None, None), (1, None)]
    rows += [(7, near), (9, f"{near} x"), (9, other), (7, "under seven"), (7, near)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    want = [rows[0], *rows[2:6], rows[7], rows[8]]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
