"""Byte-level BPE, centroid clusters and periodic runs against other libraries and plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from lamina.llm import bpe, clusters, periodic
from lamina.llm.queries import QUERIES
from lamina.session import work_dir
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
CLASHING = "row string, key string, whole string, kept string, text_ string, chunk string"


def digest(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


# Byte-level BPE

RANKS, SPELLING = bpe.read_ranks(), bpe.spelled(bpe.PATTERN)
OWN = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=RANKS, special_tokens={})
WHOLE = tiktoken.Encoding("whole", pat_str=r"(?s:.)+", mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture
def library():
    return OWN


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \t\n\r\x1c\x85　aZ'st1²é!語️"), st.characters())))
def test_cuts_and_words_are_those_of_the_pattern(text):
    split = bpe.Splitter(SPELLING)
    words = [w for cut in split.cuts(text) for w in split.words(cut)]
    assert words == split.words(text)
    assert "".join(split.cuts(text)) == text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \t\n\x1c　aZ'st1²!"), st.characters(codec="utf-8"))))
def test_words_encode_as_the_library_does(text):
    words = bpe.Splitter(SPELLING).words(text)
    assert [i for w in words for i in WHOLE.encode_ordinary(w)] == OWN.encode_ordinary(text)


def test_ids_and_bytes_of_all_documents(spark, library):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    got = QUERIES["op11_byte_bpe"](spark, SF_DIR)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = {r[0]: tuple(r[1:]) for r in got.collect()}
    want = {}
    for doc_id, text in texts.items():
        ids = library.encode_ordinary(text or "")
        want[doc_id] = (len(ids), digest(",".join(map(str, ids))), digest(text or ""))
    assert rows == want


@pytest.mark.parametrize("words, rows", [(0, 1), (3, 40), (1 << 18, 4000)])
def test_words_by_broadcast_or_by_join(spark, library, monkeypatch, words, rows):
    monkeypatch.setattr(bpe, "HEAD_WORDS", words)
    monkeypatch.setattr(bpe, "BLOCK_ROWS", rows)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 2)
    random.seed(4)
    some = ["the", " the", "cat's", "  x", "\n\n", "語" * 30, "a" * 5000, "1234 ", "é!?", "😀"]
    texts = ["".join(random.choices(some, k=random.randrange(60))) for _ in range(150)]
    texts += [None, "", " ", "\n \t", "word " * 30_000, "ab" * 200_000, "the", "the"]
    rows = [(i if i != 7 else None, t) for i, t in enumerate(texts)]
    clash = [(*r, *["x"] * 6) for r in rows]
    docs = spark.createDataFrame(clash, f"doc_id long, text string, {CLASHING}").repartition(5)
    encoded = bpe.encode(docs, work_dir(spark, "bpe"), keep=("doc_id", "row", "kept"))
    decoded = bpe.decode(encoded)
    assert decoded.columns == ["doc_id", "row", "kept", "ids", "decoded"]
    got = {r["doc_id"]: (r["ids"], bytes(r["decoded"])) for r in decoded.collect()}
    assert got == {
        i: (library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows
    }


def test_no_documents_and_odd_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(none, work_dir(spark, "bpe"))).collect() == []
    odd = spark.createDataFrame([(1, None), (2, []), (3, [0, None, -4, 10**6, 1])], "k int, ids array<int>")
    table = {rank: token for token, rank in RANKS.items()}
    got = {r["k"]: r["decoded"] for r in bpe.decode(odd).collect()}
    assert got == {1: None, 2: b"", 3: table[0] + table[1]}


# Centroid clusters


def plain_lloyd(rows, count=8, rounds=10, width=64, scale=1024):
    kept = []
    for key, v in rows:
        if v is None or len(v) != width or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept.append((key, [int(np.floor(np.float64(x) * scale)) for x in v]))
    order = sorted(
        kept, key=lambda r: (r[0] is None, digest(f"3:{r[0]}") if r[0] is not None else "", r[1])
    )
    centers = [list(x) for _, x in order[:count]]

    def assign():
        out = []
        for _, x in kept:
            far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centers]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        of = assign()
        for k in range(len(centers)):
            own = [x for (_, x), (j, _) in zip(kept, of) if j == k]
            if own:
                centers[k] = [sum(col) // len(own) for col in zip(*own)]
    of = assign()
    sums = {k: sum(d for j, d in of if j == k) for k, _ in of}
    return sorted(
        (
            (key, k, d, sums[k], sum(sums.values()), digest(",".join(map(str, centers[k]))))
            for (key, _), (k, d) in zip(kept, of)
        ),
        key=str,
    )


def vectors(seed, n, width=64):
    rng = np.random.default_rng(seed)
    means = rng.normal(0, 0.4, (6, width))
    return [
        (i, [float(np.float32(x)) for x in means[i % 6] + rng.normal(0, 0.3, width)]) for i in range(n)
    ]


@pytest.mark.parametrize("block", [64, 16, 24])
def test_clusters_as_in_plain_python(spark, monkeypatch, block):
    monkeypatch.setattr(clusters, "CHUNK", 7)
    rows = vectors(3, 120)
    same = rows[5][1]
    rows += [(200 + i, same) for i in range(60)] + [(5, same), (None, rows[9][1]), (None, rows[8][1])]
    rows += [(300, None), (301, same[:-1]), (302, [*same[:-1], None]), (303, [*same[:-1], float("nan")])]
    rows += [(304, [*same[:-1], float("inf")]), (305, []), (306, [*same[:-1], 3.5])]
    random.Random(block).shuffle(rows)
    table = [(*r, "x", "y", 1) for r in rows]
    df = spark.createDataFrame(
        table, "vec_id long, embedding array<float>, chunk string, cluster string, block int"
    ).repartition(4)
    got = clusters.cluster(df, work_dir(spark, "clusters"), block=block, rounds=4)
    want = plain_lloyd(rows, rounds=4)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    rows = vectors(5, 3)
    got = clusters.cluster(spark.createDataFrame(rows, schema), work_dir(spark, "clusters"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_lloyd(rows)
    none = clusters.cluster(spark.createDataFrame([], schema), work_dir(spark, "clusters"))
    assert none.columns == got.columns and none.collect() == []


def test_huge_components_stay_in_range(spark):
    rows = [(1, [3e38] * 64), (2, [-3e38] * 64), (3, [0.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = clusters.cluster(df, work_dir(spark, "clusters"), count=1, rounds=0)
    assert {r["distance"] for r in got.collect()} <= {0, 64 * clusters.MOST**2, 64 * (2 * clusters.MOST) ** 2}


def test_blocks_stay_where_they_are(spark, capsys):
    """Assignments move to the bucketed blocks; the blocks themselves are not shuffled again."""
    folder = work_dir(spark, "clusters")
    df = spark.createDataFrame(vectors(1, 40), "vec_id long, embedding array<float>")
    seen = []
    moved = clusters.moved

    def look(shards, assigned, centroids, block):
        shards.join(assigned.hint("shuffle_hash").select("chunk", "cluster"), "chunk").explain()
        seen.append(capsys.readouterr().out)
        return moved(shards, assigned, centroids, block)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(clusters, "moved", look)
        clusters.cluster(df, folder, rounds=1)
    assert len(re.findall(r"Exchange hashpartitioning\(chunk", seen[0])) == 1
    assert "Bucketed: true" in seen[0]


# Periodic runs


def plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@st.composite
def repeating_words(draw):
    words = draw(st.lists(st.integers(0, draw(st.integers(0, 4))), max_size=120))
    for _ in range(draw(st.integers(0, 3))):
        if len(words) > 3:
            a = draw(st.integers(0, len(words) - 1))
            p = draw(st.integers(1, len(words) // 2))
            for i in range(a, draw(st.integers(a, len(words)))):
                words[i] = words[a + (i - a) % p]
    return words


@settings(max_examples=500, deadline=None)
@given(repeating_words())
def test_runs_as_found_by_trying_every_period(words):
    runs = periodic.runs_of(np.array(words, np.int64))
    assert [tuple(map(int, r)) for r in runs] == plain_runs(words)
    text = "\n ".join(f"w{w}" for w in words)
    assert periodic.text_runs(text)[1].decode() == plain_collapse([f"w{w}" for w in words], plain_runs(words))


def test_runs_of_hard_texts():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, a + b
    assert [tuple(r) for r in periodic.runs_of(np.array(b)).tolist()] == plain_runs(b)
    assert periodic.runs_of(np.zeros(300_000, np.int64)).tolist() == [[0, 300_000, 1]]
    line = [*range(40), *range(39, 0, -1)] * 9
    assert [tuple(r) for r in periodic.runs_of(np.array(line)).tolist()] == plain_runs(line)


def plain_op13(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    # Long texts take long to try every period on; a gram of six words must come again within a run.
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    told = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return len(runs), *told, digest(listed), digest(plain_collapse(words, runs))


def test_periodic_query_on_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("length(text) < 6000 or text is null")
    odd = spark.createDataFrame(
        [
            (1_000_001, None), (1_000_002, ""), (1_000_003, " \n"), (None, "a b c " * 30),
            (1_000_004, "same " * 500), (1_000_004, "same " * 500), (1_000_005, " x y\x0bz " * 12),
        ],
        "doc_id long, text string",
    )
    table = docs.unionByName(odd, allowMissingColumns=True)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    rows = table.select("doc_id", "text").collect()
    assert any(zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 and r["text"] for r in rows)
    want = sorted(((r["doc_id"], *plain_op13(r["doc_id"], r["text"])) for r in rows), key=str)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_runs_of_awkward_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert periodic.find_runs(none).collect() == []
    docs = spark.createDataFrame(
        [(1, "x " * 20, "r", "k"), (1, "x " * 20, "r", "k")], "doc_id long, text string, start string, row string"
    )
    got = periodic.find_runs(docs, keep=("doc_id", "start", "row"))
    assert got.columns == ["doc_id", "start", "row", "runs", "kept"]
    assert [(r["runs"], r["kept"]) for r in got.collect()] == [([(0, 20, 1)], "x")] * 2
    assert got.select(F.col("runs")[0]["length"].alias("n")).first()["n"] == 20


def test_files_lie_outside_the_repository():
    assert bpe.RANKS == public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
