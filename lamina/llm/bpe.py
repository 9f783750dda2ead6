"""Byte-level BPE: every distinct word of the corpus is encoded once, and its ids are joined back.

A text's words (pre-tokens) are the matches of the pattern; gaps are left out. The character classes in it
are those of the library whose ids are wanted, read from the library itself. Texts are first cut where a
run of blanks begins, which no match crosses, so that equal cuts are matched once in a task.

1. The words that are frequent in a sample of ``SAMPLE_ROWS`` texts, at most ``HEAD_WORDS`` and
   ``HEAD_BYTES`` of them, are encoded and broadcast. They take the place of the join for hot words, and
   decide nothing else.
2. One pass over all texts writes blocks of rows: the ids of frequent words in order, and a hole for each
   other word, with the block's distinct words at holes. Blocks are bucketed by their number.
3. These words are exploded with block and position, packed by classes of words, and shuffled by class;
   each distinct one is encoded once. The ids go back to their blocks, which stay in their buckets, and
   into the holes by position.

Decoding looks the ids up in the table of token bytes, which the vocabulary bounds.

A null text has no words, as an empty one. A long text is a block of its own, and takes memory in
proportion in the one task that holds its row. Repeated rows give repeated rows; an empty table gives an
empty result. The columns to keep may have any name but ``ids``, or ``decoded``.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections import Counter
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm.arrow import slices
from lamina.llm.text import or_empty

#: Where the ranks lie; only the driver reads the file.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Texts in which frequent words are looked for, and the bounds of what is broadcast of these.
SAMPLE_ROWS = 20_000
HEAD_WORDS = 1 << 17
HEAD_BYTES = 1 << 23
#: Rows and characters of a block.
BLOCK_ROWS, BLOCK_CHARS = 4000, 16_000_000
#: Classes of words for each partition of a shuffle, and the distinct words of one that a task keeps.
CLASSES, KEPT_WORDS = 4, 1_000_000
#: Word counts are compared by their place on a scale of so many steps for each factor of two.
STEPS = 16


def read_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def ranges(chars: str) -> str:
    """The characters, which come in order, as the inside of a character class."""
    at = np.array([ord(c) for c in chars])
    ends = np.flatnonzero(np.diff(at, append=-1) != 1)
    starts = np.concatenate([[0], ends[:-1] + 1])
    return "".join(f"\\U{at[a]:08x}-\\U{at[b]:08x}" for a, b in zip(starts, ends))


def spelled(pattern: str) -> tuple[str, str]:
    """The pattern with its character classes spelled out as the library has them, and its blanks."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    classes = {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        single = {bytes([b]): b for b in range(256)}
        probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks=single, special_tokens={})
        classes[name] = ranges(probe.decode_bytes(probe.encode_ordinary(every)).decode())
    blank = classes[r"\s"]
    inside = re.sub(
        r"\[[^]]*\]", lambda m: re.sub(r"\\p\{.\}|\\s", lambda c: classes[c[0]], m[0]), pattern
    )
    outside = re.sub(r"\\p\{.\}|\\s", lambda c: f"[{classes[c[0]]}]", inside)
    return outside.replace(r"\S", f"[^{blank}]"), blank


class Splitter:
    """Cuts and words of texts."""

    def __init__(self, spelling: tuple[str, str]):
        words, blank = spelling
        self.words = re.compile(words).findall
        self.cuts = re.compile(f"[{blank}]*[^{blank}]+|[{blank}]+").findall


def count_words(texts: DataFrame, spelling: tuple[str, str]) -> DataFrame:
    """(word, n): how often each word stands in ``texts`` (text)."""

    def counts(batches):
        split = Splitter(spelling)
        for batch in batches:
            for part in slices(batch, "text"):
                cuts = Counter(chain.from_iterable(map(split.cuts, part.column("text").to_pylist())))
                words: Counter = Counter()
                for cut, n in cuts.items():
                    for word in split.words(cut):
                        words[word] += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.string()), pa.array(words.values(), pa.int64())],
                    names=["word", "n"],
                )

    counted = texts.mapInArrow(counts, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent(texts: DataFrame, spelling: tuple[str, str], folder: str) -> list[str]:
    """The most frequent words of a sample, within the bounds. Words of equal frequency stay together."""
    fraction = min(1.0, SAMPLE_ROWS / max(1, texts.count()))
    sample = texts.sample(fraction, seed=11) if fraction < 1 else texts
    count_words(sample, spelling).where("n > 1").write.parquet(f"{folder}/frequent")
    table = texts.sparkSession.read.parquet(f"{folder}/frequent")
    step = F.floor(F.log2("n") * STEPS).cast("long")
    steps = table.groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("words"), F.sum(F.octet_length("word")).alias("bytes")
    )
    least, words, size = None, 0, 0
    for row in sorted(steps.collect(), reverse=True):
        words, size = words + row["words"], size + row["bytes"]
        if words > HEAD_WORDS or size > HEAD_BYTES:
            break
        least = row["step"]
    if least is None:
        return []
    return table.where(step >= least).select("word").toArrow().column("word").to_pylist()


def one_match(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    """Encodes words, each of which is one match."""
    return tiktoken.Encoding("words", pat_str=r"(?s:.)+", mergeable_ranks=ranks, special_tokens={})


def packed(size: int) -> np.dtype:
    """Whole numbers that hold the ids of a vocabulary, and one more for holes."""
    return np.dtype("<u2" if size < 1 << 16 else "<u4")


class Numbers(dict):
    """Numbers for keys, in the order in which they were first asked for."""

    def __missing__(self, key):
        self[key] = at = len(self)
        return at

    def of(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))


def spread(flat: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The parts ``at`` of ``flat``, one after the other; its parts are of ``sizes``."""
    first, size = (np.cumsum(sizes) - sizes)[at], sizes[at]
    begin = np.cumsum(size) - size
    return flat[np.repeat(first - begin, size) + np.arange(size.sum())]


def words_of(cuts: list[str], split: Splitter, heads: dict[str, tuple[int, ...]], hole: int):
    """Of all cuts in a row: ids, with holes, and how many each has; the words at holes, and how many."""
    ids, sizes, missing, lacks = [], [], [], []
    for cut in cuts:
        found = heads.get(cut)
        if found is not None:
            ids += found
            sizes.append(len(found))
            lacks.append(0)
            continue
        before, open_ = len(ids), len(missing)
        for word in split.words(cut):
            found = heads.get(word)
            if found is None:
                ids.append(hole)
                missing.append(word)
            else:
                ids += found
        sizes.append(len(ids) - before)
        lacks.append(len(missing) - open_)
    return ids, sizes, missing, lacks


def blocks(
    texts: DataFrame, spelling: tuple[str, str], known, kind: np.dtype, classes: int
) -> DataFrame:
    """``texts`` (kept, text) in blocks of rows.

    kept: the rows' own columns; ends: where each row's ids end in ``packed``, the block's ids; words: the
    distinct words at holes, by classes, each with the place of its first word, the words' sizes and bytes;
    spots: for each hole in order, the place of its word.
    """
    hole = int(np.iinfo(kind).max)

    def parted(words: list[str]) -> tuple[np.ndarray, list]:
        """The words' places by class, and what of them goes into the table."""
        of = np.array([xxhash.xxh32_intdigest(w) % classes for w in words], np.int64)
        order = np.argsort(of, kind="stable")
        place = np.empty(len(of), np.int64)
        place[order] = np.arange(len(of))
        letters = [words[i].encode() for i in order]
        starts = np.flatnonzero(np.diff(of[order], prepend=-1))
        rows = []
        for a, b in zip(starts, [*starts[1:], len(of)]):
            sizes = np.array([len(w) for w in letters[a:b]], "<u4")
            rows.append((int(of[order[a]]), int(a), sizes.tobytes(), b"".join(letters[a:b])))
        return place, rows

    names = ("class", "first", "sizes", "letters")
    rows_kind = pa.list_(
        pa.struct(list(zip(names, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))))
    )

    def run(batches):
        split, heads = Splitter(spelling), known.value
        cuts, kept, rows, chars = Numbers(), [], [], 0

        def out():
            ids, sizes, missing, lacks = words_of(list(cuts), split, heads, hole)
            ids, sizes, lacks = np.array(ids, kind), np.array(sizes, np.int64), np.array(lacks, np.int64)
            at = np.concatenate(rows)
            words = Numbers()
            spots = spread(words.of(missing), lacks, at)
            place, parts = parted(list(words))
            held = pa.chunked_array(kept).combine_chunks()
            sizes_of_rows = np.add.reduceat(
                np.append(sizes[at], 0), np.cumsum([0, *map(len, rows[:-1])])
            ) * np.array([len(r) > 0 for r in rows])
            fields = [
                pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held),
                pa.array([np.cumsum(sizes_of_rows)], pa.list_(pa.int64())),
                pa.array([spread(ids, sizes, at).tobytes()], pa.binary()),
                pa.array([[dict(zip(names, r)) for r in parts]], rows_kind),
                pa.array([place[spots].astype("<i4").tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(fields, names=["kept", "ends", "packed", "words", "spots"])

        for batch in batches:
            column, start = batch.column("kept"), 0
            for at, text in enumerate(batch.column("text")):
                text = text.as_py()
                if rows and (chars + len(text) > BLOCK_CHARS or len(rows) >= BLOCK_ROWS):
                    kept.append(column.slice(start, at - start))
                    yield out()
                    cuts, kept, rows, chars, start = Numbers(), [], [], 0, at
                rows.append(cuts.of(split.cuts(text)))
                chars += len(text)
            kept.append(column.slice(start))
        if rows:
            yield out()

    own = texts.schema["kept"].dataType.simpleString()
    parts = "array<struct<class:int,first:int,sizes:binary,letters:binary>>"
    return texts.mapInArrow(
        run, f"kept array<{own}>, ends array<long>, packed binary, words {parts}, spots binary"
    )


def encode_words(missing: DataFrame, ranks, kind: np.dtype) -> DataFrame:
    """(block, first, sizes, ids) of ``missing`` (block, class, first, sizes, letters).

    All words of a class are in one task, one class after the other, and each distinct one is encoded once.
    """

    def run(batches):
        encoding = one_match(ranks.value)
        last, known = None, {}
        for batch in batches:
            sizes, ids = [], []
            held = (batch.column(c) for c in ("class", "sizes", "letters"))
            for of, lengths, letters in zip(*held):
                if of.as_py() != last or len(known) > KEPT_WORDS:
                    last, known = of.as_py(), {}
                letters, start, found = letters.as_py(), 0, []
                for end in np.cumsum(np.frombuffer(lengths.as_buffer(), "<u4"), dtype=np.int64).tolist():
                    word = letters[start:end]
                    start = end
                    code = known.get(word)
                    if code is None:
                        code = np.array(encoding.encode_ordinary(word.decode()), kind).tobytes()
                        known[word] = code
                    found.append(code)
                sizes.append(np.array([len(c) // kind.itemsize for c in found], "<u4").tobytes())
                ids.append(b"".join(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("first"), pa.array(sizes), pa.array(ids)],
                names=["block", "first", "sizes", "ids"],
            )

    by_class = missing.repartition("class").sortWithinPartitions("class")
    return by_class.mapInArrow(run, "block long, first int, sizes binary, ids binary")


def fill(
    row: np.ndarray, spots: np.ndarray, sizes: np.ndarray, flat: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """A block's ids with those of the words at holes, and how many ids each place became.

    Hole i is the word ``spots[i]``; all words' ids follow each other in ``flat``.
    """
    is_hole = row == np.iinfo(row.dtype).max
    times = np.ones(len(row), np.int32)
    times[is_hole] = sizes[spots]
    out = np.repeat(row, times)
    out[np.repeat(is_hole, times)] = spread(flat, sizes, spots)
    return out, times


def filled(rows: DataFrame, kind: np.dtype) -> DataFrame:
    """The rows (kept, ids) of the blocks; ``patches`` (first, sizes, ids) come in order, or are null."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                held = {name: batch.column(name)[i] for name in batch.schema.names}
                ids = np.frombuffer(held["packed"].as_buffer(), kind)
                ends = held["ends"].values.to_numpy()
                if held["patches"].is_valid:
                    spots = np.frombuffer(held["spots"].as_buffer(), "<i4")
                    parts = held["patches"].values
                    sizes = np.frombuffer(b"".join(parts.field("sizes").to_pylist()), "<u4")
                    flat = np.frombuffer(b"".join(parts.field("ids").to_pylist()), kind)
                    ids, times = fill(ids, spots, sizes.astype(np.int64), flat)
                    ends = np.concatenate([[0], np.cumsum(times, dtype=np.int64)])[ends]
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([held["kept"].values, lists], names=["kept", "ids"])

    own = rows.schema["kept"].dataType.elementType.simpleString()
    return rows.mapInArrow(run, f"kept {own}, ids array<int>")


def encode(
    docs: DataFrame,
    folder: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    ranks: dict[bytes, int] | None = None,
    pattern: str = PATTERN,
) -> DataFrame:
    """The columns ``keep`` of every row and ``ids``, array<int>. Tables go to ``folder``."""
    spark = docs.sparkSession
    ranks = ranks or read_ranks()
    kind, spelling = packed(max(ranks.values()) + 1), spelled(pattern)
    texts = docs.select(F.struct(*keep).alias("kept"), or_empty(F.col(text)).alias("text"))

    encoding = one_match(ranks)
    heads = {
        w: tuple(encoding.encode_ordinary(w))
        for w in frequent(texts.select("text"), spelling, folder)
    }
    known = spark.sparkContext.broadcast(heads)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = blocks(texts, spelling, known, kind, CLASSES * buckets)
    # A block's number, given as the block is written, holds from there on.
    made = made.withColumn("block", F.monotonically_increasing_id())
    name = f"bpe_{uuid.uuid4().hex}"
    made.write.bucketBy(buckets, "block").options(path=f"{folder}/blocks", compression="zstd").saveAsTable(
        name
    )
    table = spark.table(name)
    # Only the name goes; the files are the caller's, and the bucketing is known by now.
    spark.sql(f"DROP TABLE {name}")

    missing = table.select("block", F.explode("words").alias("part")).select("block", "part.*")
    found = encode_words(missing, spark.sparkContext.broadcast(ranks), kind)
    patches = found.groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("first", "sizes", "ids"))).alias("patches")
    )
    whole = table.select("block", "kept", "ends", "packed", "spots").join(patches, "block", "left")
    return filled(whole.drop("block"), kind).select("kept.*", "ids")


def token_table(spark: SparkSession, ranks: dict[bytes, int] | None = None):
    """The bytes of every id, broadcast; none where the vocabulary has no such id."""
    ranks = ranks or read_ranks()
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return spark.sparkContext.broadcast(table)


def decode(encoded: DataFrame, ranks: dict[bytes, int] | None = None) -> DataFrame:
    """``encoded`` (any columns, ids) with ``decoded``, the ids' bytes in a row.

    Null ids give null. An id that the vocabulary lacks, or a null one, adds nothing.
    """
    held = token_table(encoded.sparkSession, ranks)

    def make():
        table = pa.array(held.value, pa.binary())

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for ids in part.column("ids"):
                if not ids.is_valid:
                    out.append(None)
                    continue
                at = ids.values.drop_null().to_numpy()
                tokens = table.take(pa.array(at[(at >= 0) & (at < len(table))]))
                _, ends, data = tokens.buffers()
                end = np.frombuffer(ends, np.int32)[len(tokens)] if len(tokens) else 0
                out.append(data[:end].to_pybytes() if end else b"")
            return pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(out, pa.binary())], names=[*part.schema.names, "decoded"]
            )

        return work

    def run(batches):
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                yield work(batch.slice(at, 200))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{kinds}, decoded binary")
