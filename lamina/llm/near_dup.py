"""Near copies by Order MinHash, verified by banded alignment.

A text's k-mers are its runs of two words, each labelled with how many equal ones stand before it. For
each of ``TABLES`` hash functions the ``DEPTHS`` least k-mers are taken and put back into text order; the
hash of that sequence is the text's bucket. Texts of at most ``SHORT`` words have buckets by the three
least of their single words instead, and those of ``SHORT`` words less a fifth to ``SHORT`` have both, so
that two texts that may be linked always have buckets of one kind.

Two texts of which a fifth of the words are replaced miss each other in all buckets less than once in a
hundred times, however the replaced words are spread: of 25 words with 5 replaced apart from each other 14
of 34 pairs of words are common, so a table finds 14 * 13 / (34 * 33) and 28 tables miss 0.7 %; longer
texts miss less, down to 0.4 %. Of 5 words with one replaced 4 of 6 are common, and 28 tables miss 0.2 %.

A pair is linked if its edit similarity, 1 - (word edits / words of the longer text), is at least
``SIMILARITY``. The alignment keeps to the band outside which a pair cannot be that similar.

First the texts of a bucket are paired with one of them, its leader, which is another one for each third
of the tables. Buckets whose texts are then still in different groups are gone through in whole: any two
of their texts from different groups are compared, unless their lengths or their words rule a link out.

Texts meet only where their signatures allow a link. A signature holds, for each class of words, whether
their number is odd, where a word that comes again is another word each time. An edit of one word changes
two classes at most, and less where it changes the length, so signatures that differ in more bits than the
allowed edits can change rule a link out. A text has four bits or more for each word; a longer signature is
folded to the length of a shorter one. At most ``CARRIED`` bits, all of most texts, go along into buckets and cells;
the whole ones are compared once for each pair that has met with less.

In buckets of more than ``CROWD`` texts, those are paired that share one of their rarest words or runs of
two words, and each text is there once, in however many such buckets it is. A link leaves at most a fifth
of either text's words and two fifths of its runs unmatched, so two linked texts share a word among a fifth
and one more of each, and a run among two fifths and one more. Each text goes by the kind that fewer texts
share with it: runs are rarer, but a passage that many documents hold is among a text's rarest runs from
three fifths of its length on, and among its rarest words from four fifths on. Texts of different kinds
meet by runs. Each text brings its signature to the cells of those words and runs, and the texts of a cell are
compared there, in blocks of at most ``CROWD`` against as many; only pairs whose signatures allow a link become
rows. Texts that share a passage and are just too different to be linked may still all be compared in pairs: the
comparisons, and in cells of many blocks the copies of signatures, grow with the square of their number.

Groups are the connected texts. Texts that are equal are one text throughout, so copies are never paired.

Words are parted by blanks, with A-Z lowered. A null text is a group of its own for each row; all texts
without words but with equal characters are equal texts. Groups are named by their least id (null ids
last). Repeated rows give repeated rows. Empty tables give empty results; other columns are left out.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lamina.llm.arrow import Rows, map_slices, slices
from lamina.session import work_dir
from lamina.sources.files import Store

WORDS = 2
SIMILARITY = 0.8
TABLES = 28
DEPTHS = (2,)
#: Words of a text that has buckets by single words, and how many of them make a bucket.
SHORT = 24
SHORT_DEPTHS = (3,)
CACHE = 400_000
#: Three orders of ids: which of a bucket's texts leads it.
ORDERS = (0, 0x2AAAAAAAAAAAAAAA, 0x5555555555555555)
#: Buckets of at most so many texts are gone through in whole, others by rare words; also the texts of a block.
CROWD = 512
#: Bits of a signature that go along into buckets and cells at most; a power of two.
CARRIED = 4096
#: Runs of words are ordered by the counts of so many classes of runs.
CLASSES = 1 << 18
#: So many counts make a row.
BLOCK = 1 << 12
#: Bits of a signature for each word, and of the least signature; a power of two.
SPREAD = 4
FOLD = 512
#: What a row is in its block of a cell: one of the left texts, of the right ones, or of both.
LEFT, RIGHT, BOTH = 1, 2, 3
#: Hash matrix cells that are held at once.
CELLS = 2_000_000

ODD = np.uint64(0x9E3779B97F4A7C15)
MORE = np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MORE
    return (x ^ (x >> np.uint64(29))) * ODD


SEEDS = mix(np.arange(1, TABLES + 1, dtype=np.uint64) * ODD)


def kmers(words: np.ndarray, width: int = WORDS) -> np.ndarray:
    """The labelled k-mers of a text's word hashes, in text order; all are distinct."""
    if not len(words):
        return words
    width = min(width, len(words))
    count = len(words) - width + 1
    runs = np.full(count, width, np.uint64)
    for i in range(width):
        runs = mix(runs + words[i : i + count])
    order = np.argsort(runs, kind="stable")
    ordered = runs[order]
    new = np.ones(count, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    if not new.all():
        first = np.flatnonzero(new)
        label = np.arange(count) - np.repeat(first, np.diff(np.append(first, count)))
        # First ones stay as they are in a text that repeats nothing.
        again = label > 0
        runs[order[again]] = mix(ordered[again] + label[again].astype(np.uint64) * MORE)
    return runs


def sketch(found: np.ndarray, depths: tuple[int, ...] = DEPTHS) -> np.ndarray:
    """The buckets of a text: for each table and depth a hash of its least k-mers in text order."""
    n = len(found)
    if not n:
        return np.zeros(0, np.int64)
    deepest = min(depths[-1], n)
    least = []
    step = max(1, CELLS // n)
    for at in range(0, TABLES, step):
        ranks = (found ^ SEEDS[at : at + step, None]) * ODD
        ranks ^= ranks >> np.uint64(32)
        ranks *= MORE
        if n > deepest:
            near = np.argpartition(ranks, deepest - 1, axis=1)[:, :deepest]
        else:
            near = np.broadcast_to(np.arange(n), ranks.shape).copy()
        order = np.argsort(np.take_along_axis(ranks, near, 1), axis=1)
        least.append(np.take_along_axis(near, order, 1))
    least = np.concatenate(least)
    keys = []
    for depth in depths:
        places = np.sort(least[:, : min(depth, n)], axis=1)
        key = SEEDS + np.uint64(depth)
        for column in found[places].T:
            key = mix(key + column)
        keys.append(key)
    return np.concatenate(keys).view(np.int64)


def edit_distance(a: list, b: list, most: int) -> int:
    """Words to insert, drop or replace to turn ``a`` into ``b``, or ``most`` + 1 if more are needed.

    Columns of the alignment table as bit vectors, cut to the band of ``most`` cells on either side of
    the diagonal, which no cheaper alignment leaves. Bit t of column j is row j + t - most; set bits of
    ``up`` and ``down`` are steps of +1 and -1 from the row above. The band's last row is followed along
    its diagonal, and along the table's last row once it is there.
    """
    if len(a) < len(b):
        a, b = b, a
    start, end, other = 0, len(a), len(b)
    while start < other and a[start] == b[start]:
        start += 1
    while other > start and a[end - 1] == b[other - 1]:
        end, other = end - 1, other - 1
    a, b = a[start:end], b[start:other]
    if len(a) - len(b) > most:
        return most + 1
    if not b:
        return len(a)
    band = min(most, len(a))
    if not band:
        return 1
    places: dict = {}
    for at, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << at
    width = 2 * band + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    up, down, cost = full >> band << band, 0, band
    row = top >> 1
    for j, word in enumerate(b):
        same = places.get(word, 0)
        same = (same >> (j - band) if j >= band else same << (band - j)) & full
        flat = ((((same & up) + up) ^ up) | same | down) & full
        right, left = down | ~(flat | up) & full, flat & up
        if j < len(a) - band:
            cost += not flat & top
        else:
            cost += bool(right & row) - bool(left & row)
            row >>= 1
        flat >>= 1
        up, down = left | ~(flat | right) & full, flat & right
    return min(cost, most + 1)


def buckets(words: np.ndarray) -> np.ndarray:
    """A text's buckets by runs of words, by single words if it is short, or by both."""
    keys = []
    if len(words) >= SHORT - unmatched(SHORT, SIMILARITY):
        keys.append(sketch(kmers(words)))
    if len(words) <= SHORT:
        keys.append(sketch(kmers(words, 1), SHORT_DEPTHS))
    return np.concatenate(keys)


def unmatched(longer: int, least: float) -> int:
    """How many words of the longer text a link may leave without a match."""
    return int((1 - least) * longer + 1e-9)


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """1 - (edit distance of the words / words of the longer text); 0 if that is less than ``least``.

    What the texts' bags of words differ by is a lower bound, and saves most alignments.
    """
    longer = max(len(a), len(b))
    if not longer:
        return 0.0
    most = unmatched(longer, least)
    if longer - min(len(a), len(b)) > most:
        return 0.0
    both = np.concatenate([a, b])
    _, at = np.unique(both, return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    times = np.bincount(left, minlength=len(both)) - np.bincount(right, minlength=len(both))
    if max(times[times > 0].sum(), -times[times < 0].sum()) > most:
        return 0.0
    distance = edit_distance(a.tolist(), b.tolist(), most)
    return 1 - distance / longer if distance <= most else 0.0


def signature(words: np.ndarray) -> np.ndarray:
    """Whether the labelled words of each class are odd in number, one bit a class, in whole numbers of 64 bits."""
    bits = max(FOLD, 1 << (SPREAD * len(words) - 1).bit_length()) if len(words) else FOLD
    odd = np.bincount((kmers(words, 1) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A signature in ``size`` numbers: the classes that fall together are odd if their sum is."""
    return np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)


def room(left, right, least: float):
    """In how many bits the signatures of linked texts of ``left`` and ``right`` words differ at most.

    Negative if their lengths alone rule a link out. A replaced word changes two classes; what one text
    has more takes up edits that change one.
    """
    longer, shorter = np.maximum(left, right), np.minimum(left, right)
    most = ((1 - least) * longer + 1e-9).astype(np.int64)
    spare = most - (longer - shorter)
    return np.where(spare < 0, -1, most + spare)


def splitter():
    """A function from texts to the hashes of their words."""
    rows = Rows(lambda w: xxhash.xxh64_intdigest(w), CACHE, np.uint64)

    def of(texts: list[str]) -> list[np.ndarray]:
        rows.trim()
        ids = [rows.numbers(t.encode().lower().split()) for t in texts]
        hashes = rows.table()
        return [hashes[i] for i in ids]

    return of


def sketches(texts: DataFrame) -> DataFrame:
    """``texts`` (blob, low, text) with ``keys``, the number of ``words``, and the signature ``bits``."""

    def make():
        split = splitter()

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            words = split(part.column("text").to_pylist())
            return pa.RecordBatch.from_arrays(
                [
                    *part.columns,
                    pa.array([buckets(w) for w in words], pa.list_(pa.int64())),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([signature(w).tobytes() for w in words], pa.binary()),
                ],
                names=[*part.schema.names, "keys", "words", "bits"],
            )

        return work

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema)
    return map_slices(texts, make, f"{kinds}, keys array<long>, words long, bits binary")


def turned(number: Column, key: Column) -> Column:
    """An id in the order of the bucket's third; doing it twice undoes it."""
    third = F.pmod(key, F.lit(len(ORDERS)))
    order = F.when(third == 0, ORDERS[0]).when(third == 1, ORDERS[1]).otherwise(ORDERS[2])
    return number.bitwiseXOR(order)


def candidates(sketched: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(a, b): each text with the leaders of its buckets, each pair once, unless the lengths rule a link out.

    ``sketched`` has (id, words, keys).
    """
    words = F.col("words").cast("int").alias("words")
    rows = sketched.select("id", words, F.explode(F.array_distinct("keys")).alias("key"))
    key = F.col("key")
    first = F.struct(turned(F.col("id"), key).alias("turned"), "words")
    leaders = (
        rows.groupBy("key")
        .agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("key", turned(F.col("first.turned"), key).alias("leader"), F.col("first.words").alias("others"))
    )
    longer, shorter = F.greatest("words", "others"), F.least("words", "others")
    near = longer - shorter <= (1 - least) * longer + 1e-9
    pairs = rows.join(leaders, "key").where((F.col("id") != F.col("leader")) & near)
    return pairs.select(
        F.greatest("id", "leader").alias("a"), F.least("id", "leader").alias("b")
    ).distinct()


def possible(pairs: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The ``pairs`` (a, b) that lengths and signatures allow to be linked; ``texts`` has (id, words, bits)."""

    def keep(batches):
        for batch in batches:
            words_a, words_b = (batch.column(c).to_numpy() for c in ("words_a", "words_b"))
            most = room(words_a, words_b, least)
            held = []
            for at in np.flatnonzero(most >= 0).tolist():
                x, y = (np.frombuffer(batch.column(c)[at].as_buffer(), np.uint64) for c in ("bits_a", "bits_b"))
                size = min(len(x), len(y))
                if np.bitwise_count(folded(x, size) ^ folded(y, size)).sum(dtype=np.int64) <= most[at]:
                    held.append(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(held, pa.int64())) for c in ("a", "b")], names=["a", "b"]
            )

    def side(name: str) -> DataFrame:
        return texts.select(
            F.col("id").alias(name), F.col("words").alias(f"words_{name}"), F.col("bits").alias(f"bits_{name}")
        )

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "words_a", "words_b", "bits_a", "bits_b").mapInArrow(keep, "a long, b long")


def unlike(part: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the pairs in ``part`` that may be linked and are in different groups, and whether whole signatures say so.

    ``part`` has (key, id, root, words, bits, place, before, width, role) and is sorted by key. Two texts of a key are a
    pair if their roles make ``BOTH`` together; by ``place`` and ``before`` see ``across``.
    """
    key, ids, root, words, place, before, width, role = (
        part.column(c).to_numpy() for c in ("key", "id", "root", "words", "place", "before", "width", "role")
    )
    held = part.column("bits").to_pylist()
    sizes = np.array([len(b) for b in held]) // 8
    whole = b"".join(b.ljust(8 * sizes.max(), b"\0") for b in held)
    whole = np.frombuffer(whole, np.uint64).reshape(len(ids), -1)
    # Zeros at the end leave what a signature is folded to as it is.
    levels = {n: np.bitwise_xor.reduce(whole.reshape(len(ids), -1, n), axis=1) for n in np.unique(sizes).tolist()}
    left, right, at, apart = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.arange(len(ids)), 0
    brief = SPREAD * words <= CARRIED
    while len(at):
        apart += 1
        at = at[at + apart < len(ids)]
        at = at[key[at] == key[at + apart]]
        x = at[(root[at] != root[at + apart]) & (role[at] | role[at + apart] == BOTH)]
        x = x[(before[x] != before[x + apart]) | (before[x] == 0)]
        y = x + apart
        most, longer = room(words[x], words[y], least), np.maximum(words[x], words[y])
        # A word that only the longer text has leaves no word of the shorter one without a match.
        free = width[x] * (1 - least) * longer + 1e-9 - longer
        may = (most >= 0) & (place[x] - words[x] <= free) & (place[y] - words[y] <= free)
        x, y, most = x[may], y[may], most[may]
        size = np.minimum(sizes[x], sizes[y])
        for n in np.unique(size).tolist():
            of = size == n
            differ = np.bitwise_count(levels[n][x[of]] ^ levels[n][y[of]]).sum(axis=1, dtype=np.int64)
            near = differ <= most[of]
            left.append(x[of][near])
            right.append(y[of][near])
    x, y = np.concatenate(left), np.concatenate(right)
    return np.maximum(ids[x], ids[y]), np.minimum(ids[x], ids[y]), brief[x] & brief[y]


def within(rows: DataFrame, least: float) -> DataFrame:
    """(a, b, tested): the pairs of ``unlike``. No key has many more rows than two blocks."""

    def work(batches):
        def out(part):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in unlike(part, least)], names=["a", "b", "tested"])

        held = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = part if held is None else pa.concat_tables([held, part])
            keys = part.column("key").to_numpy()
            # The last bucket may go on in the next batch.
            last = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
            if last:
                yield out(part.slice(0, last))
            held = part.slice(last)
        if held is not None:
            yield out(held)

    ordered = rows.select("key", "id", "root", "words", "bits", "place", "before", "width", "role").repartition("key")
    return ordered.sortWithinPartitions("key").mapInArrow(work, "a long, b long, tested boolean")


def rest(texts: DataFrame, roots: DataFrame, known: DataFrame, least: float, folder: str) -> DataFrame:
    """(a, b, tested): the pairs of texts that share a bucket, are in different groups and may still be linked.

    Those that are ``tested`` have met with their whole signatures. ``texts`` is that of ``sketches`` with ``id``, ``roots`` (id, root) those that are linked to any, and
    ``known`` the pairs that were compared.
    """
    keys = F.explode(F.array_distinct("keys")).alias("key")
    of_root = F.coalesce("root", "id").alias("root")
    rows = texts.select("id", keys).join(roots, "id", "left").select("key", "id", of_root)
    mixed = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high")
    ).where("n > 2 and low < high")
    crowd = F.col("n") > CROWD
    open_rows, seen = stored(
        rows.join(mixed.select("key", "n"), "key"),
        f"{folder}/open",
        n=F.count(F.lit(1)),
        crowded=F.count_if(crowd),
    )
    if not seen["n"]:
        return known.limit(0).withColumn("tested", F.lit(False))
    part = map_slices(texts.select("id", "words", "bits"), fold, "id long, words long, bits binary", "bits")
    of_bucket = {"place": F.lit(0), "before": F.lit(0), "width": F.lit(1), "role": F.lit(BOTH)}
    pairs = within(open_rows.where(~crowd).join(part, "id").withColumns(of_bucket), least)
    if seen["crowded"]:
        crowded = open_rows.where(crowd).select("id", "root").distinct()
        pairs = pairs.unionByName(across(crowded, texts.select("id", "text"), least, folder))
    return pairs.distinct().join(known, ["a", "b"], "left_anti")


def carried(bits: np.ndarray) -> bytes:
    """The part of a signature that goes into buckets and cells."""
    return folded(bits, min(len(bits), CARRIED // 64)).tobytes()


def fold():
    """A function from slices (id, words, bits) to the same with the part that goes into buckets."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        bits = [carried(np.frombuffer(b, np.uint64)) for b in part.column("bits").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [part.column("id"), part.column("words"), pa.array(bits, pa.binary())], names=["id", "words", "bits"]
        )

    return work


def rarity(texts: DataFrame) -> list[np.ndarray]:
    """How often the words and the runs of ``WORDS`` words of each class of hashes occur in ``texts`` (text)."""
    parts, kinds = CLASSES // BLOCK, (1, WORDS)

    def counts(batches):
        split, total = splitter(), np.zeros((len(kinds), CLASSES), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for words in split(part.column("text").to_pylist()):
                    for row, width in zip(total, kinds):
                        np.add.at(row, (kmers(words, width) % np.uint64(CLASSES)).astype(np.int64), 1)
        blocks = total.reshape(-1, BLOCK)
        held = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(held), pa.array(list(blocks[held]), pa.list_(pa.int64()))], names=["block", "times"]
        )

    def added(part: pa.Table) -> pa.Table:
        times = part.column("times").combine_chunks().flatten().to_numpy().reshape(-1, BLOCK).sum(axis=0)
        return pa.table({"block": part.column("block").slice(0, 1), "times": pa.array([times], pa.list_(pa.int64()))})

    kind = "block long, times array<long>"
    found = texts.select("text").mapInArrow(counts, kind).groupBy("block").applyInArrow(added, kind).toArrow()
    blocks = np.zeros((len(kinds) * parts, BLOCK), np.int64)
    for block, times in zip(found.column("block").to_pylist(), found.column("times")):
        blocks[block] = times.values.to_numpy()
    return list(blocks.reshape(len(kinds), CLASSES))


def rarest(words: np.ndarray, times: np.ndarray, least: float, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A text's first labelled runs of ``width`` words in an order that is the same for all texts, rarest first.

    A link leaves at most ``width`` * (1 - ``least``) of the words' number of a text's runs unmatched, so the
    first of the runs that two linked texts share is among so many and one more of each. Those of classes that
    occur once are in no other text and left out. Also, their places in that order, and about how often other
    texts hold one of them.
    """
    found = kmers(words, width)
    often = times[(found % np.uint64(CLASSES)).astype(np.int64)]
    order = np.lexsort((found, often))[: int(width * (1 - least) * len(words) + 1e-9) + 1]
    often = often[order]
    places = np.flatnonzero(often > 1)
    return found[order][places].view(np.int64), places, int((often - 1).sum())


def listed(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.ListArray:
    """For each text of ``found`` (cells, places) its cells with place and the cell ``before``, 0 for none."""
    none = [np.zeros(0, np.int64)]
    cells, places = (np.concatenate([f[i] for f in found] or none) for i in (0, 1))
    before = np.concatenate([np.append(0, f[0])[: len(f[0])] for f in found] or none)
    starts = np.cumsum([0, *(len(f[0]) for f in found)])
    rows = pa.StructArray.from_arrays([pa.array(x) for x in (places, cells, before)], ["place", "cell", "before"])
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), rows)


def across(rows: DataFrame, texts: DataFrame, least: float, folder: str) -> DataFrame:
    """(a, b, tested): pairs of the texts in ``rows`` (id, root) that may be linked and are in different groups.

    In each cell, the texts that share one of their rarest runs, or of their rarest words, those out of the
    largest group are compared with all others, so a large group isn't compared with itself. Texts that go by
    words lend their runs to those that go by runs, and meet only these there. The first run that linked texts
    share stands at a ``place`` among a text's rarest that their lengths bound. Two texts that have the same cell
    ``before`` this one have met there already.

    A cell of more than ``CROWD`` texts is cut into blocks of left and of right texts, and each left block meets
    each right one apart, so that neither a task nor its memory follows the size of a cell.
    """
    rows, _ = stored(rows, f"{folder}/crowded", n=F.count(F.lit(1)))
    own = texts.join(rows.select("id"), "id", "left_semi")
    context = rows.sparkSession.sparkContext
    held = [context.broadcast(times) for times in rarity(own)]

    def make():
        split = splitter()

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            words = split(part.column("text").to_pylist())
            first, runs, by_word, bits = [], [], [], []
            none = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for w in words:
                (*single, singles), (*pairs, doubles) = (
                    rarest(w, times.value, least, width) for times, width in zip(held, (1, WORDS))
                )
                by_word.append(singles < doubles)
                first.append(single if by_word[-1] else pairs)
                runs.append(pairs if by_word[-1] else none)
                bits.append(carried(signature(w)))
            return pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array([len(w) for w in words], pa.int64()),
                    listed(first),
                    listed(runs),
                    pa.array(by_word, pa.bool_()),
                    pa.array(bits, pa.binary()),
                ],
                names=["id", "words", "first", "runs", "by_word", "bits"],
            )

        return work

    cut_kind = "array<struct<place: long, cell: long, before: long>>"
    kind = f"id long, words long, first {cut_kind}, runs {cut_kind}, by_word boolean, bits binary"
    firsts, _ = stored(map_slices(own, make, kind).join(rows, "id"), f"{folder}/firsts", n=F.count(F.lit(1)))
    by_word = F.col("by_word")

    def cut(kept: DataFrame, runs: str, width: Column, lent: bool) -> DataFrame:
        one = width.alias("width"), F.lit(lent).alias("lent")
        return kept.select("id", "root", *one, F.inline(runs))

    own_cells = cut(firsts, "first", F.when(by_word, 1).otherwise(WORDS), False)
    lent_cells = cut(firsts.where(by_word), "runs", F.lit(WORDS), True).join(
        own_cells.where(F.col("width") == WORDS).select("cell").distinct(), "cell", "left_semi"
    )
    cells, _ = stored(own_cells.unionByName(lent_cells), f"{folder}/cells", n=F.count(F.lit(1)))
    n_left = F.when(F.col("n_lent") > 0, F.col("n") - F.col("n_lent")).otherwise(F.col("n") - F.col("largest.n"))

    def blocks(count: Column) -> Column:
        return F.when(F.col("n") > CROWD, F.ceil(count / CROWD)).otherwise(0)

    mixed = (
        cells.groupBy("cell", "root")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("lent").alias("n_lent"))
        .groupBy("cell")
        .agg(
            F.max(F.struct("n", "root")).alias("largest"),
            F.count(F.lit(1)).alias("roots"),
            F.sum("n").alias("n"),
            F.sum("n_lent").alias("n_lent"),
        )
        .where("roots > 1 and n_lent < n")
        .withColumns({"lefts": blocks(n_left), "rights": blocks(F.col("n"))})
    )
    left = ~F.col("lent") & ((F.col("n_lent") > 0) | (F.col("root") != F.col("largest.root")))
    spot = F.struct("cell", "place", "before", "width", "lent", left.alias("left"), "lefts", "rights").alias("spot")
    # The signatures join one row a text, and go into cells from there.
    spots = cells.join(mixed, "cell").select("id", spot).groupBy("id").agg(F.collect_list("spot").alias("spots"))
    sides = firsts.join(spots, "id").select("id", "root", "words", "bits", F.explode("spots").alias("s"))

    def block(x, y, role: Column):
        return F.struct(F.xxhash64("s.cell", x, y).alias("key"), role.alias("role"))

    def others(count: str, to):
        return F.transform(F.sequence(F.lit(0).cast("long"), F.col(count) - 1), to)

    draw = F.xxhash64("id")
    as_left = others("s.rights", lambda j: block(F.pmod(draw, F.col("s.lefts")), j, F.lit(LEFT)))
    as_right = others("s.lefts", lambda i: block(i, F.pmod(draw, F.col("s.rights")), F.lit(RIGHT)))
    undivided = F.array(block(F.lit(0), F.lit(0), F.when(F.col("s.lent"), LEFT).otherwise(BOTH)))
    divided = F.when(F.col("s.left"), F.concat(as_left, as_right)).otherwise(as_right)
    meets = F.when(F.col("s.rights") > 0, divided).otherwise(undivided)
    met = sides.select("id", "root", "words", "bits", "s.place", "s.before", "s.width", F.inline(meets))
    return within(met, least)


def verify(pairs: DataFrame, texts: DataFrame, least: float, folder: str) -> DataFrame:
    """(a, b) of the pairs that align, as a table in ``folder``; ``texts`` has (id, text, words, bits).

    Only the texts of possible pairs move. Pairs that are ``tested`` are known to be possible.
    """

    def make():
        split = splitter()

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            left = split(part.column("text_a").to_pylist())
            # Pairs come sorted by b, so that its text is split once for a run of pairs.
            b, text_b = part.column("b").to_pylist(), part.column("text_b")
            starts = [i for i in range(len(b)) if not i or b[i] != b[i - 1]]
            right = split([text_b[i].as_py() for i in starts])
            runs = np.repeat(np.arange(len(starts)), np.diff([*starts, len(b)]))
            found = np.array([similarity(x, right[r], least) for x, r in zip(left, runs)])
            held = pa.array(np.flatnonzero(found > 0))
            return pa.RecordBatch.from_arrays([part.column(c).take(held) for c in "ab"], names=["a", "b"])

        return work

    if "tested" in pairs.columns:
        left = possible(pairs.where("not tested"), texts, least).unionByName(pairs.where("tested").select("a", "b"))
    else:
        left = possible(pairs, texts, least)
    left, _ = stored(left, f"{folder}/possible", n=F.count(F.lit(1)))
    needed = left.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    needed, _ = stored(needed, f"{folder}/needed", n=F.count(F.lit(1)))
    own, _ = stored(
        texts.select("id", "text").join(needed, "id", "left_semi"), f"{folder}/own", n=F.count(F.lit(1))
    )
    one = left.join(own.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = one.join(own.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    found = map_slices(both.select("a", "b", "text_a", "text_b"), make, "a long, b long", "text_a")
    links, _ = stored(found, f"{folder}/links", n=F.count(F.lit(1)))
    dropped(links.sparkSession, folder, "possible", "needed", "own")
    return links


def dropped(spark, folder: str, *names: str) -> None:
    """Deletes tables of ``folder`` that nothing reads again, as all made from them are stored."""
    store = Store(spark, folder)
    for name in names:
        store.remove(f"{folder}/{name}")


def stored(df: DataFrame, path: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``df`` written to ``path`` and read again, with ``counts`` over its rows taken on the way."""
    seen = Observation()
    kept = df.observe(seen, *[c.alias(n) for n, c in counts.items()])
    kept.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


def components(links: DataFrame, folder: str) -> DataFrame:
    """(id, root) for every id in ``links`` (a, b): a member of its component, the same for all of it.

    In each round every id points to its least neighbour if that is less than itself. Pointers are
    followed, doubling their reach, until all end at an id that points nowhere; then each such tree is
    drawn together into its end, and only the links between different trees go on to the next round.
    Trees have two ids at least, so the rounds are few and soon small. All tables go to ``folder``.
    """
    edges, roots = links.select("a", "b"), None
    for turn in itertools.count():
        ends = F.explode(
            F.array(
                F.struct(F.col("a").alias("id"), F.col("b").alias("other")),
                F.struct(F.col("b").alias("id"), F.col("a").alias("other")),
            )
        )
        pointers = (
            edges.select(ends.alias("end")).groupBy("end.id").agg(F.min("end.other").alias("near"))
        )
        tree = pointers.select("id", F.least("id", "near").alias("root"))
        tree, _ = stored(tree, f"{folder}/pointers{turn}", n=F.count(F.lit(1)))
        for step in itertools.count():
            above = tree.select(F.col("id").alias("root"), F.col("root").alias("far"))
            further = tree.join(above, "root").select(
                "id", F.col("far").alias("root"), F.col("root").alias("last")
            )
            moved = F.count_if(F.col("root") != F.col("last"))
            tree, seen = stored(further, f"{folder}/pointers{turn}_{step}", moved=moved)
            tree = tree.select("id", "root")
            if not seen["moved"]:
                break
        if roots is None:
            roots = tree
        else:
            higher = tree.select(F.col("id").alias("root"), F.col("root").alias("higher"))
            joined = roots.join(higher, "root", "left")
            roots = joined.select("id", F.coalesce("higher", "root").alias("root"))
        one = edges.join(tree.select(F.col("id").alias("a"), F.col("root").alias("root_a")), "a")
        both = one.join(tree.select(F.col("id").alias("b"), F.col("root").alias("root_b")), "b")
        between = both.where("root_a <> root_b").select(
            F.greatest("root_a", "root_b").alias("a"), F.least("root_a", "root_b").alias("b")
        )
        edges, seen = stored(between.distinct(), f"{folder}/edges{turn}", n=F.count(F.lit(1)))
        if not seen["n"]:
            return roots


def members(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """``groups`` with ``blob``, the text's hash, and ``root``, which is another one for each group.

    Groups may be named alike, if ids are missing or repeated. Null texts have neither.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "near_dup")
    rows = docs.select(
        F.col(key).alias("doc_id"), F.sha2(F.col(text), 256).alias("blob"), F.col(text).alias("text")
    )
    once = (
        rows.where(F.col("blob").isNotNull())
        .groupBy("blob")
        .agg(F.min("doc_id").alias("low"), F.first("text").alias("text"))
    )
    sketches(once).withColumn("id", F.monotonically_increasing_id()).write.parquet(f"{folder}/texts")
    texts = spark.read.parquet(f"{folder}/texts")
    candidates(texts.select("id", "words", "keys"), least).write.parquet(f"{folder}/pairs")
    pairs = spark.read.parquet(f"{folder}/pairs")
    links = led = verify(pairs, texts, least, f"{folder}/by_leader")
    roots = components(led, f"{folder}/led")
    more = rest(texts, roots, pairs, least, folder)
    more, seen = stored(more, f"{folder}/more_pairs", n=F.count(F.lit(1)))
    dropped(spark, folder, "pairs", "open", "crowded", "firsts", "cells")
    if seen["n"]:
        links = led.unionByName(verify(more, texts, least, f"{folder}/by_bucket"))
        roots = components(links, f"{folder}/components")

    ends = links.select(F.explode(F.array("a", "b")).alias("id"))
    degree = ends.groupBy("id").agg(F.count(F.lit(1)).alias("n_links"))
    linked = roots.join(degree, "id").join(texts.select("id", "blob", "low"), "id")
    lowest = linked.groupBy("root").agg(F.min("low").alias("class_id"))
    of_blob = linked.join(lowest, "root").select("blob", "root", "class_id", "n_links")
    alone = texts.select("blob", "low", "id")
    # Stored, so that the join below shuffles both sides itself and can split a text with many copies.
    alone.join(of_blob, "blob", "left").select(
        "blob",
        F.coalesce("root", "id").alias("root"),
        F.coalesce("class_id", "low").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    ).write.parquet(f"{folder}/named")
    named = spark.read.parquet(f"{folder}/named")
    dropped(spark, folder, "texts", "more_pairs", "by_leader", "by_bucket", "led", "components")
    return rows.select("doc_id", "blob").join(named, "blob", "left").select(
        "doc_id",
        "blob",
        "root",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """(doc_id, class_id, n_links): every row's group, and in how many verified pairs its text is.

    Texts that other links have already brought into one group are not compared, so ``n_links`` counts
    the links that made the groups and not all similar texts.
    """
    return members(docs, key, text, least).select("doc_id", "class_id", "n_links")
