"""Token counts of a unigram tokenizer, without tokens: Aho-Corasick and a Viterbi pass that counts.

The tokenizer: blanks become ``▁``, one is put in front unless the text starts with one, and the text is
cut before each. Inside a cut the best path over the vocabulary's pieces wins. A character that is no
piece itself costs the least score less ``UNKNOWN``, and counts as its UTF-8 bytes if the vocabulary has
pieces for all bytes, else a run of them counts as one. Of paths that are equally good, the one whose
last piece is longest wins at every place.

The automaton gives the pieces that end at each place, longest first; the pass carries the best score and
the number of pieces up to there. Cuts are counted once and kept, at most ``CACHE`` at a time.

Null and empty texts have no tokens. Repeated rows get equal counts. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.arrow import Rows, map_slices

BLANK = "▁"
UNKNOWN = 10.0
CACHE = 400_000
#: Where the public tokenizers lie; only the driver reads the file.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def vocabulary(path: str = MODEL) -> list[tuple[str, float]]:
    """The file's pieces, scored by Zipf's law: piece r of V has log(1 / ((r + 1) H_V)).

    The file ranks its pieces and has no probabilities, so their ranks stand for them.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    harmonic = math.log(math.fsum(1 / (r + 1) for r in range(size)))
    return [(model.id_to_piece(r), -math.log(r + 1) - harmonic) for r in range(size)]


class Counter:
    """Counts cuts; ``pieces`` is the whole vocabulary with scores."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.bytes = all(f"<0x{b:02X}>" in self.automaton for b in range(256))
        self.unknown = min(s for _, s in pieces) - UNKNOWN

    def count(self, cut: str) -> tuple[int, float]:
        """(pieces, score) of the best path through one cut."""
        n = len(cut)
        best, pieces, run = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        at, found = 0, []

        def close(end: int) -> None:
            """The best way to ``end``, from the pieces that end there."""
            top = None
            single = False
            for length, score in found:
                start = end - length
                total = score + best[start]
                if top is None or total > top:
                    top, pieces[end], run[end] = total, pieces[start] + 1, False
                single = single or length == 1
            if not single:
                total = self.unknown + best[end - 1]
                if top is None or total > top:
                    top = total
                    if self.bytes:
                        pieces[end] = pieces[end - 1] + len(cut[end - 1].encode())
                    else:
                        pieces[end] = pieces[end - 1] + (not run[end - 1])
                    run[end] = True
            best[end] = top

        for last, piece in self.automaton.iter(cut):
            while at < last:
                at += 1
                close(at)
                found.clear()
            found.append(piece)
        while at < n:
            at += 1
            close(at)
            found.clear()
        return pieces[n], best[n]


def cuts(text: str | None) -> list[str]:
    """What follows each ``▁`` of the rendered text."""
    if not text:
        return []
    parts = text.replace(BLANK, " ").split(" ")
    return parts[1:] if not parts[0] else parts


def token_counts(
    docs: DataFrame,
    pieces: list[tuple[str, float]] | None = None,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` of every row, n_tokens and log_prob, the score of its best path."""
    held = docs.sparkSession.sparkContext.broadcast(pieces or vocabulary())
    source = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def make():
        counter = Counter(held.value)
        rows = Rows(lambda cut: counter.count(BLANK + cut), CACHE, np.float64, (2,))

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            rows.trim()
            ids = [rows.numbers(cuts(t)) for t in part.column("__text").to_pylist()]
            table = rows.table()
            sums = np.array([table[i].sum(axis=0) for i in ids]).reshape(-1, 2)
            columns = [part.column(i) for i in range(len(keep))]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(sums[:, 0].astype(np.int64)), pa.array(sums[:, 1])],
                names=[*keep, "n_tokens", "log_prob"],
            )

        return work

    return map_slices(source, make, f"{schema}, n_tokens long, log_prob double", "__text")
