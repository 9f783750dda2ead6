"""Expressions and small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What parts the words of the quality, mixing and language-model contracts.
BLANKS = r"[\x20\x09-\x0D]+"
#: What parts the words of the contamination contract, after A-Z were lowered.
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, all other letters left as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def pieces(text: Column, parting: str) -> Column:
    """What stands between the matches of ``parting``, without empty pieces; null has none."""
    return F.array_remove(F.split(or_empty(text), parting), "")


def blank_words(text: Column) -> Column:
    return pieces(text, BLANKS)


def crc(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def remainder(doc_id: Column, divisor: int) -> Column:
    return crc(doc_id) % divisor


def spare(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_``, ``name__`` and so on that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small(df: DataFrame, rows: int) -> bool:
    """Whether a stored table has at most ``rows`` rows."""
    return df.limit(rows + 1).count() <= rows
