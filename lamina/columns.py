"""Column names of any kind, and names that meet none of a table's own."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """The name as SQL text, with blanks, dots and quotes in it taken literally."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def free_name(name: str, *tables: DataFrame) -> str:
    """``name``, lengthened until no column of ``tables`` has it."""
    taken = {c.lower() for table in tables for c in table.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def none_null(names: Sequence[str]) -> Column:
    return reduce(and_, [col(n).isNotNull() for n in names])
