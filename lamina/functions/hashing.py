"""Record fingerprints and portable hash-based random values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_hash(*columns: str) -> Column:
    """SHA-256 of the columns' texts joined by '|'; nulls are skipped."""
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]), 256)


def unit(name: str, seed: int, row_id: str = "id") -> Column:
    """A value in [0, 1) fixed by the row id, the column's name and the seed.

    Unlike ``rand`` it does not depend on how the rows are partitioned, and any SQL engine with MD5
    gives the same.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:{name}:"), F.col(row_id).cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
