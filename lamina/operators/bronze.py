"""Bronze: the change feed with its metadata under plain names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.columns import col, quoted


def enrich_changes(
    feed: DataFrame,
    source_file: str,
    casts: dict[str, str] | None = None,
    stamp: bool = True,
) -> DataFrame:
    """Add the source's name and, with ``stamp``, the time; rename the feed's three columns.

    ``casts`` changes column types in place. Works on a batch and on a stream.
    """
    added = {"source_file": F.lit(source_file)}
    if stamp:
        added["ingestion_timestamp"] = F.current_timestamp()
    casted = {c: F.col(c).cast(kind) for c, kind in (casts or {}).items()}
    return feed.withColumns({**casted, **added}).withColumnsRenamed(
        {
            "_change_type": "operation_type",
            "_commit_version": "commit_version",
            "_commit_timestamp": "commit_timestamp",
        }
    )


ENRICH_SQL = """
SELECT
  * EXCEPT (_change_type, _commit_version, _commit_timestamp{moved}),
{casts}  current_timestamp() AS ingestion_timestamp,
  :source_file AS source_file,
  _change_type AS operation_type,
  _commit_version AS commit_version,
  _commit_timestamp AS commit_timestamp
FROM {feed}
"""


def enrich_changes_sql(
    feed: DataFrame, source_file: str, casts: dict[str, str] | None = None
) -> DataFrame:
    """``enrich_changes`` in SQL, on a batch or a stream. Columns with a cast go behind the others."""
    names = {quoted(c): kind for c, kind in (casts or {}).items()}
    text = ENRICH_SQL.replace("{moved}", "".join(f", {c}" for c in names)).replace(
        "{casts}", "".join(f"  CAST({c} AS {kind}) AS {c},\n" for c, kind in names.items())
    )
    return feed.sparkSession.sql(text, args={"source_file": source_file}, feed=feed)


def add_bucket(df: DataFrame, keys: Sequence[str], buckets: int, name: str = "b") -> DataFrame:
    """A storage bucket that depends on the keys alone."""
    bucket = F.pmod(F.xxhash64(*[col(k) for k in keys]), F.lit(buckets))
    return df.withColumn(name, bucket.cast("int"))
