"""Secret scans over every version of every file, kept in a ledger of blobs.

A version's text is addressed by its SHA-256. The ledger is one table of rows (blob, rule_version,
spans): what was found in a blob by a rule set, also when nothing was. ``scan`` reads texts only for the
blobs that the ledger lacks under the rules' version, adds them, and joins findings back to all paths.

Null texts count as empty. Equal texts share a blob, however many paths have them: their rows meet in a
partial aggregation before any shuffle, and findings come back by a join that adaptive execution splits
where one blob has many paths. Repeated rows each get their findings. An empty table adds nothing.
A run writes its part of the ledger in one commit, so a run that is lost halfway has added nothing.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm.text import or_empty, spare

SPAN = "struct<kind:string,start:long,end:long>"


@dataclass(frozen=True)
class SecretRule:
    """``pattern``: Java regular expression, no empty matches. ``hint``: a cheaper one that finds no less.

    With ``group`` only matches whose group is at least ``least`` characters long count.
    """

    kind: str
    pattern: str
    hint: str | None = None
    group: int | None = None
    least: int = 0


#: The contract's three kinds, in its order. The lengths of the last two are written
#: into the pattern, which finds the same matches, as a run that is too short holds no longer one.
BASE_RULES = (
    SecretRule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        hint=r"(?i:passw|secret|token|api_?key)",
        group=2,
        least=6,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]{16,}"),
    SecretRule("hex", r"[0-9a-f]{24,}"),
)
RULES = (
    *BASE_RULES,
    SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


def rule_version(rules: tuple[SecretRule, ...]) -> str:
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def spans_of(text: Column, rule: SecretRule) -> Column:
    """Where the rule matches, left to right: code points, end exclusive.

    A text is its matches and what stands between them, so the lengths of both give the places.
    """
    between = F.split(text, rule.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    counted = matches if rule.group is None else F.regexp_extract_all(
        text, F.lit(rule.pattern), F.lit(rule.group)
    )
    steps = F.zip_with(
        F.arrays_zip(
            F.transform(between, F.length).alias("skip"), F.transform(matches, F.length).alias("take")
        ),
        F.transform(counted, F.length),
        lambda a, c: F.struct(a["skip"].alias("skip"), a["take"].alias("take"), c.alias("counted")),
    )
    walked = F.aggregate(
        steps,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")),
        lambda a, x: F.struct(
            (a["at"] + x["skip"] + F.coalesce(x["take"], F.lit(0))).alias("at"),
            F.when(
                x["counted"] >= rule.least,
                F.concat(
                    a["out"],
                    F.array(
                        F.struct(
                            F.lit(rule.kind).alias("kind"),
                            (a["at"] + x["skip"]).alias("start"),
                            (a["at"] + x["skip"] + x["take"]).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(a["out"])
            .alias("out"),
        ),
        lambda a: a["out"],
    )
    seen = text.rlike(rule.hint or rule.pattern)
    return F.when(seen, walked).otherwise(F.array().cast(f"array<{SPAN}>"))


def find_spans(text: Column, rules: tuple[SecretRule, ...]) -> Column:
    """All rules' spans by start, then in the rules' order."""
    rank = {r.kind: i for i, r in enumerate(rules)}
    every = F.concat(*[spans_of(text, r) for r in rules])
    order = F.create_map(*[x for k, i in rank.items() for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(
        every, lambda s: F.struct(s["start"].alias("a"), order[s["kind"]].alias("b"), s.alias("s"))
    )
    return F.when(F.size(every) > 0, F.transform(F.sort_array(keyed), lambda x: x["s"])).otherwise(
        F.array().cast(f"array<{SPAN}>")
    )


class BlobLedger:
    """The ledger's table in ``folder``; each run adds a folder of its own."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return fs.exists(path)

    def read(self) -> DataFrame:
        if not self._exists():
            return self.spark.createDataFrame(
                [], f"blob string, rule_version string, spans array<{SPAN}>, run string"
            )
        return self.spark.read.option("basePath", self.folder).parquet(f"{self.folder}/run=*")

    def add_unseen(self, texts: DataFrame, rules: tuple[SecretRule, ...]) -> None:
        """Scans what ``texts`` (blob, text) has and the ledger lacks under these rules."""
        version = rule_version(rules)
        once = texts.groupBy("blob").agg(F.first("text").alias("text"))
        if self._exists():
            seen = self.read().where(F.col("rule_version") == version).select("blob")
            once = once.join(seen, "blob", "left_anti")
        once.select(
            "blob",
            F.lit(version).alias("rule_version"),
            find_spans(F.col("text"), rules).alias("spans"),
        ).write.parquet(f"{self.folder}/run={uuid.uuid4().hex}")

    def findings(self, rules: tuple[SecretRule, ...]) -> DataFrame:
        """(blob, spans), one row for each blob with spans."""
        held = self.read().where((F.col("rule_version") == rule_version(rules)) & (F.size("spans") > 0))
        return held.dropDuplicates(["blob"]).select("blob", "spans")


def scan(
    history: DataFrame,
    folder: str,
    rules: tuple[SecretRule, ...] = RULES,
    text: str = "text",
    into: str = "spans",
    keep_text: bool = False,
) -> DataFrame:
    """Every row of ``history`` with its spans, after the ledger in ``folder`` took in unseen blobs.

    ``history`` has a row for each version of each path and any other columns. The text goes along with
    the join only if it is kept. A column called ``into`` is replaced.
    """
    spark = history.sparkSession
    ledger = BlobLedger(spark, folder)
    blob = spare(history, "blob")
    address = F.sha2(or_empty(F.col(text)), 256)
    ledger.add_unseen(
        history.select(address.alias("blob"), or_empty(F.col(text)).alias("text")), rules
    )
    held = spare(history, "found")
    found = ledger.findings(rules).select(F.col("blob").alias(blob), F.col("spans").alias(held))
    paths = history.withColumn(blob, address)
    return (
        (paths if keep_text else paths.drop(text))
        .join(found, blob, "left")
        .withColumn(into, F.coalesce(held, F.array().cast(f"array<{SPAN}>")))
        .drop(held, blob)
    )


def joined_spans(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each stretch of spans, overlapping ones as one, replaced by ``mark``.

    ``spans`` are sorted by start. Null texts stay null, texts without spans stay as they are.
    """
    merged = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda a, s: F.when(
            s["start"] < a["at"],
            F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at")),
        ).otherwise(
            F.struct(
                F.concat(
                    a["out"],
                    F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                    F.lit(mark),
                ).alias("out"),
                s["end"].alias("at"),
            )
        ),
        lambda a: F.concat(
            a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))
        ),
    )
    return F.when(F.size(spans) > 0, merged).otherwise(text)


def redacted(
    history: DataFrame, folder: str, rules: tuple[SecretRule, ...] = RULES, text: str = "text"
) -> DataFrame:
    """``history`` with ``mark`` for its secrets; the same columns in the same order."""
    spans = spare(history, "spans")
    found = scan(history, folder, rules, text, spans, keep_text=True)
    return found.withColumn(text, redact(F.col(text), F.col(spans))).select(*history.columns)
