"""Secret scanning with a ledger of what has been scanned already."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import let

LEDGER = "blob binary, rules array<string>, spans array<struct<rule:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern`` whose ``group`` has ``least`` characters or more.

    ``version`` changes whenever the rule does, so that every blob is due again.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.version}"


# The first three are fixed by the contract. Java's (?i) is for ASCII letters only.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    # A run that is too short cannot hold a long one, so the length is in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
RULES = (
    *BASE_RULES,
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def blob_id(text: Column) -> Column:
    """The address of a content: its SHA-256; null is the empty content."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def found_spans(text: Column, rule: Rule) -> Column:
    """The spans of one rule in a text, in code points, end exclusive.

    The matches and the gaps between them alternate, so adding up their lengths gives
    the places.
    """
    empty = F.array().cast("array<struct<rule:string,start:bigint,end:bigint>>")
    pattern = F.lit(rule.pattern)

    def spans(hits: Column) -> Column:
        gaps = F.transform(F.split(text, rule.pattern), lambda g: F.length(g))
        measured = F.transform(
            hits if not rule.group else F.regexp_extract_all(text, pattern, F.lit(rule.group)),
            lambda h: F.length(h),
        )

        def placed(gap: Column, size: Column) -> Column:
            start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))

            def step(state: Column, k: Column) -> Column:
                begin = state["at"] + F.get(gap, k)
                end = begin + F.length(F.get(hits, k))
                span = F.struct(F.lit(rule.name).alias("rule"), begin.alias("start"), end.alias("end"))
                longer = F.when(F.get(size, k) >= rule.least, F.array_append(state["spans"], span))
                return F.struct(end.alias("at"), longer.otherwise(state["spans"]).alias("spans"))

            return F.aggregate(F.sequence(F.lit(0), F.size(hits) - 1), start, step, lambda s: s["spans"])

        return let(gaps, lambda gap: let(measured, lambda size: placed(gap, size)))

    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    return let(hits, lambda h: F.when(F.size(h) == 0, empty).otherwise(spans(h)))


class Ledger:
    """The findings of every content ever scanned, by content and rule version.

    A folder of Parquet files to which each scan adds one set: for each blob
    the rules it was scanned for and the spans that they found. Adding is one
    commit, so a scan that fails leaves nothing.
    """

    def __init__(self, path: str):
        self.path = path

    def rows(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.schema(LEDGER).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], LEDGER)

    def scan(self, docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> None:
        """Scan the contents of ``docs`` for the rules they have not been scanned for.

        Equal texts are one content, also across paths and versions of a file.
        Contents known for all rules are left out first; of the others one copy
        each meets its row in the ledger and is searched for the missing rules.
        """
        spark = docs.sparkSession
        names = [rule.name for rule in rules]
        content = F.coalesce(F.col(text), F.lit(""))
        contents = docs.select(blob_id(F.col(text)).alias("blob"), content.alias("content"))
        known = self.rows(spark).groupBy("blob").agg(
            F.array_distinct(F.flatten(F.collect_list("rules"))).alias("known")
        )
        if known.isEmpty():
            due = contents.dropDuplicates(["blob"]).withColumn("known", F.array().cast("array<string>"))
        else:
            complete = known.where(F.size(F.array_except(F.lit(names), "known")) == 0).select("blob")
            due = contents.join(complete, "blob", "left_anti").dropDuplicates(["blob"])
            due = due.join(known, "blob", "left")
        due = due.withColumn("known", F.coalesce("known", F.array().cast("array<string>")))
        empty = F.array().cast("array<struct<rule:string,start:bigint,end:bigint>>")
        spans = [
            F.when(F.array_contains("known", rule.name), empty).otherwise(found_spans(F.col("content"), rule))
            for rule in rules
        ]
        due.select(
            "blob", F.array_except(F.lit(names), "known").alias("rules"), F.concat(*spans).alias("spans")
        ).write.mode("append").parquet(self.path)

    def findings(self, docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, into: str = "spans") -> DataFrame:
        """Each row of ``docs`` with ``into``: the spans of its content for these rules.

        Spans have kind, start and end, and are sorted by start, then in the order of
        the rules. A content without findings has an empty array, one never
        scanned too. A column named ``into`` is replaced.
        """
        names = [rule.name for rule in rules]
        by_blob = (
            self.rows(docs.sparkSession)
            .where(F.size("spans") > 0)
            .groupBy(F.col("blob").alias("ledger__blob"))
            .agg(F.flatten(F.collect_list("spans")).alias("ledger__spans"))
        )

        def ordered(spans: Column) -> Column:
            mine = F.filter(spans, lambda s: s["rule"].isin(*names))
            keyed = F.transform(
                mine,
                lambda s: F.struct(
                    s["start"].alias("start"),
                    F.array_position(F.lit(names), s["rule"]).alias("nth"),
                    s["end"].alias("end"),
                    F.substring_index(s["rule"], ":", 1).alias("kind"),
                ),
            )
            return F.transform(
                F.sort_array(F.array_distinct(keyed)),
                lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
            )

        none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
        known = docs.withColumn("ledger__id", blob_id(F.col(text)))
        return (
            known.join(by_blob, F.col("ledger__id") == F.col("ledger__blob"), "left")
            .withColumn(into, F.coalesce(ordered(F.col("ledger__spans")), none))
            .drop("ledger__id", "ledger__blob", "ledger__spans")
        )


def joined(spans: Column) -> Column:
    """Spans as text: ``kind:start:end``, comma between."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each span replaced by a mark; overlapping spans as one."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.substr(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        out = F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    return F.aggregate(
        spans, start, step, lambda s: F.concat(s["out"], F.substr(text, (s["at"] + 1).cast("int")))
    )
