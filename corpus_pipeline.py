"""From raw documents to token ids: each stage works on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import bpe, lines, mixing, quality, simhash
from wayfare.llm.queries import hex_digest, sized, table
from wayfare.session import scratch, scratch_path, written

#: The columns that all stages but the last return.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Words in a shingle and differing bits of linked fingerprints, as `op3_simhash` has them.
SHINGLE, RADIUS = 3, 3


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the threshold table."""
    return quality.judge(docs.select(*COLUMNS)).where("quality.kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one has, or has but for a word.

    A document of which no line with words is left goes.
    """
    found = lines.dedup(docs.select(*COLUMNS))
    left = found.where("n_lines > n_exact + n_near")
    return left.withColumns(
        {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    ).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the least id.

    Near are fingerprints of three-word shingles that differ in at most three bits.
    Null ids are last; of documents with one id the least hash of the text comes
    first, and rows that repeat both are one document.
    """
    said = F.xxhash64(F.coalesce("text", F.lit("")))
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", said.alias("said"))
    own = docs.select(key.alias("key"), "text")
    groups = simhash.near_duplicates(own, key="key", width=SHINGLE, radius=RADIUS)
    first = groups.where("key = component_id").select("key").distinct()
    kept = docs.withColumn("key", key).join(first, "key", "left_semi")
    return kept.dropDuplicates(["key"]).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    columns = ("source", "size", "chance", "weight")
    docs = sized(docs.select(*COLUMNS))
    cuts = mixing.plan_mix(written(docs.select(*columns), "mix-docs"), *columns)
    mixed = mixing.apply_mix(docs, cuts, *columns).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*COLUMNS)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, and the digest of what they decode to."""
    ranks = bpe.Ranks.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    keep = ("doc_id", "lang", "source", "n_chars")
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=keep)
    return coded.withColumns(
        {
            "n_tokens": F.size("ids").cast("long"),
            "decoded_sha256": hex_digest(bpe.decode(F.col("ids"), ranks)),
        }
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

# Fingerprints and byte-pair merges are beyond SQL: tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again.

    What a stage wrote on its way is deleted once its result is stored.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with scratch(spark):
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
