"""The registered queries of these operators: contracts over the test tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import (
    bpe,
    chat,
    hamming,
    interaction,
    lines,
    minhash,
    mixing,
    quality,
    secrets,
    sharding,
    simhash,
    trie,
    urls,
)
from wayfare.llm.common import words
from wayfare.session import scratch_path, written
from wayfare.sources.files import parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SHARDS, SHARD_SEED, MIX_SEED = 24, 20, "mix-1"


def query(function: Query) -> Query:
    @functools.wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return parquet(spark, f"{folder}/{name}.parquet")


def hex_digest(content: Column) -> Column:
    return F.sha2(content, 256)


@query
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents dealt to 24 shuffled shards; counts are at most one apart."""
    content = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 8).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
    )
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_crc32"), F.col("size")]
    placed = sharding.with_shards(rows, order, SHARDS, SHARD_SEED)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole document encoded, and decoded from its ids again."""
    ranks = bpe.Ranks.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        hex_digest(bpe.little_endian(F.col("ids"), len(ranks.pieces))).alias("ids_sha256"),
        hex_digest(bpe.decode(F.col("ids"), ranks)).alias("decoded_sha256"),
    )


@query
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every whole document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.withColumn("fingerprint", simhash.as_hex(F.col("fingerprint")))


@query
def op4_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Every page judged by the rules, else by its host's reputation.

    The labels that reputations are learned from come from the pages themselves: a page
    is bad if its visible text breaks the threshold table of the quality rules or if
    its host names an unwanted trade.
    """
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    judged = urls.judge(pages.drop("html"), urls.page_outcomes(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op5_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """All secrets of every whole document, from a ledger that starts empty."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ledger = secrets.Ledger(scratch_path(spark, "secret-ledger"))
    ledger.scan(docs)
    found = ledger.findings(docs)
    kinds = [rule.kind for rule in secrets.BASE_RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *[secrets.count_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in kinds],
        hex_digest(secrets.joined(base)).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines kept and dropped in every document, and a digest of what is left."""
    found = lines.dedup(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_lines", "n_exact", "n_near", hex_digest(F.col("kept_text")).alias("kept_sha256")
    )


@query
def op7_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one with control strings, read back from the output."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    spoken = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-7, 0, "user", spoken), (-7, 1, "assistant", spoken)], turns.schema
    )
    turns = turns.unionByName(planted).withColumn("parts", chat.typed(F.col("text")))
    read = chat.format_chats(turns).withColumns(
        {
            "read": F.array_join(
                F.transform(
                    chat.read_turns(F.col("formatted")),
                    lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")),
                ),
                "",
            ),
            "learned": chat.read_loss(F.col("segments")),
        }
    )
    return read.select(
        "conv_id",
        "n_turns",
        hex_digest(F.col("read")).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        hex_digest(F.col("learned")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of each whole document and the verdict of the threshold table."""
    judged = quality.judge(table(spark, folder, "documents").select("doc_id", "text"))
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    return judged.select("doc_id", *[F.col(f"quality.{name}").alias(name) for name in names])


def sized(docs: DataFrame) -> DataFrame:
    """What the mix needs of a document: its words, its chance, its weight.

    Documents of fewer than 50 words are drawn at half the odds.
    """
    size = F.size(words(F.col("text"))).cast("long")
    return docs.withColumns(
        {"size": size, "chance": mixing.draw(MIX_SEED, F.col("doc_id"), F.col("text"))}
    ).withColumn("weight", F.when(F.col("size") < 50, 0.5).otherwise(1.0))


@query
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to the sources' targets by whole and drawn copies."""
    docs = sized(table(spark, folder, "documents").select("doc_id", "text", "source")).drop("text")
    docs = written(docs, "mix-docs")
    columns = ("source", "size", "chance", "weight")
    mixed = mixing.apply_mix(docs, mixing.plan_mix(docs, *columns), *columns)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op10_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest sign codes for every vector whose id is divisible by 50."""
    vectors = table(spark, folder, "embeddings").select(
        "vec_id", hamming.sign_code(F.col("embedding"), 64).alias("code")
    )
    return hamming.search(vectors, vectors.where("vec_id % 50 = 0"), "vec_id", "code", 10)


@query
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Five filters over all documents, in all 120 orders, by source."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return interaction.audit(docs, table(spark, folder, "labels"))


@query
def op12_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Components of whole documents with 85 % of their three-word shingles in common."""
    return minhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of all conversations, each begun like the first of its hundred."""
    own = trie.sequences(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))
    nodes = trie.prefix_trie(trie.branched(written(own, "own-turns")))
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
