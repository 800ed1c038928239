import base64
import hashlib
import struct

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wayfare.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.Ranks.read(PATH)


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as file:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


TEXTS = [
    None,
    "",
    " ",
    "a",
    "Hello world, it's  fine.\n\n\t x  ",
    "Été façonné übermäßig   niño 漢字かな العربية 😀👩‍👩‍👧 \U0001f600",
    "<|endoftext|> is text here",
    "a" * 700,
    "ab" * 300 + "=" * 1000 + " " * 600 + "x",
    "\u0000\u001f­﻿",
    "Donaudampfschifffahrtselektrizitätenhauptbetriebswerkbauunterbeamtengesellschaft",
    "word and word and other 12345 67890 " * 4000,
]


@pytest.mark.parametrize("block,long,known", [(50, 20, 0), (50, 512, 9), (4_000_000, 100_000, 1000)])
def test_against_the_tokenizer(spark, ranks, reference, block, long, known):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(4, TEXTS[4]), (None, "null key")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("words", F.lit("extra"))
    coded = bpe.encode(
        docs.coalesce(1),
        ranks,
        public_tokenizers.PATTERN,
        keep=("doc_id", "words"),
        block_chars=block,
        long_word=long,
        most_known=known,
    )
    got = coded.select("doc_id", "words", "ids", bpe.decode(F.col("ids"), ranks)).collect()
    want = sorted(((k, reference.encode_ordinary(t or ""), (t or "").encode()) for k, t in rows), key=repr)
    assert sorted(((r[0], r[2], bytes(r[3])) for r in got), key=repr) == want
    assert {r[1] for r in got} == {"extra"}


# Letters of contractions, apostrophes, all kinds of space, numbers, marks, signs.
CHARACTERS = st.one_of(
    st.sampled_from("''stmdrevlSTaé漢ſ 　\t\n\x0b\x1c\x85\xa0\u2028\ufeff0٣²Ⅷ!_-\u0301😀\x00"),
    st.characters(exclude_categories=["Cs"]),
)


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.text(CHARACTERS, max_size=30), min_size=1, max_size=4))
def test_words_of_classes_are_those_of_the_pattern(texts):
    want, counts = bpe.pattern_words(regex.compile(bpe.CLASS_PATTERN), texts)
    got, own = bpe.class_words(texts)
    assert got.to_pylist() == want.to_pylist()
    assert own.tolist() == counts.tolist()


def test_classes_are_those_of_the_vocabulary_and_cover_all_code_points():
    assert bpe.CLASS_PATTERN == public_tokenizers.PATTERN
    find = regex.compile(bpe.CLASS_PATTERN)
    points = [chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000]
    for around in ("a{}a", "1{}1", " {} ", "'{}s", "!{}"):
        texts = [around.format(c) for c in points[::7]]
        want, _ = bpe.pattern_words(find, texts)
        assert bpe.class_words(texts)[0].equals(want)


def test_other_patterns_are_scanned(spark, ranks):
    docs = spark.createDataFrame([(1, "ab cd"), (2, None)], "doc_id int, text string")
    whole = tiktoken.Encoding("w", pat_str=r"(?s).+", mergeable_ranks=ranks.rank, special_tokens={})
    got = {r.doc_id: r.ids for r in bpe.encode(docs, ranks, r"(?s).+").collect()}
    assert got == {1: whole.encode_ordinary("ab cd"), 2: []}


def test_heap_against_the_tokenizer(ranks):
    whole = tiktoken.Encoding("w", pat_str=r"(?s).+", mergeable_ranks=ranks.rank, special_tokens={})
    for text in TEXTS:
        for word in set((text or "").split()):
            ids = ranks.byte_ids[list(word.encode())].tolist()
            if len(word) < 3000:
                assert bpe.merged_by_heap(ids, ranks.merges) == whole.encode_ordinary(word)


def test_rank_map_has_each_pair_and_no_other(spark, ranks):
    found = bpe.RankMap(ranks.merges, len(ranks.pieces))
    some = list(ranks.merges.items())[::97]
    rows = [(a, b, rank) for (a, b), rank in some]
    rows += [(b, a, ranks.merges.get((b, a))) for (a, b), _ in some]
    rows += [(a, None, None) for (a, _), _ in some[:9]]
    table = spark.createDataFrame(rows, "a int, b int, rank int")
    looked = found.bound(lambda arrays: bpe.rank_of(arrays, F.col("a"), F.col("b")))
    assert table.where(~looked.eqNullSafe(F.col("rank"))).count() == 0


def test_query_against_the_tokenizer(spark, reference):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.QUERIES["op2_byte_bpe"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc in docs:
        ids = reference.encode_ordinary(doc.text or "")
        row = got[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((doc.text or "").encode()).hexdigest()


def test_no_shuffle_and_empty(spark, ranks, plan):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    assert coded.collect() == []
    assert "Exchange" not in plan(bpe.encode(spark.range(5).selectExpr("id AS doc_id", "'t' AS text"), ranks, public_tokenizers.PATTERN))


def test_known_words_are_bounded_and_repeat(spark):
    docs = spark.createDataFrame([("a b c",), ("a b d",), ("a e f",)], "text string").coalesce(1)
    for most, want in ((10, {"a", " b"}), (1, {"a"}), (0, set())):
        found = bpe.repeated_words(docs, "text", public_tokenizers.PATTERN, 1, 512, most)
        assert {r.word for r in found.collect()} == want


def test_refuses_gaps(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError, match="gap"):
        bpe.Ranks.read(str(path))


def test_plan_does_not_hold_the_map_of_pairs(spark, ranks, plan):
    docs = spark.range(5).selectExpr("id AS doc_id", "'t' AS text")
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    assert len(plan(coded)) < 100_000
    assert len(coded._jdf.queryExecution().toString()) < 400_000
