"""The pipeline's stages against plain Python, each on its own input."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from test_lines import slow as slow_lines
from test_simhash import slow_components

import corpus_pipeline
from wayfare.llm.quality import judge

FOLDER = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with awkward rows among them."""
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(None, None, None, None, None), (5000, "", "en", "src0", 0), (5001, " \n", None, None, 2)]
    return table.unionByName(spark.createDataFrame(odd, table.schema)).unionByName(table.limit(3))


def rows(df):
    return sorted((tuple(r) for r in df.select(*corpus_pipeline.COLUMNS).collect()), key=repr)


def test_quality(spark, docs):
    kept = STAGE["quality_rules"](spark, docs, FOLDER)
    assert rows(kept) == rows(judge(docs).where("quality.kept"))
    assert 0 < kept.count() < docs.count()


def test_lines(spark, docs):
    docs = docs.where("doc_id < 60").distinct()
    told = {d[0]: d[1] for d in rows(docs)}
    want = {d: kept for d, n, exact, near, kept in slow_lines(list(told.items())) if n > exact + near}
    got = STAGE["line_dedup"](spark, docs, FOLDER).collect()
    assert {r.doc_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_near_duplicates(spark, docs):
    found = docs.collect()
    groups = slow_components([((r.doc_id is None, r.doc_id or 0), r.text) for r in found])
    kept = STAGE["simhash_near_dedup"](spark, docs, FOLDER).collect()
    assert len(kept) == len({g[2] for g in groups})
    assert {(r.doc_id is None, r.doc_id or 0) for r in kept} == {g[2] for g in groups}


def test_mix(spark, docs):
    mixed = STAGE["mix_sources"](spark, docs, FOLDER)
    counts = mixed.groupBy("doc_id").count()
    assert mixed.columns == list(corpus_pipeline.COLUMNS)
    assert counts.where("doc_id < 5000 AND count > 6").count() == 0
    assert mixed.join(docs, "doc_id", "left_anti").count() == 0


def test_whole_run_ends_in_the_tokenizer_s_ids(spark):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
    want = sorted((r.doc_id, own.encode_ordinary(r.text or "")) for r in docs.collect())
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r.doc_id, r.ids) for r in got) == want and want


def test_ids_decode_to_the_text(spark, docs):
    want = sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs.collect())
    got = STAGE["byte_bpe"](spark, docs, FOLDER).collect()
    assert sorted(r.decoded_sha256 for r in got) == want


@pytest.mark.parametrize("name", STAGE)
def test_empty(spark, docs, name):
    assert STAGE[name](spark, docs.limit(0), FOLDER).collect() == []
