import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.llm import queries, sharding


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 65, 1000, 4097])
def test_permutation_and_its_inverse(size):
    p = sharding.Permutation(size, seed=size)
    where = p.position(np.arange(size))
    assert sorted(where) == list(range(size))
    assert (p.number(where) == np.arange(size)).all()


def test_large_numbers_and_seeds():
    p = sharding.Permutation(3 * 10**12, seed=1)
    some = np.array([0, 1, 2, 10**12, 3 * 10**12 - 1])
    there = p.position(some)
    assert (p.number(there) == some).all() and there.max() < 3 * 10**12
    assert (there != sharding.Permutation(3 * 10**12, seed=2).position(some)).any()
    with pytest.raises(ValueError, match="outside"):
        p.position([3 * 10**12])


def test_positions_look_shuffled():
    where = sharding.Permutation(100_000, seed=3).position(np.arange(100_000))
    for shards in (2, 3, 24):
        counts = np.bincount(where[:50_000] % shards, minlength=shards)
        assert abs(counts - 50_000 / shards).max() < 500
    assert abs(np.corrcoef(np.arange(100_000), where)[0, 1]) < 0.02


def placed(spark, rows, shards):
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    table = table.withColumns({"shard": F.lit("old"), "extra": F.lit(1)}).repartition(5)
    order = [F.col("doc_id").asc_nulls_last(), F.col("text")]
    return sharding.with_shards(table, order, shards, 9)


def test_shards_of_awkward_rows(spark):
    rows = [(k, f"t{k}") for k in range(40)] + [(None, None)] * 30 + [(3, "t3")] * 30 + [(5, "")]
    out = placed(spark, rows, 7).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=repr) == sorted(rows, key=repr)
    by_shard = {}
    for r in out:
        by_shard.setdefault(r.shard, []).append(r.slot)
        assert r.extra == 1
    assert set(by_shard) == set(range(7))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    sizes = [len(s) for s in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1
    # The same rows go to the same places whatever the partitions.
    again = placed(spark, rows[::-1], 7).collect()
    assert sorted((tuple(r) for r in out), key=repr) == sorted((tuple(r) for r in again), key=repr)
    # A place is computed from the row's number alone.
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    spot = sharding.Permutation(len(rows), 9).position(range(len(rows)))
    wanted = sorted(((*r, int(p) % 7, int(p) // 7) for r, p in zip(ordered, spot)), key=repr)
    assert sorted(((r.doc_id, r.text, r.shard, r.slot) for r in out), key=repr) == wanted


def test_empty(spark):
    assert placed(spark, [], 24).collect() == []


def test_written_shards(spark, folder):
    out = placed(spark, [(k, "x") for k in range(50)], 4)
    sharding.write_shards(out, f"{folder}/shards", 4, rows_per_file=5)
    back = spark.read.parquet(f"{folder}/shards")
    assert back.count() == 50 and back.where("shard = 2").count() in (12, 13)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.QUERIES["op1_sharding"](spark, folder).collect()
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
    spot = sharding.Permutation(len(texts), queries.SHARD_SEED).position(range(len(texts)))
    assert [(r.shard, r.slot) for r in sorted(got, key=lambda r: r.doc_id)] == [
        (int(p) % 24, int(p) // 24) for p in spot
    ]
