import itertools

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wayfare.llm import simhash


def slow_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(space, " ")
    ws = [w for w in lowered.split(" ") if w]
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    """key, text pairs -> component of each row, by comparing all of them."""
    prints = [slow_fingerprint(text) for _, text in rows]
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
            old, new = max(group[i], group[j]), min(group[i], group[j])
            group = [new if g == old else g for g in group]
    out = []
    for (key, _), g, p in zip(rows, group, prints):
        keys = [k for (k, _), h in zip(rows, group) if h == g and k is not None]
        out.append((key, f"{p:016x}", min(keys) if keys else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize(
    "text", [None, "", " \t\n", "One", "ONE two", "a b c d", "É é x y z w " * 9, "w " * 70000]
)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
@pytest.mark.parametrize("block", [7, 1 << 17])
def test_pairs_within_groups(radius, block):
    draw = np.random.default_rng(radius)
    base = draw.integers(0, 2**63, 30, dtype=np.uint64)
    codes = base[draw.integers(0, 30, 700)]
    for _ in range(5):
        codes = codes ^ (np.uint64(draw.integers(0, 2)) << draw.integers(0, 64, 700).astype(np.uint64))
    sizes = [1, 2, 64, 65, 300, 3, 265]
    ends = np.repeat(np.cumsum(sizes), sizes)
    found = {
        (int(i), int(j)) for a, b in simhash.near_pairs(codes, ends, radius, block) for i, j in zip(a, b)
    }
    wanted = {
        (i, j)
        for i in range(700)
        for j in range(i + 1, ends[i])
        if (int(codes[i]) ^ int(codes[j])).bit_count() <= radius
    }
    assert found == wanted and (wanted or not radius)


def test_band_keys_never_miss(spark):
    draw = np.random.default_rng(4)
    rows = []
    for _ in range(400):
        code = int(draw.integers(0, 2**63)) * 2 + 1 - 2**63
        other = code
        for bit in draw.choice(64, 3, replace=False):
            other ^= 1 << int(bit)
        rows.append((code, (other + 2**63) % 2**64 - 2**63))
    keys = [simhash.band_keys(F.col(c), 3) for c in "xy"]
    pairs = spark.createDataFrame(rows, "x bigint, y bigint")
    assert pairs.where(~F.arrays_overlap(*keys)).count() == 0


def test_hot_key_is_cut_and_no_link_is_lost(spark):
    draw = np.random.default_rng(5)
    # One key for all: the upper bits agree, the lower walk by single bits.
    codes, code = set(), 0
    while len(codes) < 1200:
        codes.add(code)
        code ^= 1 << int(draw.integers(0, 24))
    far = 0x0FFFFFFFFFFFFFFF
    table = spark.createDataFrame([(c,) for c in [*codes, far]], "code bigint")
    found = simhash.links(table, "code", 3, tile=100)
    edges = found.collect()
    node = {c: c for c in codes}

    def top(c):
        while node[c] != c:
            c = node[c]
        return c

    for a, b in edges:
        assert (a ^ b).bit_count() <= 64 and a in codes and b in codes
        node[max(top(a), top(b))] = min(top(a), top(b))
    assert len({top(c) for c in codes}) == 1
    assert len(edges) < 60 * len(codes)


def texts():
    draw = np.random.default_rng(6)
    rows = []
    for group in range(12):
        ws = [f"w{draw.integers(0, 400)}" for _ in range(120)]
        for copy in range(5):
            rows.append((len(rows), " ".join(ws)))
            ws[int(draw.integers(0, 120))] = f"x{group}{copy}"
    rows += [(100, None), (101, ""), (102, " \n"), (103, "one"), (104, "ONE"), (None, "one"), (105, "z " * 50000)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, "alone by null key")]
    return rows


def test_components_against_all_pairs(spark):
    rows = texts()
    table = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("code", F.lit(1))
    found = simhash.near_duplicates(table.withColumn("fingerprint", F.lit("mine")))
    got = found.select("doc_id", simhash.as_hex(F.col("fingerprint")), "component_id").collect()
    want = slow_components(rows)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert len({w[2] for w in want}) < len(want) - 20


def test_empty(spark):
    table = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(table).collect() == []
