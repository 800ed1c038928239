import random
import re

import numpy as np
import pytest

from wayfare.llm import minhash
from wayfare.llm.minhash import Signer, shingles, similar_roots

COLUMNS = "doc_id bigint, text string"
LOWERED = {c: c + 32 for c in range(65, 91)}


def slow_set(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWERED))
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def slow(rows, percent=85):
    """All pairs; (key, size, component, kept) of each row."""
    sets = [slow_set(text) for _, text in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root = [root[j] if r == root[i] else r for r in root]
    out = []
    for k, (key, _) in enumerate(rows):
        keys = [rows[m][0] for m in range(len(rows)) if root[m] == root[k] and rows[m][0] is not None]
        # Without words a document is alone, also among repeated rows.
        component = (min(keys) if keys else None) if sets[k] else key
        out.append((key, len(sets[k]), component, key == component))
    return sorted(out, key=repr)


def found(spark, rows, **more):
    docs = spark.createDataFrame(rows, COLUMNS)
    got = minhash.near_duplicates(docs, **more).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=repr)


def text(rng, n, words=400):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def copies():
    """Groups of near copies of many lengths, with pairs on both sides of the bound."""
    rng = random.Random(5)
    rows = []
    for n in (1, 2, 3, 4, 7, 20, 45, 90, 200, 700):
        for _ in range(3):
            base = text(rng, n)
            rows += [" ".join(base)] * 2
            rows += [" ".join(edited(rng, base, e)) for e in (1, 1, 2, 3, 5, 8, n // 40 + 1)]
            rows.append(" ".join(base).upper() + "\n")
            rows.append(" ".join(base[: len(base) * 9 // 10]))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_against_all_pairs(spark, copies):
    odd = [(None, copies[3][1]), (None, copies[3][1]), (None, "only here twice"), (None, "only here twice"),
           (9000, None), (9001, ""), (9002, " \n\t\x0b"), (9000, None), (3, copies[3][1]), (9003, "one"), (9004, "One"),
           (9005, "one two"), (9006, "one\xa0two"), (9007, "b c d " * 30000)]
    assert found(spark, copies + odd) == slow(copies + odd)


def chain(rng, links, n=200):
    """Texts of which each is similar to the one before, and few to others."""
    words, out = text(rng, n, 10**6), []
    for k in range(links):
        out.append(" ".join(words))
        # Three words in a row make five new shingles.
        words[(k * 4) % n : (k * 4) % n + 3] = [f"y{k}", f"z{k}", f"u{k}"]
    return out


@pytest.mark.parametrize("limits", [{}, {"most_items": 900, "most_sets": 3}])
def test_links_between_the_leaves_of_a_star(spark, limits):
    # All quote most of one text, which is the least of all and similar to none.
    rng = random.Random(8)
    base = text(rng, 100, 10**6)
    rows = [" ".join(base)]
    for _ in range(12):
        own = base + text(rng, 25, 10**6)
        rows += [" ".join(own), " ".join(own[:-1] + ["q"])]
    rows += chain(rng, 30)
    rows = list(enumerate(rows))
    want = slow(rows)
    assert len({r[2] for r in want}) > 10
    assert found(spark, rows, **limits) == want


def test_leaves_are_compared_only_where_needed(spark):
    met = spark.createDataFrame(
        [(b, p, 0) for b in (1, 2) for p in (0, 1, 2)] + [(3, p, 0) for p in (0, 3, 4)],
        "bucket bigint, place bigint, hub bigint",
    )
    linked = spark.createDataFrame([(4, 3)], "a bigint, b bigint")
    left = minhash.unsettled(met, linked).collect()
    # Buckets 1 and 2 have the same members; the leaves of 3 are linked already.
    assert sorted((r.place, r.root) for r in left) == [(1, 1), (2, 2)]


def test_a_large_group_gives_fewer_edges_than_members(spark):
    rng = random.Random(2)
    base = text(rng, 120, 10**6)
    rows = [(0, " ".join(base))] + [(k, " ".join(edited(rng, base, 1))) for k in range(1, 400)]
    assert {r[2] for r in found(spark, rows)} == {0}
    signer = Signer(40, 6)
    places = [signer.keys(signer.signature(shingles(t, 3))[None, :])[0] for _, t in rows]
    edges = set()
    for band in range(40):
        buckets = {}
        for k, keys in enumerate(places):
            buckets.setdefault(keys[band], []).append(k)
        edges |= {(m[0], leaf) for m in buckets.values() for leaf in m[1:]}
    assert len(edges) < 40 * len(rows) < len(rows) ** 2 / 2


def test_signatures_agree_as_often_as_sets_do():
    rng = np.random.default_rng(3)
    signer = Signer(40, 6)
    for n in (4, 12, 60, 1500):
        agree = []
        for _ in range(40):
            items = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
            other = np.unique(np.append(items[rng.permutation(len(items))[: -max(1, n // 8)]], np.uint64(7)))
            union = len(np.union1d(items, other))
            agree.append((signer.signature(items) == signer.signature(other)).mean() - (len(items) + len(other) - union) / union)
        assert abs(np.mean(agree)) < 0.05


def test_one_item_fills_all_bins():
    signer = Signer(4, 3)
    assert (signer.signature(np.array([9], dtype=np.uint64)) == 9).all()


def test_similar_roots_goes_on_from_known_components():
    a = np.arange(100, dtype=np.uint64)
    sets = [a, a + np.uint64(5), a + np.uint64(500), a + np.uint64(10)]
    assert similar_roots(sets, np.arange(4), 85).tolist() == [0, 0, 2, 0]
    assert similar_roots(sets, np.array([0, 1, 0, 3]), 85).tolist() == [0, 0, 0, 0]


def test_other_columns_and_empty(spark, copies):
    docs = spark.createDataFrame(copies[:40], COLUMNS)
    odd = docs.selectExpr("*", "1 AS place", "2 AS bucket", "'x' AS said", "3 AS key", "4 AS n", "5 AS print")
    got = minhash.near_duplicates(odd).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=repr) == slow(copies[:40])
    assert minhash.near_duplicates(docs.limit(0)).collect() == []
