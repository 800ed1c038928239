"""Near-duplicates by one-permutation MinHash, every link confirmed on full sets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import LOWER, UPPER
from wayfare.llm.components import stars
from wayfare.session import written

_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
_ODD = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.zeros(0, dtype=np.uint64)


# --- shingle sets ----------------------------------------------------------


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    numbers = (numbers ^ (numbers >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    numbers = (numbers ^ (numbers >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return numbers ^ (numbers >> np.uint64(32))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; a shorter text is one run.

    Words are runs of anything but the six ASCII spaces, A to Z lower-cased. Without words
    there are none. A run's hash is made of its words' hashes, so words are hashed once.
    """
    said = (text or "").encode().translate(_LOWERED).split()
    if not said:
        return _EMPTY
    digest = xxhash.xxh3_64_intdigest
    hashed = np.array([digest(w) for w in said], dtype=np.uint64)
    width = min(width, len(said))
    run = np.full(len(said) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        run = _mixed(run * _ODD + hashed[k : len(said) - width + 1 + k])
    return np.unique(run)


# --- signatures ------------------------------------------------------------


class Signer:
    """Band keys of sets: one permutation cut into bins, empty ones densified.

    The hashes of a set are its permuted items. Their range is cut into ``bands *
    rows`` bins, and a bin holds its least item. A bin without one borrows from the
    first bin with one along a probe order of its own, a random permutation
    of all bins that is the same for every set. So borrowed bins agree
    with the probability that the sets are similar, independently of each other.
    """

    def __init__(self, bands: int, rows: int, seed: int = 12):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        rng = np.random.default_rng(seed)
        order = np.tile(np.arange(self.bins, dtype=np.int32), (self.bins, 1))
        #: ``probe[bin, other]``: how late ``other`` comes in the order of ``bin``.
        self.probe = rng.permuted(order, axis=1)

    def signature(self, items: np.ndarray) -> np.ndarray:
        """The densified bins of one sorted set that is not empty."""
        of = ((items >> np.uint64(32)) * np.uint64(self.bins)) >> np.uint64(32)
        first = np.flatnonzero(np.diff(of.astype(np.int64), prepend=-1))
        full = of[first].astype(np.int64)
        out = np.zeros(self.bins, dtype=np.uint64)
        out[full] = items[first]
        if len(full) < self.bins:
            empty = np.setdiff1d(np.arange(self.bins), full, assume_unique=True)
            out[empty] = items[first[self.probe[np.ix_(empty, full)].argmin(axis=1)]]
        return out

    def keys(self, signatures: np.ndarray) -> np.ndarray:
        """A 64-bit key of each band of each signature, the band's number in it."""
        cut = signatures.reshape(-1, self.bands, self.rows)
        key = np.broadcast_to(np.arange(1, self.bands + 1, dtype=np.uint64), cut.shape[:2])
        for row in range(self.rows):
            key = _mixed(key * _ODD + cut[:, :, row])
        return key


def _pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def _lists(flat: np.ndarray, sizes: Sequence[int]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def signed(docs: DataFrame, width: int, signer: Signer) -> DataFrame:
    """``key``, ``print``, the set's size ``n``, its digest ``said`` and its ``bands``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _pieces(batches, 500):
            found = [shingles(t.as_py(), width) for t in part["text"]]
            signatures = np.array([signer.signature(f) for f in found if len(f)], dtype=np.uint64)
            keys = signer.keys(signatures.reshape(-1, signer.bins)).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    part["key"],
                    part["print"],
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(f.tobytes()) for f in found], pa.binary()),
                    _lists(keys, [signer.bands if len(f) else 0 for f in found]),
                ],
                names=["key", "print", "n", "said", "bands"],
            )

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(rows, f"key {kind}, print bigint, n bigint, said binary, bands array<bigint>")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """``said`` and the whole set ``items`` of each text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _pieces(batches, 500):
            found = [shingles(t.as_py(), width) for t in part["text"]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([xxhash.xxh3_128_digest(f.tobytes()) for f in found], pa.binary()),
                    _lists(np.concatenate(found) if found else _EMPTY, [len(f) for f in found]),
                ],
                names=["said", "items"],
            )

    return docs.select("text").mapInArrow(rows, "said binary, items array<bigint>")


# --- links -----------------------------------------------------------------


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose whole sets are similar."""
    one = sets.select(F.col("place").alias("a"), F.col("items").alias("items_a"))
    two = sets.select(F.col("place").alias("b"), F.col("items").alias("items_b"))
    both = F.size("items_a") + F.size("items_b")
    # The shorter one must have that share of the longer one's size.
    may = 100 * F.least(F.size("items_a"), F.size("items_b")) >= percent * F.greatest(
        F.size("items_a"), F.size("items_b")
    )
    shared = F.size(F.array_intersect("items_a", "items_b"))
    similar = (100 + percent) * shared.cast("long") >= percent * both.cast("long")
    return pairs.join(one, "a").join(two, "b").where(may).where(similar).select("a", "b")


def similar_roots(sets: Sequence[np.ndarray], root: np.ndarray, percent: int) -> np.ndarray:
    """The first member of each set's component, where similar sets are linked.

    ``root`` names components known before. Each set is counted against all that
    hold one of its items; sets of one component need no comparison, so it ends
    when one component is left.
    """
    m, root = len(sets), root.copy()
    left = len(np.unique(root))
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    _, item = np.unique(np.concatenate(sets), return_inverse=True)
    holders = np.repeat(np.arange(m), sizes)[np.argsort(item, kind="stable")]
    begins = np.concatenate(([0], np.cumsum(np.bincount(item))))
    at = np.concatenate(([0], np.cumsum(sizes)))
    for i in range(m):
        if left == 1:
            break
        own = item[at[i] : at[i + 1]]
        counts = begins[own + 1] - begins[own]
        place = np.arange(int(counts.sum())) + np.repeat(begins[own] - (np.cumsum(counts) - counts), counts)
        shared = np.bincount(holders[place], minlength=m)
        near = (100 * shared >= percent * (sizes[i] + sizes - shared)) & (root != root[i])
        for other in np.unique(root[near]):
            low, high = min(other, root[i]), max(other, root[i])
            root[root == high] = low
            left -= 1
    return root


def compared(members: DataFrame, sets: DataFrame, percent: int, most_items: int, most_sets: int) -> DataFrame:
    """Links ``a``, ``b`` that connect all similar sets of each bucket.

    ``members`` has ``bucket``, ``place``, ``n`` and the component ``root`` known so far.
    Buckets that have members in common are one if a task can hold them together, so
    a pair that meets in many buckets is compared once. A bucket beyond ``most_sets`` sets
    or ``most_items`` items is cut into parts, and each pair of parts is compared by
    itself, so a task holds two parts at most. Only links to the first of a component
    are passed on.
    """
    parts = F.greatest(F.ceil(F.sum("n") / most_items), F.ceil(F.count(F.lit(1)) / most_sets)).cast("int")
    least = members.groupBy("bucket").agg(F.min("place").alias("b"))
    touching = stars(members.join(least, "bucket").select(F.col("place").alias("a"), "b").distinct())
    clusters = members.join(touching.withColumnRenamed("a", "place"), "place", "left").withColumn(
        "cluster", F.coalesce("b", "place")
    )
    together = clusters.select("cluster", "place", "n").distinct().groupBy("cluster").agg(parts.alias("parts"))
    together = together.where("parts = 1").select("cluster", F.lit(True).alias("together"))
    bucket = F.when(F.col("together"), F.lit(0)).otherwise(F.col("bucket"))
    members = clusters.join(together, "cluster", "left").select(
        "cluster", bucket.alias("bucket"), "place", "n", "root"
    )
    members = written(members.distinct(), "to-compare")
    sizes = members.groupBy("cluster", "bucket").agg(parts.alias("parts"))
    group = ["cluster", "bucket", "low", "high"]
    tiled = (
        members.join(sizes, ["cluster", "bucket"])
        .withColumn("part", F.pmod(F.xxhash64("place"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "cluster", "bucket", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
            "place", "root",
        )
        .join(sets, "place")
    )

    def links(places: list[int], roots: list[int], items: list[np.ndarray]) -> pa.RecordBatch:
        a, b = [], []
        if len(set(roots)) > 1:
            _, first, known = np.unique(np.array(roots), return_index=True, return_inverse=True)
            found = similar_roots(items, first[known], percent)
            changed = np.flatnonzero(found != first[known])
            a, b = [places[k] for k in found[changed]], [places[k] for k in changed]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def in_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, places, roots, items = None, [], [], []
        for part in _pieces(batches, 500):
            keys = zip(*[part[name].to_pylist() for name in group])
            held = part["items"]
            flat, offsets = held.values.to_numpy().view(np.uint64), held.offsets.to_numpy()
            for k, (of, place, root) in enumerate(zip(keys, part["place"].to_pylist(), part["root"].to_pylist())):
                if of != now:
                    yield links(places, roots, items)
                    now, places, roots, items = of, [], [], []
                places.append(place)
                roots.append(root)
                items.append(flat[offsets[k] : offsets[k + 1]].copy())
        yield links(places, roots, items)

    return (
        tiled.select(*group, "place", "root", "items")
        .repartition(*group)
        .sortWithinPartitions(*group, "place")
        .mapInArrow(in_partition, "a bigint, b bigint")
        .distinct()
    )


def unsettled(met: DataFrame, linked: DataFrame) -> DataFrame:
    """Members of buckets in which two sets may be similar and were not compared.

    In its star every member has met the hub. What is left are buckets whose other members
    are of two components or more; of buckets with the same members one is enough.
    """
    roots = linked.select(F.col("a").alias("place"), F.col("b").alias("root"))
    known = met.join(roots, "place", "left").withColumn("root", F.coalesce("root", "place"))
    apart = (
        known.where("place <> hub")
        .groupBy("bucket")
        .agg(
            F.min("root").alias("first"),
            F.max("root").alias("last"),
            F.count(F.lit(1)).alias("members"),
            F.bit_xor(F.xxhash64("place")).alias("one"),
            F.bit_xor(F.xxhash64("place", F.lit(1))).alias("two"),
        )
        .where("first < last")
    )
    chosen = apart.groupBy("members", "one", "two").agg(F.min("bucket").alias("bucket")).select("bucket")
    return known.where("place <> hub").join(chosen, "bucket").select("bucket", "place", "root")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 3,
    percent: int = 85,
    bands: int = 40,
    rows: int = 6,
    most_items: int = 1 << 21,
    most_sets: int = 4096,
) -> DataFrame:
    """One row per document: ``key``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked if their sets of distinct ``width``-word shingles have
    ``percent`` of their union in common; a text of fewer words is one shingle, and one without
    words (null, empty) has none and is linked with nothing. ``component_id`` is the least
    ``key`` that can be reached, ``kept`` says that it is the document's own.

    - Equal sets meet as one, whatever their number.
    - Sets meet that share a band of ``rows`` bins of their signature. A pair at
      the bound misses all ``bands`` with a probability of 6 in 10^9 by default.
    - Each bucket gives a star, edges from its least member to the others,
      so it has fewer edges than members.
    - Edges are confirmed on whole sets, which are made again from the texts of the
      sets that met. No other text is shuffled if those are few enough to be broadcast.
    - A star does not compare its leaves. Buckets whose leaves are still in several
      components are compared within, tile by tile, so no link of a bucket is lost.

    Shingles are compared by 64-bit hashes, whole sets by 128 bits. Repeated rows are returned as
    often as they come. Null keys do not count for a component's id; one of null keys
    only has a null id, and its documents are kept. Only ``key`` and ``text``
    are read, so other columns may have any name. Empty input gives no rows.
    """
    own = docs.select(
        F.col(key).alias("key"),
        F.col(text).alias("text"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("print"),
    )
    told = written(
        signed(own, width, Signer(bands, rows)).withColumn("place", F.monotonically_increasing_id()),
        "signatures",
    )
    # A set goes by the place of one of the documents that have it.
    sets = written(
        told.where("n > 0")
        .groupBy("said")
        .agg(F.min("place").alias("place"), F.min("key").alias("least"), F.count(F.lit(1)).alias("copies")),
        "distinct-sets",
    )
    banded = told.join(sets.select("place"), "place", "left_semi").select(
        "place", F.explode("bands").alias("bucket")
    )
    hubs = banded.groupBy("bucket").agg(F.min("place").alias("hub"), F.max("place").alias("last"))
    met = written(banded.join(hubs.where("hub < last").select("bucket", "hub"), "bucket"), "buckets")
    who = written(
        told.join(met.select("place").distinct(), "place").select("key", "print", "said", "place", "n"), "sets-met"
    )
    of_who = who.select(F.col("key").alias("of"), F.col("print").alias("is"))
    texts = own.join(of_who, F.col("key").eqNullSafe(F.col("of")) & (F.col("print") == F.col("is")), "left_semi")
    whole = written(
        full_sets(texts, width).join(who.select("said", "place"), "said").drop("said").dropDuplicates(["place"]),
        "whole-sets",
    )
    edges = met.where("place <> hub").select(F.col("hub").alias("a"), F.col("place").alias("b")).distinct()
    links = written(confirmed(edges, whole, percent), "star-links")
    linked = stars(links)
    left = written(unsettled(met, linked), "unsettled")
    if not left.isEmpty():
        left = left.join(who.select("place", "n"), "place")
        linked = stars(links.unionAll(compared(left, whole, percent, most_items, most_sets)))

    rooted = sets.join(linked.withColumnRenamed("a", "place"), "place", "left").select(
        "said", "least", "copies", F.coalesce("b", "place").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("copies").alias("members"))
    ids = rooted.join(named.where("members > 1"), "root").select("said", "component_id")
    # Nobody else has the set of a document that finds no id here.
    return (
        told.join(ids, "said", "left")
        .withColumn("component_id", F.coalesce("component_id", "key"))
        .select(
            F.col("key").alias(key),
            F.col("n").alias("n_shingles"),
            "component_id",
            F.col("key").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )
