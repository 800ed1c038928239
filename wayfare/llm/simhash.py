"""Near-duplicates by SimHash: all fingerprints within a radius are linked."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import LOWER, UPPER
from wayfare.llm.components import stars
from wayfare.session import written

BITS, LANES = 64, 64
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())


# --- fingerprints ----------------------------------------------------------


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """The fingerprint of one text as an unsigned number; 0 without words."""
    ws = (text or "").encode().translate(_LOWERED).split()
    if not ws:
        return 0
    joined = b" ".join(ws)
    ends = np.cumsum([len(w) + 1 for w in ws]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(width, len(ws))
    counts, n = np.zeros(BITS, dtype=np.int64), len(ws) - width + 1
    spans = zip(starts[:n].tolist(), ends[width - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    while chunk := list(itertools.islice(spans, 1 << 16)):
        hashes = np.array([digest(joined[s:e], seed) for s, e in chunk], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, width: int = 3, seed: int = 42) -> Column:
    """Fingerprints as signed 64-bit numbers of the same bits."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint(t, width, seed) for t in texts], dtype=np.uint64)
        return pd.Series(found.view(np.int64))

    return of(text)


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


# --- bit-sliced comparison -------------------------------------------------


def bit_planes(codes: np.ndarray) -> np.ndarray:
    """Codes stood on end: row ``b`` holds bit ``b`` of 64 codes in each word."""
    n = -(-len(codes) // LANES)
    bits = np.zeros((n * LANES, BITS), dtype=np.uint8)
    bits[: len(codes)] = np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return packed.view("<u8")


def near_pairs(
    codes: np.ndarray, ends: np.ndarray, radius: int, block: int = 1 << 17
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs ``i < j < ends[i]`` whose codes differ in at most ``radius`` bits.

    Code ``i`` meets words of 64 codes at once. The distances of a word are
    counters spread over a few numbers, one bit of all 64 counters each; a bit
    plane is added to all of them by carry-save steps. A counter that passes the
    radius overflows into a mask, and a word whose mask is full is given up.
    """
    n, planes = len(codes), bit_planes(codes)
    first, last = np.arange(n) // LANES, (ends - 1) // LANES
    count = last - first + 1
    start = np.cumsum(count) - count
    width = radius.bit_length()
    for at in range(0, int(count.sum()), block):
        item = np.arange(at, min(at + block, int(count.sum())))
        i = np.searchsorted(start, item, side="right") - 1
        word = first[i] + (item - start[i])
        base = word * LANES
        low = np.clip(i + 1 - base, 0, LANES)
        high = np.clip(ends[i] - base, 0, LANES)
        # Lanes from low to high - 1 count; all others have overflowed already.
        over = ~(_below(high) & ~_below(low))
        counters = [
            np.full(len(item), ALL if ((1 << width) - 1 - radius) >> k & 1 else 0, dtype=np.uint64)
            for k in range(width)
        ]
        query = codes[i]
        for bit in range(BITS):
            if bit % 4 == 0:
                keep = over != ALL
                if not keep.any():
                    break
                if not keep.all():
                    i, word, over, query = i[keep], word[keep], over[keep], query[keep]
                    counters = [c[keep] for c in counters]
            carry = planes[bit, word] ^ (ALL * ((query >> np.uint64(bit)) & np.uint64(1)))
            for c in counters:
                both = c & carry
                c ^= carry
                carry = both
            over |= carry
        else:
            hit = np.flatnonzero(over != ALL)
            lanes = np.unpackbits((~over[hit]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, lane = np.nonzero(lanes)
            yield i[hit[row]], word[hit[row]] * LANES + lane


def _below(n: np.ndarray) -> np.ndarray:
    """Numbers with the lowest ``n`` bits set, for n from 0 to 64."""
    return np.where(n >= LANES, ALL, (np.uint64(1) << (n % LANES).astype(np.uint64)) - np.uint64(1))


def roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least member of each item's component."""
    parent = np.arange(n)
    for left, right in pairs:
        while len(left):
            while not np.array_equal(above := parent[parent], parent):
                parent = above
            left, right = parent[left], parent[right]
            apart = left != right
            left, right = left[apart], right[apart]
            np.minimum.at(parent, np.maximum(left, right), np.minimum(left, right))
    while not np.array_equal(above := parent[parent], parent):
        parent = above
    return parent


# --- links among all fingerprints ------------------------------------------


def band_keys(code: Column, radius: int) -> Column:
    """Keys of which two codes within ``radius`` share at least one.

    The bits are cut into ``radius + 2`` bands. At least two bands of such codes
    are equal, so each pair of bands with its place is a key.
    """
    bands = radius + 2
    edges = [BITS * k // bands for k in range(bands + 1)]
    band = [
        F.shiftrightunsigned(code, low).bitwiseAND((1 << (high - low)) - 1)
        for low, high in itertools.pairwise(edges)
    ]
    widest = max(high - low for low, high in itertools.pairwise(edges))
    return F.array(
        *[
            F.shiftleft(F.lit(number).cast("long"), 2 * widest)
            .bitwiseOR(F.shiftleft(band[x], widest))
            .bitwiseOR(band[y])
            for number, (x, y) in enumerate(itertools.combinations(range(bands), 2))
        ]
    )


def links(codes: DataFrame, code: str, radius: int, tile: int = 4096) -> DataFrame:
    """Links ``a``, ``b`` that connect all codes within ``radius`` of each other.

    ``codes`` holds distinct signed 64-bit numbers. Codes that share a band key
    are compared bit-sliced. A key with more than ``tile`` codes is cut into
    parts, and each pair of parts is compared by itself, so no task gets a whole
    hot key. Of each comparison only links to the least code of a
    component are passed on, never all pairs.
    """
    keyed = codes.select(F.col(code).alias("code"), F.explode(band_keys(F.col(code), radius)).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / tile).cast("int")
    tiled = (
        keyed.join(shared, "key")
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("code"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "key",
            F.least("part", "other").alias("low"),
            F.greatest("part", "other").alias("high"),
            "code",
        )
    )
    group = ["key", "low", "high"]

    def compared(table: pa.Table) -> pa.RecordBatch:
        codes = table["code"].to_numpy().view(np.uint64)
        ends = _group_ends(table)
        root = roots(len(codes), near_pairs(codes, ends, radius))
        member = np.flatnonzero(root != np.arange(len(root)))
        found = codes.view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(found[root[member]]), pa.array(found[member])], names=["a", "b"]
        )

    def in_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 1 << 16:
                table = pa.Table.from_batches(held).combine_chunks()
                changes = np.flatnonzero(_changes(table))
                # The last group may go on in the next batch.
                cut = int(changes[-1]) + 1 if len(changes) else 0
                if cut:
                    yield compared(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                rows = table.num_rows - cut
        if rows:
            yield compared(pa.Table.from_batches(held).combine_chunks())

    return (
        tiled.repartition(*group)
        .sortWithinPartitions(*group, "code")
        .mapInArrow(in_partition, "a bigint, b bigint")
        .distinct()
    )


def _changes(table: pa.Table) -> np.ndarray:
    """For all rows but the last, whether the next row is of another group."""
    columns = [table[name].to_numpy() for name in ("key", "low", "high")]
    return np.any([c[1:] != c[:-1] for c in columns], axis=0)


def _group_ends(table: pa.Table) -> np.ndarray:
    last = np.append(np.flatnonzero(_changes(table)), table.num_rows - 1)
    return np.repeat(last + 1, np.diff(np.append(-1, last)))


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 3,
    radius: int = 3,
) -> DataFrame:
    """One row per document: ``key``, ``fingerprint`` and ``component_id``.

    ``fingerprint`` is a signed 64-bit number (see `as_hex`). ``component_id`` is
    the least ``key`` that can be reached over links of at most ``radius``
    differing bits, the document's own included.

    Equal fingerprints meet as one before anything is compared, so copies cost
    nothing further. Links and components are tables in the shared folder.
    Texts that are null, empty or without words have fingerprint 0 and are linked like
    any other. Repeated rows are returned as often as they come. Null keys
    are not counted for a component's id; a component of null keys only has a
    null id. Empty input gives no rows.
    """
    rows = docs.select(
        F.col(key).alias("key"), fingerprint_column(F.col(text), width).alias("fingerprint")
    )
    rows = written(rows, "fingerprints")
    codes = written(rows.groupBy("fingerprint").agg(F.min("key").alias("least")), "codes")
    linked = stars(links(codes, "fingerprint", radius))
    rooted = codes.join(linked, F.col("fingerprint") == F.col("a"), "left").select(
        "fingerprint", "least", F.coalesce("b", "fingerprint").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # Only linked fingerprints need their component's id from elsewhere.
    ids = rooted.join(named, "root").select(
        F.col("fingerprint").alias("code"), "component_id"
    )
    return rows.join(ids, F.col("fingerprint") == F.col("code"), "left").select(
        F.col("key").alias(key), "fingerprint", "component_id"
    )
