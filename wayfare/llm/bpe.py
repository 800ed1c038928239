"""Byte-level byte-pair encoding by Spark's higher-order functions."""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import let
from wayfare.session import written


@dataclass(frozen=True)
class Ranks:
    """The pieces of a vocabulary by rank, which is also their id."""

    pieces: tuple[bytes, ...]

    @classmethod
    def read(cls, path: str) -> Ranks:
        """Read a rank file: a base64 piece and its rank on each line."""
        with open(path, "rb") as file:
            ranked = [line.split() for line in file if line.strip()]
        by_rank = {int(rank): base64.b64decode(piece) for piece, rank in ranked}
        if sorted(by_rank) != list(range(len(by_rank))):
            raise ValueError("ranks must count from 0 without a gap")
        pieces = tuple(by_rank[k] for k in range(len(by_rank)))
        if missing := set(range(256)) - {p[0] for p in pieces if len(p) == 1}:
            raise ValueError(f"{len(missing)} single bytes have no rank")
        return cls(pieces)

    @cached_property
    def rank(self) -> dict[bytes, int]:
        return {piece: k for k, piece in enumerate(self.pieces)}

    @cached_property
    def byte_ids(self) -> np.ndarray:
        return np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int32)

    @cached_property
    def merges(self) -> dict[tuple[int, int], int]:
        """Each pair of ids that joins to a piece, and that piece's id."""
        return {
            (left, right): whole
            for whole, piece in enumerate(self.pieces)
            for cut in range(1, len(piece))
            if (left := self.rank.get(piece[:cut])) is not None
            and (right := self.rank.get(piece[cut:])) is not None
        }


# --- the literal rank map --------------------------------------------------


class RankMap:
    """Pair of ids -> rank, as literals that Spark can look up in constant time.

    Spark searches a map from its start, so 50,000 entries cannot be one map.
    This is a trie of depth two in arrays: the pairs of a left id lie at an
    offset of its own plus the right id, rows of different left ids shifted into
    each other's gaps, and each place names the left id it belongs to. The size
    depends on the vocabulary only.
    """

    def __init__(self, merges: dict[tuple[int, int], int], ids: int):
        rows: dict[int, list[tuple[int, int]]] = {}
        for (left, right), rank in sorted(merges.items()):
            rows.setdefault(left, []).append((right, rank))
        span, window = ids, 512
        size = 2 * len(merges) + 4 * (span + window)
        owner, value = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        self.offset = np.zeros(ids, np.int64)
        start, length = 0, -1
        # Long rows first; rows of one length go on where the last one lay.
        for left, row in sorted(rows.items(), key=lambda item: (-len(item[1]), item[0])):
            if len(row) != length:
                start, length = 0, len(row)
            rights = np.array([right for right, _ in row])
            while True:
                if start + 2 * (span + window) > len(owner):
                    owner = np.concatenate((owner, np.full(size, -1)))
                    value = np.concatenate((value, np.zeros(size, np.int64)))
                first = start + np.flatnonzero(owner[start : start + window] < 0)
                fits = (owner[first[:, None] + (rights - rights[0])] < 0).all(axis=1)
                if fits.any():
                    break
                start += window
            place = int(first[np.argmax(fits)])
            at = place - rights[0] + rights
            owner[at], value[at] = left, [rank for _, rank in row]
            self.offset[left] = place - rights[0]
        used = np.flatnonzero(owner >= 0)[-1] + 1 if rows else 1
        self.owner, self.value = owner[:used], value[:used]

    def bound(self, body: Callable[[Sequence[Column]], Column]) -> Column:
        """``body`` of the three arrays, each written into the plan once.

        Every description of the plan then holds them too; see ``rank_arrays``.
        """

        def literal(numbers: np.ndarray) -> Column:
            return F.split(F.lit(",".join(map(str, numbers.tolist()))), ",").cast("array<int>")

        return let(
            literal(self.offset),
            lambda a: let(literal(self.owner), lambda b: let(literal(self.value), lambda c: body((a, b, c)))),
        )


ARRAYS = ("offset", "owner", "value")


def rank_arrays(spark: SparkSession, ranks: Ranks) -> DataFrame:
    """The arrays of the map of ``ranks`` as one written row, made in a task.

    So neither the map nor its text is on the driver, whatever the plan is copied for.
    """
    pieces = ranks.pieces

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = RankMap(Ranks(pieces).merges, len(pieces))
                arrays = [_one(pa.array(getattr(found, name).astype(np.int32))) for name in ARRAYS]
                yield pa.RecordBatch.from_arrays(arrays, names=ARRAYS)

    schema = ", ".join(f"{name} array<int>" for name in ARRAYS)
    return written(spark.range(0, 1, 1, 1).mapInArrow(made, schema), "bpe-ranks")


def beside_arrays(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with ``bpe__ranks``, the arrays of ``rank_arrays``; for few rows, as of blocks."""
    return rows.withColumn("bpe__ranks", found.select(F.struct(*ARRAYS)).scalar())


def of_arrays(body: Callable[[Sequence[Column]], Column]) -> Column:
    """``body`` of the arrays that are beside a row."""
    return let(F.col("bpe__ranks"), lambda held: body([held[name] for name in ARRAYS]))


def rank_of(arrays: Sequence[Column], left: Column, right: Column) -> Column:
    """The rank of a pair, null where it does not join."""
    offset, owner, value = arrays
    return F.when(
        F.get(owner, F.get(offset, left) + right) == left, F.get(value, F.get(offset, left) + right)
    )


def folded_merges(start: Column, ranks: Sequence[Column]) -> Column:
    """Merge an array of byte ids until no neighbours join, least rank first.

    Each step of the fold finds the first of the pairs of least rank, puts the
    rank in the place of its left id and leaves its right id out.
    """

    def step(ids: Column, _: Column) -> Column:
        def merged(joins: Column) -> Column:
            def at(least: Column) -> Column:
                def without(p: Column) -> Column:
                    # p counts from 1, so it is the place of the right id from 0.
                    rest = F.filter(ids, lambda x, i: i != p)
                    return F.transform(rest, lambda x, i: F.when(i == p - 1, least).otherwise(x))

                return F.when(least.isNull(), ids).otherwise(
                    let(F.array_position(joins, least), without)
                )

            return let(F.array_min(joins), at)

        # Beyond the end there is no right neighbour and so no rank.
        return let(F.transform(ids, lambda x, i: rank_of(ranks, x, F.get(ids, i + 1))), merged)

    return F.when(F.size(start) < 2, start).otherwise(
        F.aggregate(F.sequence(F.lit(2), F.size(start)), start, step)
    )


def merged_by_heap(ids: Sequence[int], merges: dict[tuple[int, int], int]) -> list[int]:
    """The same merges with a heap, for words so long that a fold would crawl."""
    ids = list(ids)
    before, after = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
    queue: list[tuple[int, int, int, int]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < len(ids) and (rank := merges.get((ids[left], ids[right]))) is not None:
            heapq.heappush(queue, (rank, left, ids[left], ids[right]))

    for k in range(len(ids) - 1):
        offer(k)
    while queue:
        rank, left, was_left, was_right = heapq.heappop(queue)
        right = after[left]
        if ids[left] != was_left or right >= len(ids) or ids[right] != was_right:
            continue
        ids[left], ids[right] = rank, -1
        after[left] = after[right]
        if after[left] < len(ids):
            before[after[left]] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    return [k for k in ids if k >= 0]


# --- words of texts --------------------------------------------------------

# Fixed value: the pattern of the vocabularies whose words are found without a scan.
CLASS_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
LETTER, NUMBER, SPACE, OTHER, END = range(5)
_END = 0x110000  # no code point, so it can stand for the end of a text
# Characters that are cut at once; a longer text is cut by itself.
_CHUNK = 1 << 20


@functools.cache
def _kinds() -> np.ndarray:
    """The class of each code point in ``CLASS_PATTERN``, and of the end of a text."""
    points = np.concatenate((np.arange(0xD800), np.arange(0xE000, _END)))
    every = points.astype("<u4").tobytes().decode("utf-32-le")
    kinds = np.full(_END + 1, OTHER, np.uint8)
    for kind, runs in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for run in regex.finditer(runs, every):
            kinds[points[run.start() : run.end()]] = kind
    kinds[_END] = END
    return kinds


def _begins(points: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Which code points begin a word of ``CLASS_PATTERN``; each text ends with ``_END``.

    Words are runs of one class, with three exceptions: of white space before a
    word the last character stands alone, a plain space there belongs to the word,
    and an apostrophe that begins a word takes the letters of a contraction along.
    """
    begins = np.ones(len(points), bool)
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == END)
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != END))
    begins[last] = True
    begins[last[points[last] == ord(" ")] + 1] = False
    quote = np.flatnonzero((points == ord("'")) & begins)
    quote = quote[kind[quote + 1] == LETTER]
    # A letter is never the end, so there is one more code point.
    one, two = points[quote + 1], points[quote + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    pairs = [(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")]
    long = np.logical_or.reduce(pairs)
    begins[quote[short | long] + 1] = False
    begins[quote[short] + 2] = True
    begins[quote[long] + 3] = True
    return begins


def class_words(texts: Sequence[str]) -> tuple[pa.Array, np.ndarray]:
    """All words of ``CLASS_PATTERN`` in order, and how many each text has."""
    joined = "".join(texts)
    ends = np.cumsum([len(t) for t in texts])
    points = np.insert(np.frombuffer(joined.encode("utf-32-le"), np.uint32), ends, _END)
    kind = _kinds()[points]
    starts = np.flatnonzero(_begins(points, kind) & (kind != END))
    # Bytes of a code point in UTF-8; an end has none.
    size = np.ones(len(points), np.int32)
    for least in (0x80, 0x800, 0x10000):
        size += points >= least
    size[kind == END] = 0
    before = np.concatenate((np.zeros(1, np.int32), np.cumsum(size, dtype=np.int32)))
    offsets = np.append(before[starts], before[-1]).astype(np.int32)
    words = pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(joined.encode())
    )
    return words, np.diff(np.searchsorted(starts, np.flatnonzero(kind == END)), prepend=0)


def pattern_words(find: regex.Pattern, texts: Sequence[str]) -> tuple[pa.Array, np.ndarray]:
    """All matches in order, and how many each text has."""
    found = [[m[0] for m in find.finditer(text)] for text in texts]
    words = pa.array([w for ws in found for w in ws], pa.string())
    return words, np.array([len(ws) for ws in found], dtype=np.int64)


def _spans(lengths: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Texts one after the other, each span closed once it holds ``size``."""
    start, held = 0, 0
    for k, length in enumerate(lengths.tolist()):
        held += length
        if held >= size or k == len(lengths) - 1:
            yield start, k + 1
            start, held = k + 1, 0


def _lengths(texts: pa.Array) -> np.ndarray:
    return pc.utf8_length(texts).to_numpy(zero_copy_only=False)


def cut_texts(texts: pa.Array, pattern: str) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The words of some of the texts at a time, and how many each of these has."""
    if pattern == CLASS_PATTERN:
        cut = class_words
    else:
        cut = functools.partial(pattern_words, regex.compile(pattern))
    for start, stop in _spans(_lengths(texts), _CHUNK):
        yield cut(texts[start:stop].to_pylist())


# --- documents in blocks ---------------------------------------------------


@dataclass(frozen=True)
class Words:
    """Words with their merges done; a table of ``words`` and ``ids`` as Arrow bytes."""

    table: bytes

    @cached_property
    def columns(self) -> tuple[pa.Array, pa.Array]:
        table = pa.ipc.open_stream(self.table).read_all()
        words, ids = (pa.concat_arrays(table[name].chunks) if table.num_rows else None for name in ("words", "ids"))
        if words is None:
            return pa.array([], pa.string()), pa.array([], pa.list_(pa.int32()))
        return words.cast(pa.string()), ids.cast(pa.list_(pa.int32()))


def _byte_lists(words: pa.Array, ranks: Ranks) -> pa.Array:
    """The ids of the bytes of each word."""
    if not len(words):
        return pa.array([], pa.list_(pa.int32()))
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
    return pa.ListArray.from_arrays(pa.array(offsets - offsets[0]), pa.array(ranks.byte_ids[data]))


def _one(values: pa.Array) -> pa.Array:
    """An array of one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def repeated_words(
    docs: DataFrame, text: str, pattern: str, size: int, long: int, most: int
) -> DataFrame:
    """Words that occur in two blocks of documents or more, ``most`` of them at most.

    Those in most blocks, by steps of a quarter power of two. All words of all documents
    are counted; each task sends a word once per block.
    """

    def once(seen: list[pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pc.unique(pa.concat_arrays(seen))], names=["word"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[pa.Array] = []
        held = 0
        for batch in batches:
            texts = batch["bpe__text"].cast(pa.string()).fill_null("")
            for start, stop in _spans(_lengths(texts), min(size, _CHUNK)):
                part = texts[start:stop]
                seen += [pc.unique(words) for words, _ in cut_texts(part, pattern)]
                held += int(_lengths(part).sum())
                if held >= size:
                    yield once(seen)
                    seen, held = [], 0
        if seen:
            yield once(seen)

    words = docs.select(F.col(text).alias("bpe__text")).mapInArrow(rows, "word string")
    step = F.floor(F.log2("n") * 4).cast("int")
    counts = words.where(F.octet_length("word") <= long).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts.where("n > 1").select("word", step.alias("step")), "bpe-words")
    chosen, total = None, 0
    # At most a few hundred steps exist.
    for row in counts.groupBy("step").count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > most:
            break
        chosen = row["step"]
    return counts.where(F.lit(False) if chosen is None else F.col("step") >= chosen).select("word")


def merged_words(words: DataFrame, ranks: Ranks, found: DataFrame) -> Words:
    """Fold each of the words once; the result is for all tasks, so bound their number."""

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = batch["word"].cast(pa.string())
            yield pa.RecordBatch.from_arrays([_one(said), _one(_byte_lists(said, ranks))], names=["words", "starts"])

    lists = words.mapInArrow(grouped, "words array<string>, starts array<array<int>>")
    folded = beside_arrays(lists, found).select(
        "words",
        of_arrays(lambda arrays: F.transform("starts", lambda w: folded_merges(w, arrays))).alias("ids"),
    )
    got = folded.toArrow()
    flat = pa.table({name: pa.chunked_array([c.flatten() for c in got[name].chunks], got[name].type.value_type) for name in got.column_names})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, flat.schema) as writer:
        writer.write_table(flat)
    return Words(sink.getvalue().to_pybytes())


def blocks(
    docs: DataFrame,
    text: str,
    keep: Sequence[str],
    ranks: Ranks,
    pattern: str,
    known: Words,
    size: int,
    long: int,
) -> DataFrame:
    """One row per block of documents of about ``size`` characters.

    ``words`` has the distinct words of the block as arrays of byte ids, and
    ``docs`` each document's kept columns with its words as places in that array.
    A block is never larger than an Arrow batch; one long document is a block of
    its own. Words that are pieces, known words and words above ``long`` bytes
    come with their merges done, in ``merged``.
    """
    kept = [docs.schema[name] for name in keep]
    ids, idss = T.ArrayType(T.IntegerType()), T.ArrayType(T.ArrayType(T.IntegerType()))
    of_doc = T.StructType([*kept, T.StructField("bpe__words", ids)])
    schema = T.StructType().add("words", idss).add("merged", idss).add("docs", T.ArrayType(of_doc))

    def by_heap(word: bytes) -> list[int]:
        return merged_by_heap(ranks.byte_ids[np.frombuffer(word, dtype=np.uint8)].tolist(), ranks.merges)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, (of_known, known_ids) = pa.array(ranks.pieces, pa.binary()), known.columns
        whole = pa.ListArray.from_arrays(
            pa.array(np.arange(len(pieces) + 1, dtype=np.int32)), pa.array(np.arange(len(pieces), dtype=np.int32))
        )
        done = pa.concat_arrays([whole, known_ids])

        def block(rows: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
            parts = list(cut_texts(texts, pattern))
            coded = pa.concat_arrays([words for words, _ in parts]).dictionary_encode()
            distinct, used = coded.dictionary, coded.indices.cast(pa.int32())
            offsets = np.concatenate(([0], np.cumsum(np.concatenate([n for _, n in parts])))).astype(np.int32)
            placed = pa.ListArray.from_arrays(pa.array(offsets), used)

            in_known = pc.add(pc.index_in(distinct, value_set=of_known), pa.scalar(len(pieces), pa.int32()))
            at = pc.coalesce(pc.index_in(distinct.cast(pa.binary()), value_set=pieces), in_known)
            slow = pc.and_(pc.is_null(at), pc.greater(pc.binary_length(distinct), long))
            merged = done
            if count := pc.sum(slow).as_py():
                lists = [by_heap(w.encode()) for w in distinct.filter(slow).to_pylist()]
                merged = pa.concat_arrays([done, pa.array(lists, pa.list_(pa.int32()))])
                at = pc.replace_with_mask(at, slow, pa.array(range(len(done), len(done) + count), pa.int32()))
            starts = _byte_lists(pc.if_else(pc.is_valid(at), "", distinct), ranks)
            names = [f.name for f in of_doc]
            said = pa.StructArray.from_arrays([*[rows[name] for name in keep], placed], names=names)
            arrays = [_one(starts), _one(merged.take(at)), _one(said)]
            return pa.RecordBatch.from_arrays(arrays, names=["words", "merged", "docs"])

        for batch in batches:
            texts = batch["bpe__text"].cast(pa.string()).fill_null("")
            for start, stop in _spans(_lengths(texts), size):
                yield block(batch.slice(start, stop - start), texts[start:stop])

    rows = docs.select(*[F.col(name) for name in keep], F.col(text).alias("bpe__text"))
    return rows.mapInArrow(cut, schema)


def encode(
    docs: DataFrame,
    ranks: Ranks,
    pattern: str,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    into: str = "ids",
    block_chars: int = 8_000_000,
    long_word: int = 512,
    most_known: int = 1 << 18,
) -> DataFrame:
    """The kept columns and ``into``, the ids of each whole text.

    ``pattern`` cuts the text into words and is expected to match all of it; the
    bytes of each word are merged by rank. Words of ``CLASS_PATTERN`` are found for
    whole columns from the classes of code points, those of other patterns by a scan. Words found in several blocks of documents,
    ``most_known`` of them at most, are folded once and given to all tasks. Then
    documents are taken in blocks within their task, each other distinct word of a
    block is folded there, and documents are put together from the results. No
    text is shuffled. Memory is that of a block and of the known words.

    Null texts are empty and have no ids; repeated rows stay. Columns not kept
    are dropped; a kept column named ``into`` is an error. Empty input gives no rows.
    """
    if into in keep:
        raise ValueError(f"{into} is also a kept column")
    # The map of pairs is not made on the driver, nor sent to the tasks; one that meets a
    # very long word makes it again.
    found = rank_arrays(docs.sparkSession, ranks)
    frequent = repeated_words(docs, text, pattern, block_chars, long_word, most_known)
    known = merged_words(frequent, ranks, found)

    def assembled(word_ids: Column) -> Column:
        return F.transform(
            "docs",
            lambda doc: F.struct(
                *[doc[name].alias(name) for name in keep],
                F.flatten(F.transform(doc["bpe__words"], lambda k: F.get(word_ids, k))).alias(into),
            ),
        )

    def of_words(arrays: Sequence[Column]) -> Column:
        return F.transform(
            "words", lambda w, k: F.coalesce(F.get("merged", k), folded_merges(w, arrays))
        )

    whole = blocks(docs, text, keep, ranks, pattern, known, block_chars, long_word)
    return beside_arrays(whole, found).select(F.inline(let(of_arrays(of_words), assembled)))


def little_endian(ids: Column, count: int) -> Column:
    """Ids as little-endian unsigned 32-bit numbers, one after the other."""
    table = F.split(F.lit(",".join(k.to_bytes(4, "little").hex() for k in range(count))), ",")
    return F.unhex(F.array_join(F.transform(ids, lambda k: F.get(table, k)), ""))


def decode(ids: Column, ranks: Ranks) -> Column:
    """The bytes that ids stand for: their pieces one after the other, binary.

    Null ids give null, no ids give no bytes; an id outside the vocabulary is
    an error.
    """
    table = F.split(F.lit(",".join(p.hex() for p in ranks.pieces)), ",")
    return F.unhex(F.array_join(F.transform(ids, lambda k: F.element_at(table, k + 1)), ""))
