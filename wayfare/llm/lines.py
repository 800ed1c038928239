"""Line deduplication by a join on deletion neighbourhoods."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import LOWER, UPPER, with_row_numbers
from wayfare.session import written

_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
_BASE = np.uint64(0x9E3779B97F4A7C15)
DOC = ["line__key", "line__hash"]


def line_words(line: bytes) -> list[bytes]:
    """The words of a line, A to Z in lower case."""
    return line.translate(_LOWERED).split()


def half_keys(ws: list[bytes]) -> list[int]:
    """Keys of which two lines one word apart share at least one.

    Such lines agree in the first half or in the second half of the shorter one, so
    each line gives its own halves and those it would have with a word less.
    """
    n = len(ws)
    heads = {n // 2, (n - 1) // 2}
    tails = {n - n // 2, n - 1 - (n - 1) // 2}
    keys = [xxhash.xxh64_intdigest(b" ".join(ws[:k]), 1) for k in sorted(heads)]
    keys += [xxhash.xxh64_intdigest(b" ".join(ws[n - k :]), 2) for k in sorted(tails)]
    return keys


def deletion_hashes(ws: list[bytes]) -> np.ndarray:
    """The hash of the words without each one in turn, and last of all of them.

    From running hashes of the beginnings and of the ends, in linear time.
    """
    words = np.array([xxhash.xxh64_intdigest(w, 3) for w in ws], dtype=np.uint64)
    n = len(words)
    power = np.full(n + 1, _BASE)
    power[0] = 1
    power = np.cumprod(power)  # modulo 2**64
    # head[k]: sum of words[i] * base**i below k; all of them moved on by one from k + 1.
    head = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * power[:n])))
    moved = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words[1:] * power[: n - 1])))
    without = head[:n] + (moved[n - 1] - moved) if n else np.zeros(0, np.uint64)
    return np.append(without, head[n])


def one_word_apart(left: list, right: list) -> bool:
    """Whether one insertion, removal or replacement of a word at most turns one into the other."""
    if abs(len(left) - len(right)) > 1:
        return False
    short = min(len(left), len(right))
    head = 0
    while head < short and left[head] == right[head]:
        head += 1
    tail = 0
    while tail < short - head and left[-1 - tail] == right[-1 - tail]:
        tail += 1
    return max(len(left), len(right)) - head - tail <= 1


# --- tasks in Python -------------------------------------------------------


def _lines_of(docs: DataFrame, key_type: str, min_words: int) -> DataFrame:
    """A row per line that has words: where it is and what it says, as hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                doc, number, form, halves = [], [], [], []
                for k, text in enumerate(part["line__text"]):
                    for at, line in enumerate((text.as_py() or "").encode().split(b"\n")):
                        if ws := line_words(line):
                            doc.append(k)
                            number.append(at)
                            form.append(xxhash.xxh3_128_digest(b" ".join(ws)))
                            halves.append(half_keys(ws) if len(ws) >= min_words else [])
                flat = np.array([h for hs in halves for h in hs], dtype=np.uint64).view(np.int64)
                offsets = np.concatenate(([0], np.cumsum([len(h) for h in halves]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part[DOC[0]].take(pa.array(doc, pa.int64())),
                        part[DOC[1]].take(pa.array(doc, pa.int64())),
                        pa.array(number, pa.int32()),
                        pa.array(form, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    ],
                    names=[*DOC, "line", "form", "halves"],
                )

    schema = f"{DOC[0]} {key_type}, {DOC[1]} bigint, line int, form binary, halves array<bigint>"
    return docs.mapInArrow(rows, schema)


def _said(wanted: DataFrame) -> DataFrame:
    """The normal form of the wanted lines of each text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks, said = [], []
            for text, lines in zip(batch["line__text"], batch["lines"]):
                parts = (text.as_py() or "").encode().split(b"\n")
                for wish in lines.as_py():
                    ranks.append(wish["rank"])
                    said.append(b" ".join(line_words(parts[wish["line"]])).decode())
            yield pa.RecordBatch.from_arrays([pa.array(ranks, pa.int64()), pa.array(said, pa.string())], names=["rank", "said"])

    return wanted.mapInArrow(rows, "rank bigint, said string")


def _variants(said: DataFrame) -> DataFrame:
    """The deletion neighbourhood of each line: hash and place; the line itself at -1."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                found = [deletion_hashes(s.as_py().encode().split(b" ")) for s in part["said"]]
                sizes = np.array([len(f) for f in found], dtype=np.int64)
                place = np.concatenate([np.append(np.arange(n - 1), -1) for n in sizes]) if len(sizes) else np.zeros(0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)),
                        pa.array(place.astype(np.int32)),
                        pa.array(np.repeat(part["rank"].to_numpy(), sizes)),
                    ],
                    names=["variant", "place", "rank"],
                )

    return said.mapInArrow(rows, "variant bigint, place int, rank bigint")


@F.pandas_udf(T.BooleanType())
def _apart(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([one_word_apart(a.split(" "), b.split(" ")) for a, b in zip(left, right)], dtype=bool)


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, dropped: pd.Series) -> pd.Series:
    def rest(text: str | None, lines) -> str | None:
        if text is None or lines is None or not len(lines):
            return text
        gone = set(lines)
        return "\n".join(line for k, line in enumerate(text.split("\n")) if k not in gone)

    return pd.Series([rest(t, d) for t, d in zip(texts, dropped)], dtype=object)


# --- the join --------------------------------------------------------------


def near_links(said: DataFrame) -> DataFrame:
    """Pairs ``later``, ``earlier`` of ranks whose lines are one word apart.

    Lines that give the same hash without their word at the same place differ by that
    word, all of them from each other: each is paired with the earliest only. A
    line without one word may be another whole line: these are paired too. So there
    are never more pairs than hashes, however many lines meet.
    """
    rows = _variants(said)
    met = rows.groupBy("variant").agg(F.min("rank").alias("a"), F.max("rank").alias("b"))
    met = met.where("a < b").select("variant")
    live = written(rows.join(met, "variant"), "line-variants")
    cut, whole = live.where("place >= 0"), live.where("place < 0")
    first = cut.groupBy("variant", "place").agg(F.min("rank").alias("earlier"))
    same_place = cut.join(first, ["variant", "place"]).select(F.col("rank").alias("later"), "earlier")
    # The same whole line is here once only, as lines are distinct.
    shorter = whole.select("variant", F.col("rank").alias("other"))
    longer = cut.join(shorter, "variant").select(
        F.greatest("rank", "other").alias("later"), F.least("rank", "other").alias("earlier")
    )
    pairs = same_place.unionAll(longer).where("later > earlier").distinct()
    texts = said.select(F.col("rank").alias("later"), F.col("said").alias("of_later"))
    other = said.select(F.col("rank").alias("earlier"), F.col("said").alias("of_earlier"))
    checked = pairs.join(texts, "later").join(other, "earlier")
    return checked.where(_apart("of_later", "of_earlier")).select("later", "earlier")


def judged_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """A row per line with words: its document, number, and ``exact`` or ``near`` or null."""
    key_type = docs.schema[DOC[0]].dataType.simpleString()
    lines = written(_lines_of(docs, key_type, min_words), "lines")
    order = F.struct(F.col(DOC[0]).isNull().alias("none"), *[F.col(c) for c in DOC], F.col("line"))
    forms = written(
        lines.groupBy("form").agg(F.min(order).alias("first"), F.first("halves").alias("halves")),
        "line-forms",
    )
    halves = forms.select("form", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half")
    maybe = halves.join(shared, "half").select("form").distinct()
    numbered, _ = with_row_numbers(
        forms.select("form", "first").join(maybe, "form"), [F.col("first"), F.col("form")], "rank", "line-ranks"
    )
    numbered = written(numbered, "line-ranks")
    wishes = numbered.groupBy(*[F.col(f"first.{c}").alias(c) for c in DOC]).agg(
        F.collect_list(F.struct(F.col("first.line").alias("line"), "rank")).alias("lines")
    )
    same = (docs[DOC[0]].eqNullSafe(wishes[DOC[0]])) & (docs[DOC[1]] == wishes[DOC[1]])
    # One plan at every size: a broadcast here would save the texts' shuffle on small
    # tables only.
    said = _said(docs.join(wishes.hint("merge"), same).select(docs["line__text"], "lines"))
    # Rows that repeat a document say the same.
    said = written(said.dropDuplicates(["rank"]), "line-texts")
    near = near_links(said).select(F.col("later").alias("rank")).distinct()
    near = numbered.join(near, "rank").select("form", F.lit(True).alias("near"))
    fate = forms.select("form", "first").join(near, "form", "left")
    verdict = F.when(F.col("near"), "near").when(order != F.col("first"), "exact")
    return lines.select(*DOC, "line", "form").join(fate, "form").select(*DOC, "line", verdict.alias("verdict"))


def dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_words: int = 8,
) -> DataFrame:
    """Keep the earliest of equal lines and of lines one word apart.

    Lines end at ``\\n``. Words are cut at ASCII white space and compared with A to
    Z in lower case. A line goes if an earlier line of any document has the same
    words, or, for lines of ``min_words`` words or more, if an earlier such line
    is one inserted, removed or replaced word away (also if that one goes itself
    for a still earlier line). Earlier is by ``key`` (null last), then a hash of the text, then
    the line's number. Lines without words stay.

    Adds ``n_lines`` (with words), ``n_exact`` and ``n_near`` (dropped), and
    ``kept_text``; columns of these names are replaced. Rows that repeat key and text
    are one document and get the same result. Null texts have no lines and
    stay null. Empty input gives no rows.

    Every line is a row of hashes. Equal lines meet once, lines that share no
    half with another line leave, and only the rest emits its
    deletion neighbourhood, in time linear in its length. Pairs are one per
    member of a neighbourhood, never all of a group.
    """
    results = ("n_lines", "n_exact", "n_near", "kept_text")
    docs = docs.drop(*results)
    own = docs.withColumns(
        {
            DOC[0]: F.col(key),
            DOC[1]: F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
            "line__text": F.col(text),
        }
    )
    judged = judged_lines(own.select(*DOC, "line__text"), min_words)
    # A repeated row has its lines in here as often, so count each line once.
    counts = judged.distinct().groupBy(*[F.col(c).alias(f"{c}_of") for c in DOC]).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("verdict") == "exact").alias("n_exact"),
        F.count_if(F.col("verdict") == "near").alias("n_near"),
        F.collect_list(F.when(F.col("verdict").isNotNull(), F.col("line"))).alias("line__dropped"),
    )
    same = F.col(DOC[0]).eqNullSafe(F.col(f"{DOC[0]}_of")) & (F.col(DOC[1]) == F.col(f"{DOC[1]}_of"))
    joined = own.join(counts, same, "left")

    def or_none(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("long").alias(name)

    return joined.select(
        *docs.columns,
        *[or_none(name) for name in results[:3]],
        _without("line__text", "line__dropped").alias("kept_text"),
    )
