"""Document quality by a table of thresholds, as one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import SPACES, let, words

SYMBOLS = "#*$%&|<>"  # fixed by the contract

# Frequent words of English, French, Spanish and German.
STOP_WORDS = tuple(
    """the of and to in is that for it as was with be by on not are this at from or
    le la les de des du et en un une est que qui dans pour au aux pas sur
    el los las del y por con una para se al como
    der die das und ist den von zu mit ein eine dem sich auf im nicht es""".split()
)


@dataclass(frozen=True)
class Threshold:
    """``least <= above / below <= most``, for texts of at least ``words`` words."""

    name: str
    above: str
    below: str
    least: float | None = None
    most: float | None = None
    words: int = 0


THRESHOLDS = (
    Threshold("word_length", "word_chars", "n_words", least=2.0, most=15.0),
    Threshold("symbols", "n_symbols", "n_words", most=0.1),
    Threshold("exclamations", "n_exclamations", "n_words", most=0.3),
    Threshold("stop_words", "n_stop_words", "n_words", least=0.03, words=50),
    Threshold("same_word_again", "n_same_word", "n_words", most=0.2),
    Threshold("same_line_again", "n_dup_lines", "n_lines", most=0.5),
)


def repeated_words(ws: Column, window: int = 5) -> Column:
    """How many of the words ``ws`` lie in a window of words found twice or more.

    Windows are compared by 64-bit hashes within one text. Only a text that
    has a repeated window is looked at position by position, by sorting.
    """

    def covered(grams: Column) -> Column:
        def positions(found: Column) -> Column:
            here = F.filter(
                found,
                lambda x, k: F.coalesce(F.get(found, k - 1)["hash"] == x["hash"], F.lit(False))
                | F.coalesce(F.get(found, k + 1)["hash"] == x["hash"], F.lit(False)),
            )
            return F.sort_array(F.transform(here, lambda x: x["at"]))

        ordered = F.sort_array(
            F.transform(grams, lambda h, k: F.struct(h.alias("hash"), k.alias("at")))
        )
        return let(
            let(ordered, positions),
            lambda at: F.aggregate(
                F.transform(
                    at,
                    lambda p, k: F.coalesce(
                        F.least(F.get(at, k + 1) - p, F.lit(window)), F.lit(window)
                    ).cast("long"),
                ),
                F.lit(0).cast("long"),
                lambda total, n: total + n,
            ),
        )

    grams = F.transform(
        F.sequence(F.lit(0), F.size(ws) - window),
        lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(window)]),
    )
    none = F.lit(0).cast("long")
    return F.when(F.size(ws) <= window, none).otherwise(
        let(
            grams,
            lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), none).otherwise(covered(g)),
        )
    )


def _count(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def measures(text: Column, but: Sequence[str] = ()) -> Column:
    """A struct of counts of one text, all ``but`` those named; null counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def of(ws: Column, lines: Column) -> Column:
        stripped = F.filter(
            ws, lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?")).isin(*STOP_WORDS)
        )
        counts = {
            "n_words": F.size(ws),
            "word_chars": F.length(F.translate(text, SPACES, "")),
            "n_symbols": _count(text, SYMBOLS),
            "n_exclamations": _count(text, "!"),
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": repeated_words(ws),
            "n_stop_words": F.size(stripped),
            "n_same_word": F.size(F.filter(ws, lambda w, k: F.coalesce(F.get(ws, k - 1) == w, F.lit(False)))),
        }
        return F.struct(*[n.cast("long").alias(name) for name, n in counts.items() if name not in but])

    lines = F.filter(
        F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(SPACES))) > 0
    )
    return let(words(text), lambda ws: let(lines, lambda ls: of(ws, ls)))


def passes(found: Column, table: Sequence[Threshold] = THRESHOLDS) -> Column:
    """Whether the counts ``found`` are within all thresholds of the table.

    Compiled to products (no division), so a text without words or lines has
    every ratio's upper bound met and its lower bound met too.
    """
    verdict = F.lit(True)
    for rule in table:
        above, below = found[rule.above], found[rule.below]
        holds = F.lit(True)
        if rule.least is not None:
            holds &= above >= F.lit(rule.least) * below
        if rule.most is not None:
            holds &= above <= F.lit(rule.most) * below
        verdict &= (found["n_words"] < rule.words) | holds
    return verdict


def base_failed(found: Column) -> Column:
    """Too short, or more than a fifth of the words repeated."""
    return (found["n_words"] < 10) | (100 * found["n_repeat_words"] > 20 * found["n_words"])


def judge(
    docs: DataFrame,
    text: str = "text",
    table: Sequence[Threshold] = THRESHOLDS,
    into: str = "quality",
) -> DataFrame:
    """Add ``into``: a struct of the counts of each text, ``base_failed`` and ``kept``.

    One projection, no shuffle, JVM functions only. A null text counts as
    empty and fails the base rule. Each row is judged for itself, so repeated
    rows agree and an empty table stays empty. Other columns are untouched;
    a column already named ``into`` is replaced.
    """
    column = let(
        measures(F.col(text)),
        lambda m: F.struct(
            *[m[name].alias(name) for name in MEASURES],
            base_failed(m).alias("base_failed"),
            (~base_failed(m) & passes(m, table)).alias("kept"),
        ),
    )
    return docs.withColumn(into, column)


MEASURES = (
    "n_words word_chars n_symbols n_exclamations n_lines n_dup_lines n_repeat_words "
    "n_stop_words n_same_word"
).split()
