"""What each of a set of filters takes, in every order of applying them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import words
from wayfare.session import scratch_path, settings, written

#: The filter that looks at the whole table and not at one text; see `failures`.
REPEATED = "E"


def failures(text: Column) -> dict[str, Column]:
    """The conditions under which a text fails; null is empty.

    All but `REPEATED`, which needs the table.
    """
    text = F.coalesce(text, F.lit(""))
    said = words(text)
    upper = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    return {
        "A": F.size(said) < 50,
        "B": 100 * F.size(F.array_distinct(said)) < 65 * F.size(said),
        "C": 100 * upper > 5 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def judged(docs: DataFrame, labels: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """One row per document: ``part``, ``mask`` of the filters it fails, ``good``, ``toxic``.

    The texts are read once; what is written and shuffled is a digest and some
    numbers per document. A text fails as repeated if a smaller key has the same;
    null keys are neither smaller nor larger than any.
    """
    found = failures(F.col(text))
    bits = [F.when(fails, F.lit(1 << k)).otherwise(F.lit(0)) for k, fails in enumerate(found.values())]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    seen = written(
        docs.select(
            F.col(key).alias("key"),
            F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
            mask.alias("mask"),
            F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("said"),
        ),
        "filter-masks",
    )
    # One row per text that occurs under two keys, so a hot text meets one row.
    first = seen.groupBy("said").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    first = first.where("first < last").select("said", "first")
    marks = labels.groupBy(F.col(key).alias("key")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    again = F.when(F.col("key") > F.col("first"), F.lit(1 << len(found))).otherwise(F.lit(0))
    return (
        seen.join(first, "said", "left")
        .join(marks, "key", "left")
        .select(
            "part",
            F.col("mask").bitwiseOR(again).alias("mask"),
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
        )
    )


def mask_cells(masks: DataFrame) -> DataFrame:
    """One row per part: ``cells``, the counts of its masks.

    The masks are combined where they are read, so a part of any size is a row
    per mask of a task; a part has at most two to the number of filters of them.
    """
    counted = masks.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("good").alias("good"),
        F.count_if("toxic").alias("toxic"),
    )
    return counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))


def _total(name: str, condition: str) -> str:
    return f"aggregate(filter(cells, c -> {condition}), 0L, (t, c) -> t + c.{name})"


def _walk(letters: str) -> str:
    """Prefixes of all orders, each with the metrics of its last step.

    A prefix grows by each letter it has not used, meets the cells of its part and
    carries the bits applied so far. A level of the recursion is a step.
    """
    filters = ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << k})" for k, x in enumerate(letters))
    fails, passed, gone = "(c.mask & f.bit) <> 0", "(c.mask & applied) = 0", "(c.mask & applied) <> 0"
    return f"""
    WITH RECURSIVE walk (part, prefix, applied, unused, step, letter,
        kept, removed, redundant, unique_fails, good_lost, toxic_lost) AS (
      SELECT part, '', 0, array({filters}), 0, '', 0L, 0L, 0L, 0L, 0L, 0L FROM {{cells}}
      UNION ALL
      SELECT before.part, concat(prefix, f.letter), applied | f.bit,
        filter(unused, u -> u.bit <> f.bit), step + 1, f.letter,
        {_total("n", f"{passed} AND NOT {fails}")},
        {_total("n", f"{passed} AND {fails}")},
        {_total("n", f"{gone} AND {fails}")},
        {_total("n", "c.mask = f.bit")},
        {_total("good", f"{passed} AND {fails}")},
        {_total("toxic", f"{passed} AND {fails}")}
      FROM (SELECT part, prefix, applied, unused, step, explode(unused) AS f FROM walk) before
      JOIN {{cells}} cells ON cells.part = before.part)
    SELECT part, prefix, step, letter, kept, removed, redundant, unique_fails, good_lost, toxic_lost
    FROM walk WHERE step > 0"""


def steps(cells: DataFrame, letters: str) -> DataFrame:
    """The metrics of each prefix of each order of ``letters``, by part.

    A recursive query; a level has a row per part and prefix of its length, so the
    limit on rows, which is not for this, is lifted while it runs. The result is
    written, as the query reads ``cells`` at each level.
    """
    spark = cells.sparkSession
    path = scratch_path(spark, "filter-steps")
    with settings(spark, {"spark.sql.cteRecursionRowLimit": "-1"}):
        found = spark.sql(_walk(letters), cells=cells)
        found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def in_all_orders(prefixes: DataFrame, letters: str) -> DataFrame:
    """Each order of ``letters`` with its steps, and each letter's sum over all orders.

    A prefix of ``s`` letters is the start of the orders that go on with the others,
    ``(n - s)!`` of them. ``shapley`` weighs what a prefix removes by that number.
    """
    n = len(letters)
    weight = F.element_at(F.array(*[F.lit(math.factorial(n - s)) for s in range(1, n + 1)]), F.col("step"))
    shares = prefixes.groupBy("part", "letter").agg(
        F.sum(F.col("removed") * weight.cast("long")).alias("shapley")
    )
    whole = prefixes.where(F.col("step") == n).select(
        "part",
        F.col("prefix").alias("filter_order"),
        F.posexplode(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda s: F.left("prefix", s))).alias("at", "prefix"),
    )
    return whole.drop("at").join(prefixes, ["part", "prefix"]).join(shares, ["part", "letter"])


def audit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """One row per ``part``, ``filter_order`` and ``step``: what that step's filter did.

    The filters are those of `failures` and then `REPEATED`, five letters and so
    120 orders of five steps for each value of the column ``part`` (a null counts as
    an empty string). ``kept`` documents pass all filters up to this one; ``removed``
    passed those before and fail this one; ``redundant`` fail this one but are gone
    already; ``unique_fails`` fail this one and no other. ``good_lost`` and
    ``toxic_lost`` are the removed with a label of quality or toxicity 1 (any
    label of the key counts). ``shapley`` is what the filter removes, summed over all orders.

    Every row of ``docs`` counts, repeated rows too: they have one key and so do not
    make each other repeated. Null texts are empty and fail as too short. A null key has no labels. Only the
    columns named are read, so others may have any name. No documents, no rows.
    """
    letters = "".join(failures(F.col(text))) + REPEATED
    cells = written(mask_cells(judged(docs, labels, key, text, part)), "filter-cells")
    found = in_all_orders(steps(cells, letters), letters)
    return found.select(
        "part", "filter_order", "step", "kept", "removed", "redundant",
        "unique_fails", "good_lost", "toxic_lost", "shapley",
    )
