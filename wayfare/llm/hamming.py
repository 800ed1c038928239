"""Exact nearest binary codes by multi-index hashing."""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.session import written

WORD = 64


def sign_code(vector: Column, dimensions: int) -> Column:
    """The signs of a vector as an array of 64-bit words: bit 1 where positive.

    Missing, null and NaN components count as not positive. Null gives null.
    """

    def word(start: int) -> Column:
        def bit(k: int) -> Column:
            x = F.get(vector, k)
            value = 1 << (k - start) if k - start < WORD - 1 else -(1 << (WORD - 1))
            return F.when((x > 0) & ~F.isnan(x), F.lit(value)).otherwise(0)

        ends = range(start, min(start + WORD, dimensions))
        return reduce(lambda a, b: a.bitwiseOR(b), [bit(k).cast("long") for k in ends])

    words = F.array(*[word(start) for start in range(0, dimensions, WORD)])
    return F.when(vector.isNotNull(), words)


def distance(left: Column, right: Column, words: int) -> Column:
    bits = [F.bit_count(F.get(left, k).bitwiseXOR(F.get(right, k))) for k in range(words)]
    return reduce(lambda a, b: a + b, bits)


def segments(code: Column, words: int, bits: int) -> Column:
    """The segments of a code: an array of segment number and value."""
    mask, per_word = (1 << bits) - 1, WORD // bits
    return F.array(
        *[
            F.struct(
                F.lit(number).alias("segment"),
                F.shiftrightunsigned(F.get(code, number // per_word), bits * (number % per_word))
                .bitwiseAND(F.lit(mask))
                .cast("int")
                .alias("value"),
            )
            for number in range(words * per_word)
        ]
    )


def flips(bits: int, radius: int) -> Column:
    """All masks of ``bits`` bits of which ``radius`` are set, as a literal array."""
    masks = [sum(1 << b for b in chosen) for chosen in itertools.combinations(range(bits), radius)]
    return F.split(F.lit(",".join(map(str, masks))), ",").cast("array<int>")


def search(
    index: DataFrame,
    queries: DataFrame,
    key: str,
    code: str,
    k: int,
    words: int = 1,
    bits: int = 16,
) -> DataFrame:
    """The ``k`` nearest rows of ``index`` for each row of ``queries``, exactly.

    Returns ``query`` (the query's key), ``rank`` from 1, ``neighbour`` (the
    row's key) and ``distance``, ordered by distance, then key. A query that is
    itself in the index finds itself.

    Codes are cut into segments of ``bits`` bits; two codes within distance
    ``m * (r + 1) - 1`` agree up to ``r`` bits in one of ``m`` segments at least. In
    round ``r`` the values at ``r`` bits from a query's segments are looked up by an
    equi-join and what is found is measured in full. A query is done when its
    ``k``-th distance is covered so; only the others go on. The last round covers
    every code, so the result is exact whatever the data.

    Equal codes are indexed once with their ``k`` least keys, so copies neither fill a
    bucket nor lengthen a result list. Equal queries are searched once. Rows with a
    null code are not found and find nothing; fewer than ``k`` rows give as
    many results; repeated keys are results of their own. Null keys come first.
    """
    rows = index.where(F.col(code).isNotNull()).select(F.col(code).alias("code"), F.col(key).alias("id"))
    by_key = Window.partitionBy("code").orderBy(F.col("id").asc_nulls_first())
    ids = written(rows.withColumn("nth", F.row_number().over(by_key)).where(F.col("nth") <= k), "code-ids")
    held = ids.count()
    if WORD % bits or bits > 16:
        raise ValueError("segments must fill a word and have 16 bits at most")
    m = words * (WORD // bits)
    codes = ids.groupBy("code").agg(F.max("nth").alias("copies"), F.min("id").alias("least"))
    codes = codes.withColumn("at", F.explode(segments(F.col("code"), words, bits)))
    table = written(codes.select("code", "copies", "least", "at.*"), "code-index")
    need = min(k, held)
    asked = queries.where(F.col(code).isNotNull()).select(F.col(code).alias("asked"), F.col(key).alias("query"))
    # What is still searched: a query's code and its best distance so far.
    going = written(asked.select("asked").distinct().withColumn("bound", F.lit(words * WORD)), "asked")
    best = None
    done: list[DataFrame] = []
    near = Window.partitionBy("asked").orderBy("distance", F.col("least").asc_nulls_first())
    for radius in range(bits + 1):
        if not need:
            break
        # Few rows that become many: a number of partitions that is not merged.
        dealt = going.repartition(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), "asked")
        probes = dealt.select("asked", "bound", F.explode(segments(F.col("asked"), words, bits)).alias("at"))
        flipped = probes.withColumn("flip", F.explode(flips(bits, radius))).select(
            "asked", "bound", "at.segment", F.col("at.value").bitwiseXOR(F.col("flip")).alias("value")
        )
        met = (
            # The planner cannot know how much the flips multiply the probes, so
            # it must not take them for small and broadcast them.
            flipped.hint("merge").join(table, ["segment", "value"])
            .withColumn("distance", distance(F.col("asked"), F.col("code"), words))
            .where("distance <= bound")
            .groupBy("asked", "code")
            .agg(F.first("distance").alias("distance"), F.first("copies").alias("copies"), F.first("least").alias("least"))
        )
        if best is not None:
            met = met.unionByName(best).dropDuplicates(["asked", "code"])
        ranked = met.withColumn("nth", F.row_number().over(near)).where(F.col("nth") <= k)
        ranked = ranked.withColumn("sum", F.sum("copies").over(near.rowsBetween(Window.unboundedPreceding, 0)))
        state = written(ranked.drop("nth"), "nearest")
        reached = state.where(F.col("sum") >= need).groupBy("asked").agg(F.min("distance").alias("bound"))
        reached = going.select("asked").join(reached, "asked", "left")
        reached = written(reached.withColumn("bound", F.coalesce("bound", F.lit(words * WORD))), "bounds")
        covered = F.lit(m * (radius + 1) - 1) if radius < bits else F.lit(words * WORD)
        finished = reached.where(F.col("bound") <= covered).select("asked")
        done.append(state.join(finished, "asked").select("asked", "code", "distance"))
        going = reached.where(F.col("bound") > covered)
        best = state.drop("sum").join(going.select("asked"), "asked")
        if going.isEmpty():
            break
    if not done:  # nothing to find
        done.append(asked.where("false").selectExpr("asked", "asked AS code", "0 AS distance"))
    found = reduce(DataFrame.unionByName, done)
    last = Window.partitionBy("asked").orderBy("distance", F.col("id").asc_nulls_first(), "nth")
    listed = (
        found.join(ids, "code")
        .withColumn("rank", F.row_number().over(last))
        .where(F.col("rank") <= k)
    )
    return asked.join(listed, "asked").select("query", "rank", F.col("id").alias("neighbour"), "distance")
