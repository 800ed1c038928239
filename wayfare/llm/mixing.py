"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.session import written

BINS, PASSES = 4096, 3


def draw(seed: str, *columns: Column) -> Column:
    """A number in (0, 1) that depends on the seed and the given columns only."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)


def targets(
    sizes: DataFrame, source: str, size: str, shares: Sequence[int], most: int
) -> DataFrame:
    """One row per source: ``source``, ``size``, ``share``, ``target``.

    Sources in code-point order, null last, get ``shares`` over and over. All
    sizes together are shared by these weights; a target stops at ``most``
    times its source's size and the excess is shared out again until none is
    above. That fixed point is found without a loop: with the sources ordered
    by limit per share, the level is the first at which a source keeps below
    its limit. One row per source passes one task here.
    """
    named = sizes.select(F.col(source).alias("source"), F.col(size).cast("long").alias("size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    share = F.element_at(
        F.array(*[F.lit(int(s)) for s in shares]), ((rank - 1) % len(shares) + 1).cast("int")
    )
    ranked = named.withColumn("share", share.cast("long")).withColumn("limit", F.col("size") * most)
    by_level = Window.orderBy(F.col("limit") / F.col("share"), F.col("source").asc_nulls_last())
    before, whole = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    share_left = F.sum("share").over(whole) - F.coalesce(F.sum("share").over(before), F.lit(0))
    levelled = ranked.withColumn("level", left / share_left).withColumn("at", F.row_number().over(by_level))
    fits = F.when(F.col("share") * F.col("level") <= F.col("limit"), F.col("at"))
    return (
        levelled.withColumn("first", F.min(fits).over(whole))
        .withColumn("level", F.max(F.when(F.col("at") == F.col("first"), F.col("level"))).over(whole))
        .select(
            "source",
            "size",
            "share",
            F.when(F.col("at") < F.col("first"), F.col("limit").cast("double"))
            .otherwise(F.col("share") * F.col("level"))
            .alias("target"),
        )
    )


def rates(sums: DataFrame, aims: DataFrame, most: int) -> DataFrame:
    """One row per source with words of some weight: ``source``, ``rate``.

    Documents are expected ``min(most, rate * weight)`` times, and the rate is that at
    which these expectations together come to the target: what heavy documents cannot
    take above ``most`` is shared out among the lighter ones. As in `targets` without a loop:
    with the weights from above, the rate is the first at which the next weight
    keeps below ``most``; if none does, all are taken ``most`` times. ``sums`` has a row
    per source and weight, and those of one source pass one task here.
    """
    own = sums.where("weight > 0 AND size > 0").alias("s").join(aims.alias("t"), F.expr("s.source <=> t.source"))
    own = own.selectExpr("s.source", "s.weight", "s.size", "t.target")
    down = Window.partitionBy("source").orderBy(F.col("weight").desc())
    before = F.coalesce(F.sum("size").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(F.col("weight") * F.col("size")).over(down.rowsBetween(0, Window.unboundedFollowing))
    stepped = own.withColumn("rate", (F.col("target") - most * before) / rest)
    fits = F.when(F.col("rate") * F.col("weight") <= most, F.struct(-F.col("weight"), "rate"))
    return stepped.groupBy("source").agg(
        F.coalesce(F.min(fits)["rate"], most / F.min("weight")).alias("rate")
    )


def plan_mix(
    docs: DataFrame,
    source: str,
    size: str,
    chance: str,
    weight: str | None = None,
    shares: Sequence[int] = (1, 2, 3),
    most: int = 3,
) -> DataFrame:
    """What decides the mix: one row per source, for `apply_mix`.

    ``docs`` should be a narrow written table, as it is read several times. The
    sums of the sources give their targets and the certain copies. What then
    lacks is drawn in `PASSES` passes along the Pareto order: all but the last
    stop before the target, each going on with the documents that still fit,
    and the last stops where the target is nearest.

    No source is sorted as a whole. Words are added up per source and bin of
    the order, the bin in which the target lies is found, and only the rows of
    this bin (one in `BINS` of a source) are ranked.
    """
    own = _own(docs, size, weight)
    sums = written(
        own.groupBy(F.col(source).alias("source"), F.col("mix__weight").alias("weight")).agg(
            F.sum("mix__size").alias("size")
        ),
        "mix-sums",
    )
    sizes = sums.groupBy("source").agg(F.sum("size").alias("size"))
    aims = written(targets(sizes, "source", "size", shares, most), "mix-targets")
    rated = rates(sums, aims, most).alias("r")
    cuts = written(
        aims.alias("t").join(rated, F.expr("t.source <=> r.source"), "left").selectExpr(
            "t.source AS mix__source",
            "t.size AS source_size",
            "t.target AS target",
            "coalesce(r.rate, 0D) AS mix__rate",
            f"{int(most)} AS mix__most",
        ),
        "mix-aims",
    )
    for number in range(PASSES):
        cuts = written(_cut(_ranked(own, cuts, source, chance), cuts, number), "mix-cuts")
    return cuts


def _own(docs: DataFrame, size: str, weight: str | None) -> DataFrame:
    return docs.withColumns(
        {
            "mix__size": F.coalesce(F.col(size).cast("long"), F.lit(0)),
            "mix__weight": F.lit(1.0)
            if weight is None
            else F.coalesce(F.col(weight).cast("double"), F.lit(1.0)),
        }
    )


def _taken(passes: int) -> Column:
    """Whether one of the first passes takes the document once more."""
    found = F.lit(False)
    for number in range(passes):
        found |= F.coalesce(
            F.expr(
                # In a struct null comes before all numbers, so say that it has an order.
                "mix__order IS NOT NULL AND "
                f"mix__size <= mix__limit{number} AND struct(mix__order, mix__size) <= mix__cut{number}"
            ),
            F.lit(False),
        )
    return found


def _ranked(own: DataFrame, cuts: DataFrame, source: str, chance: str) -> DataFrame:
    """Documents with their source's row of ``cuts``, certain copies and order."""
    fraction = F.col("mix__expected") - F.floor("mix__expected")
    odds = F.col(chance) / (1 - F.col(chance))
    return (
        own.join(cuts, F.col(source).eqNullSafe(F.col("mix__source")))
        .withColumn(
            "mix__expected",
            F.least(F.col("mix__most").cast("double"), F.col("mix__rate") * F.col("mix__weight")),
        )
        .withColumn("mix__certain", F.floor("mix__expected"))
        .withColumn("mix__order", F.when(fraction > 0, odds * (1 - fraction) / fraction))
    )


def _cut(ranked: DataFrame, cuts: DataFrame, number: int) -> DataFrame:
    """Add what one pass takes to ``cuts``: ``mix__limit<n>`` and ``mix__cut<n>``."""
    last = number == PASSES - 1
    # The order brought to (0, 1), evenly spread where a source has one fraction.
    usual = F.greatest(F.least(F.col("mix__rate") % 1, F.lit(0.999)), F.lit(0.001))
    stretched = F.col("mix__order") * usual / (1 - usual)
    limit = F.lit(float("inf")) if not number else F.col("mix__lacks") * (2 if last else 1)
    open_ = ranked.where(F.col("mix__order").isNotNull() & ~_taken(number))
    if number:
        open_ = open_.where(F.col("mix__size") <= limit)
    else:
        certain = ranked.groupBy(F.col("mix__source").alias("mix__for")).agg(
            F.sum(F.col("mix__certain") * F.col("mix__size")).alias("mix__sure")
        )
        cuts = cuts.join(certain, F.expr("mix__source <=> mix__for"), "left").withColumn(
            "mix__lacks", F.col("target") - F.coalesce("mix__sure", F.lit(0))
        ).drop("mix__for", "mix__sure")
        cuts = written(cuts, "mix-lacks")
    open_ = open_.withColumn("mix__bin", F.floor(stretched / (1 + stretched) * BINS))
    bins = open_.groupBy(F.col("mix__source").alias("mix__for"), "mix__bin").agg(
        F.sum("mix__size").alias("words")
    )
    along = Window.partitionBy("mix__for").orderBy("mix__bin")
    lacks = cuts.select(F.col("mix__source").alias("mix__of"), "mix__lacks")
    edges = (
        bins.withColumn("until", F.sum("words").over(along))
        .join(lacks, F.expr("mix__for <=> mix__of"))
        .groupBy("mix__for")
        .agg(
            F.first("mix__lacks").alias("mix__left"),
            # The first bin that reaches the target, or one past the last.
            F.min(
                F.when(
                    F.col("until") >= F.col("mix__lacks"),
                    F.struct("mix__bin", (F.col("until") - F.col("words")).alias("before")),
                )
            ).alias("at"),
            F.max("mix__bin").alias("last"),
            F.sum("words").alias("mix__total"),
        )
        .selectExpr(
            "mix__for",
            "mix__left",
            "coalesce(at.mix__bin, last) AS mix__edge",
            "coalesce(at.before, 0) AS mix__before",
            # If all of them together lack something, all are taken.
            "IF(at IS NULL, mix__total, NULL) AS mix__all",
        )
    )
    edges = written(edges, "mix-edges")
    # Equal rows are one step; all of them are taken or none.
    steps = (
        open_.select("mix__source", "mix__bin", "mix__order", "mix__size")
        .join(edges, F.expr("mix__source <=> mix__for AND mix__bin = mix__edge"))
        .groupBy("mix__for", "mix__order", "mix__size", "mix__left", "mix__before", "mix__all")
        .agg(F.sum("mix__size").alias("words"))
    )
    within = Window.partitionBy("mix__for").orderBy("mix__order", "mix__size")
    until = F.col("mix__before") + F.sum("words").over(within)
    steps = steps.withColumn("until", until)
    fits = "2 * until - words <= 2 * mix__left" if last else "until <= mix__left"
    at_edge = steps.groupBy("mix__for").agg(
        F.max(F.when(F.expr(f"mix__all IS NOT NULL OR {fits}"), F.struct("mix__order", "mix__size", "until"))).alias("at"),
        F.min(F.struct("mix__order", "mix__size")).alias("start"),
        F.first("mix__before").alias("before"),
        F.first("mix__all").alias("mix__all"),
    )
    # Without a fitting row at the edge, the pass takes what lies before its first.
    found = at_edge.selectExpr(
        "mix__for",
        """IF(at IS NULL, struct(start.mix__order AS mix__order, CAST(-1 AS BIGINT) AS mix__size),
           struct(at.mix__order AS mix__order, at.mix__size AS mix__size)) AS cut""",
        "coalesce(mix__all, at.until, before) AS used",
    )
    return (
        cuts.join(found, F.expr("mix__source <=> mix__for"), "left")
        .withColumn(f"mix__limit{number}", limit.cast("double"))
        .withColumn(f"mix__cut{number}", F.col("cut"))
        .withColumn("mix__lacks", F.col("mix__lacks") - F.coalesce("used", F.lit(0)))
        .drop("mix__for", "cut", "used")
    )


def apply_mix(
    docs: DataFrame,
    cuts: DataFrame,
    source: str,
    size: str,
    chance: str,
    weight: str | None = None,
) -> DataFrame:
    """How often each document is taken so that sources meet their targets.

    Adds ``source_size``, ``target``, ``copies`` and ``taken`` (copies times
    size). A document is expected ``e = min(most, rate * weight)`` times, at the rate
    of `rates`, and gets ``floor(e)`` certain copies. The rest is
    Pareto order sampling: documents in the order of the odds of ``chance`` (a
    number in (0, 1), the same in each run) divided by the odds of their
    fraction ``e - floor(e)`` get one more, as far as the cuts go.

    Each row is compared with its source's row of ``cuts``; nothing is sorted.
    Null sizes count as 0, null weights as 1, null sources are one source.
    Equal rows are all taken or all left. Empty input gives no rows. Columns
    with the names of the results are replaced.
    """
    docs = docs.drop("source_size", "target", "copies", "taken")
    copies = F.col("mix__certain") + F.when(_taken(PASSES), 1).otherwise(0)
    return (
        _ranked(_own(docs, size, weight), cuts, source, chance)
        .withColumn("copies", copies.cast("long"))
        .withColumn("taken", F.col("copies") * F.col("mix__size"))
        .select(*docs.columns, "source_size", "target", "copies", "taken")
    )
