"""Connected components of a graph that may be larger than any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.session import written


def _pairs(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return _pairs(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    across = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _pairs(across.unionAll(least.select("a", F.col("m").alias("b"))))


def stars(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """Each node ``a`` of an undirected graph with the least node ``b`` it reaches.

    ``edges`` has columns ``a`` and ``b`` of one sortable type. Large and small
    stars alternate until nothing changes; each round is written to the shared
    folder. The least node of a component itself is not among ``a``. A node with
    very many neighbours is split by adaptive execution, as one side of the
    join has one row per node.
    """

    def state(table: DataFrame) -> tuple:
        return tuple(table.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = written(_pairs(edges.select("a", "b")), "edges")
    before = None
    for _ in range(most_rounds):
        if (found := state(now)) == before or not found[0]:
            return now
        before = found
        now = written(_small_star(_large_star(now)), "stars")
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")
