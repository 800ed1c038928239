"""Shuffled shards from a keyed permutation of global row numbers."""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import with_row_numbers


@dataclass(frozen=True)
class Permutation:
    """A permutation of 0 .. ``size`` - 1 that depends on ``seed`` only.

    A Feistel network permutes the next even number of bits; a number that
    lands at ``size`` or above goes through it again (cycle walking) until it
    falls below. Either way takes about four turns at most on average, needs no
    table, and is the same on every machine.
    """

    size: int
    seed: int = 0
    rounds: int = 8

    @property
    def half(self) -> int:
        return max(1, (max(self.size - 1, 1).bit_length() + 1) // 2)

    def _keys(self) -> list[tuple[int, int]]:
        draw = random.Random(f"{self.seed}/{self.rounds}")
        # Below 2**31, so that products of halves stay below 2**62.
        return [(draw.getrandbits(31), draw.getrandbits(31) | 1) for _ in range(self.rounds)]

    def _mixed(self, half: np.ndarray, key: tuple[int, int]) -> np.ndarray:
        low = (1 << 31) - 1
        x = (half ^ (key[0] & low)) * key[1]
        x = (x ^ (x >> 29)) & low
        x = x * 1540483477
        return (x >> 27) & ((1 << self.half) - 1)

    def _walk(self, numbers, keys: list, swap: bool) -> np.ndarray:
        out = np.array(numbers, dtype=np.int64)
        if out.size and (out.min() < 0 or out.max() >= self.size):
            raise ValueError(f"a number is outside 0 .. {self.size - 1}")
        mask, left = (1 << self.half) - 1, np.ones(out.shape, dtype=bool)
        while left.any():
            high, low = out[left] >> self.half, out[left] & mask
            for key in keys:
                if swap:
                    high, low = low ^ self._mixed(high, key), high
                else:
                    high, low = low, high ^ self._mixed(low, key)
            out[left] = (high << self.half) | low
            left[left] = out[left] >= self.size
        return out

    def position(self, numbers) -> np.ndarray:
        """Where each row number goes."""
        return self._walk(numbers, self._keys(), swap=False)

    def number(self, positions) -> np.ndarray:
        """Which row number is at each position: the way back."""
        return self._walk(positions, self._keys()[::-1], swap=True)


def with_shards(
    rows: DataFrame, order: Sequence[Column], shards: int, seed: int = 0
) -> DataFrame:
    """Deal ``rows`` into ``shards`` shuffled shards; adds ``shard`` and ``slot``.

    Row number ``i`` along ``order`` goes to position ``p`` of a Feistel
    permutation, shard ``p % shards``, slot ``p // shards``: shard sizes are at
    most one apart, slots have no gap, and both can be computed for any row
    number without reading anything (and back, by `Permutation.number`).

    Rows that tie in ``order`` are numbered in any order; give enough columns
    that only equal rows tie. Nulls sort where ``order`` says. Empty input
    gives no rows. Existing columns ``shard`` and ``slot`` are replaced.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    number = "shard__number"
    numbered, total = with_row_numbers(rows.drop("shard", "slot"), order, number, "shards")
    permutation = Permutation(max(total, 1), seed)

    @F.pandas_udf("long")
    def position(numbers: pd.Series) -> pd.Series:
        return pd.Series(permutation.position(numbers.to_numpy()))

    return (
        numbered.withColumn(number, position(number))
        .withColumn("shard", F.expr(f"CAST({number} % {shards} AS INT)"))
        .withColumn("slot", F.expr(f"{number} DIV {shards}"))
        .drop(number)
    )


def write_shards(placed: DataFrame, path: str, shards: int, rows_per_file: int = 1_000_000) -> None:
    """Write one folder per shard, rows in slot order.

    A shard larger than ``rows_per_file`` is written by several tasks, each
    taking a run of slots.
    """
    (
        placed.withColumn("run", F.expr(f"slot DIV {rows_per_file}"))
        .repartition(F.col("shard"), F.col("run"))
        .sortWithinPartitions("shard", "run", "slot")
        .drop("run")
        .write.partitionBy("shard")
        .parquet(path)
    )
