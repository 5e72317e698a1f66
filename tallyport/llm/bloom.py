"""Blocked Bloom filter built and probed with DataFrame functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# A block is four longs; one key sets one bit in each of them.
WORDS = 4
BITS_PER_KEY = 16
# Upper bound of the blocks of a filter (a block takes 40 bytes with its number): 40 MB.
MAX_BLOCKS = 1 << 20


class BlockedBloom:
    """A filter over the values of one expression.

    The number of blocks follows the number of keys up to `MAX_BLOCKS`, which bounds what is
    broadcast; beyond it more keys pass in error, and the exact join that follows still
    removes them. A key touches one block only. Null is a key like any other.
    """

    def __init__(self, keys: DataFrame, key: Column, max_blocks: int = MAX_BLOCKS):
        hashed = keys.select(F.xxhash64(key).alias("h"))
        n = keys.count()
        self.blocks = max(1, min(max_blocks, n * BITS_PER_KEY // (64 * WORDS) + 1))
        bits = hashed.select(self._block(F.col("h")).alias("block"), *self._masks(F.col("h")))
        self.table = bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])

    def _block(self, h: Column) -> Column:
        return F.pmod(h, F.lit(self.blocks)).cast("int")

    @staticmethod
    def _masks(h: Column) -> list[Column]:
        again = F.xxhash64(h)
        return [
            F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(again, 6 * i).bitwiseAND(63).cast("int")).alias(f"w{i}")
            for i in range(WORDS)
        ]

    def pass_through(self, df: DataFrame, key: Column) -> DataFrame:
        """Rows of `df` whose key may be in the filter."""
        return self.marked(df, key, "__hit").where("__hit").drop("__hit")

    def marked(self, df: DataFrame, key: Column, out: str) -> DataFrame:
        """Adds `out`: whether the key may be in the filter."""
        probe = df.withColumn("__h", F.xxhash64(key)).withColumn("__block", self._block(F.col("__h")))
        blocks = F.broadcast(self.table.select(F.col("block").alias("__b"), *[F.col(f"w{i}").alias(f"__w{i}") for i in range(WORDS)]))
        joined = probe.join(blocks, F.col("__block") == F.col("__b"), "left")
        # a missing block has no key
        hit = reduce(
            Column.__and__,
            [F.col(f"__w{i}").bitwiseAND(mask) != 0 for i, mask in enumerate(self._masks(F.col("__h")))],
        )
        own = [f"__w{i}" for i in range(WORDS)]
        return joined.withColumn(out, F.coalesce(hit, F.lit(False))).drop("__h", "__block", "__b", *own)
