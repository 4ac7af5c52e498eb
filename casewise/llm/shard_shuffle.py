"""Sharding: a seeded shuffle of all rows with a computable shard and slot.

Rows are numbered 0 to n-1 over the whole table. A Feistel network with cycle walking permutes these
numbers, so the place of a row follows from its number, n and the seed alone, and the number at a
place follows by running the network backwards. Place p goes to shard p mod S, slot p div S: shards
differ by one row at most and their slots have no gaps.

Numbering is by content, so it does not depend on files, partitions or retries: rows are dealt into
about sqrt(n) buckets by hash, ordered inside a bucket, and the counts of the buckets before are
added. Equal rows are counted before they are shuffled, so a row that fills a third of the table is
one row per task.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from casewise.llm.frames import counted_out, root_buckets

ROUNDS = 6


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Permutation:
    """A seeded permutation of 0..n-1."""

    def __init__(self, n: int, seed: int):
        self.n = np.uint64(max(1, n))
        self.half = np.uint64(max(1, -(-(max(1, n) - 1).bit_length() // 2)))
        self.mask = (np.uint64(1) << self.half) - np.uint64(1)
        with np.errstate(over="ignore"):
            self.keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))

    def _once(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in keys:
            if back:
                left, right = right ^ (_mix(left ^ key) & self.mask), left
            else:
                left, right = right, left ^ (_mix(right ^ key) & self.mask)
        return (left << self.half) | right

    def _walk(self, numbers, keys: np.ndarray, back: bool) -> np.ndarray:
        out = self._once(np.asarray(numbers).astype(np.uint64), keys, back)
        outside = np.flatnonzero(out >= self.n)
        while len(outside):  # the cycle of a number inside leads back inside
            out[outside] = self._once(out[outside], keys, back)
            outside = outside[out[outside] >= self.n]
        return out.astype(np.int64)

    def place(self, numbers) -> np.ndarray:
        return self._walk(numbers, self.keys, back=False)

    def number(self, places) -> np.ndarray:
        """The inverse of :meth:`place`."""
        return self._walk(places, self.keys[::-1], back=True)


def shuffle_into_shards(rows: DataFrame, shards: int, seed: int = 0, total: int | None = None) -> DataFrame:
    """Columns of ``rows`` with ``row_number``, ``shard`` and ``slot``; one row for every row.

    Equal rows are interchangeable, so pass the columns that name a row and leave wide payload out.
    Any column may be null; an empty table gives an empty one. ``total`` is the row count if known.
    Columns of the three names in ``rows`` are replaced.
    """
    rows = rows.drop("row_number", "shard", "slot")
    total = rows.count() if total is None else total
    buckets = root_buckets(total)
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    counted = packed.groupBy("row").agg(F.count("*").alias("copies")).withColumn(
        "bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int")
    )
    sizes = counted.groupBy("bucket").agg(F.sum("copies").alias("size"))
    # one row per bucket: about sqrt(n) of them, 32,768 for a billion rows
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("bucket").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("copies").over(inside), F.lit(0))
    numbered = (
        counted.select("bucket", "row", "copies", first.alias("first"))
        .join(offsets, "bucket")
        .select("row", (F.col("offset") + F.col("first")).alias("first"), "copies")
    )
    numbered = counted_out(numbered, F.col("first"), "copies", "number")

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(Permutation(total, seed).place(number.to_numpy()))

    placed = numbered.withColumn("place", place("number"))
    return placed.select(
        *[F.col("row").getField(c).alias(c) for c in rows.columns],
        F.col("number").alias("row_number"),
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {shards}").alias("slot"),
    )
