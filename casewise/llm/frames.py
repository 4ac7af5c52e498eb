"""Small helpers shared by the operators of this package."""

import math

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: a word is a run of anything but the six ASCII white-space characters.
WORD = "[^\\x20\\x09-\\x0D]+"

BROADCAST_HASHES = 1 << 18  # 64-bit numbers, 2 MB


def n_words(text: str | Column) -> Column:
    """Number of words of a text; 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def root_buckets(rows: int) -> int:
    """A power of two near the square root of ``rows``: as many buckets as rows in a bucket, at any size."""
    return 1 << max(0, math.ceil(math.log2(max(1, rows)) / 2))


def counted_out(df: DataFrame, first: Column, copies: str, name: str, block: int = 65_536) -> DataFrame:
    """Every row ``copies`` times with a number ``name`` from ``first`` on, in blocks: no array holds more than one.

    The blocks of a row with more copies than one are dealt out, so many tasks write a row that fills a large part of the table.
    """
    last = first + F.col(copies) - 1

    def counted(blocks: DataFrame) -> DataFrame:
        numbers = F.sequence(F.col("_block"), F.least(F.col("_block") + block - 1, last))
        return blocks.withColumn(name, F.explode(numbers)).drop("_block")

    few = df.where(F.col(copies) <= block).withColumn("_block", first.cast("long"))
    many = df.where(F.col(copies) > block).withColumn("_block", F.explode(F.sequence(first.cast("long"), last, F.lit(block).cast("long"))))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return counted(few).unionByName(counted(many.repartition(parts, "_block")))


def only_hashes(df: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """``df`` without rows whose ``column``, a hash, is not in ``wanted`` (the same column), as far as a broadcast can tell.

    At most ``BROADCAST_HASHES`` numbers are broadcast. If more are wanted, ``df`` comes back as it is, so this only saves work for
    what follows: moving a text costs more than hashing it.
    """
    found = wanted.select(F.col(column).alias("_wanted")).distinct()
    if found.limit(BROADCAST_HASHES + 1).count() > BROADCAST_HASHES:
        return df
    return df.join(F.broadcast(found), F.col(column) == F.col("_wanted"), "left_semi")
