"""Mixing sources to target weights by capped water-filling.

Every source is to take a share of a budget by its weight, but no source may be read more often than
``max_epochs`` times. Sources above that are clamped, what they leave over is shared by the others in
proportion to their weights, and so on until none is above. Sources in the order of cap / weight are
clamped one after another, so prefix sums over that order give the state after every round of
clamping at once, and the first source that is not above its cap ends it.

Inside a source every document is repeated floor(target / size) times as a whole. The fractional
repetition goes to documents in a seeded random order until the words that are left are used up, so
a source meets its target; the document at the edge takes what is left, or the whole or nothing.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from casewise.llm.frames import counted_out, root_buckets
from casewise.sources.storage import staged


def water_fill(sources: DataFrame, weights: Sequence[int], share: tuple[int, int], max_epochs: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size); one row per source.

    Weights go round over the sources by code point, null last. The budget is ``share`` (numerator,
    denominator) of all sizes. Ordering is over the sources, one small row each. A source of size 0
    has target 0; if all sources are clamped the budget is not used up.
    """
    over, under = share
    listed = F.array(*[F.lit(w) for w in weights])
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    weighed = sources.select(
        "source", "source_size", rank.alias("rank"), F.get(listed, (rank - 1) % len(weights)).cast("long").alias("weight")
    ).withColumn("cap", F.col("source_size") * max_epochs)
    clamping = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    earlier = clamping.rowsBetween(Window.unboundedPreceding, -1)
    later = clamping.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = weighed.select(
        "source",
        "source_size",
        "rank",
        "weight",
        "cap",
        (over * F.sum("source_size").over(everything) - under * F.coalesce(F.sum("cap").over(earlier), F.lit(0))).alias(
            "left_over"
        ),
        F.sum("weight").over(later).alias("sharing"),
    )
    above = F.col("cap").cast("double") * F.col("sharing") * under <= F.col("weight").cast("double") * F.col("left_over")
    level = F.when(~above, F.struct("left_over", "sharing"))
    first = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    levelled = filled.select("source", "source_size", "weight", "cap", F.first(level, ignorenulls=True).over(first).alias("level"))
    even = (F.col("weight") * F.col("level.left_over")).cast("double") / (under * F.col("level.sharing")).cast("double")
    return levelled.select(
        "source", "source_size", F.least(F.col("cap").cast("double"), F.coalesce(even, F.col("cap"))).alias("target")
    )


def mix_sources(
    rows: DataFrame,
    weights: Sequence[int],
    share: tuple[int, int] = (3, 2),
    max_epochs: int = 2,
    seed: str = "mix",
    whole: bool = False,
) -> DataFrame:
    """How much of every document the mix takes, from ``rows`` (key, source, size).

    Gives ``key, source, size, source_size, target, repeats, extra``: whole repetitions, and the words
    of the fractional one. With ``whole`` the document at the edge of a source is taken as a whole if
    at least half of it fits, else not at all; ``extra`` is then 0 or ``size``.

    The random order is md5(seed, key): the same in every run and under any partitioning. Sums per
    source and hash bucket find the bucket in which the fraction ends, and only the rows of these
    buckets, about sqrt(n) per source, are shuffled and ordered. Rows equal in key, source and
    size are counted first, so they may fill a third of the table. Keys and sources may be null; a null size is 0.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("null"))))
    narrow = staged(
        rows.select("key", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size"), order.alias("order")), "mix"
    )
    digits = max(1, (root_buckets(narrow.count()).bit_length() + 3) // 4)
    narrow = narrow.withColumn("bucket", F.substring("order", 1, digits))
    sums = staged(narrow.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix")
    targets = water_fill(
        sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, max_epochs
    ).select(
        F.col("source").alias("of"),
        "source_size",
        "target",
        F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)).alias("repeats"),
    ).withColumn("fraction", F.round(F.col("target") - F.col("repeats") * F.col("source_size")).cast("long"))
    targets = staged(targets, "mix")
    same_source = F.col("source").eqNullSafe(F.col("of"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    reached = sums.withColumn("upto", upto).join(targets, same_source, "left").where(F.col("upto") >= F.col("fraction"))
    edges = reached.groupBy("of").agg(
        F.min("bucket").alias("edge"), F.min_by(F.col("upto") - F.col("words"), "bucket").alias("before")
    )
    plan = staged(
        targets.join(edges.withColumnRenamed("of", "at"), F.col("of").eqNullSafe(F.col("at")), "left").drop("at"), "mix"
    )
    ruled = narrow.join(plan, same_source, "left")
    clear = ruled.where(F.col("edge").isNull() | (F.col("bucket") != F.col("edge"))).withColumn(
        "extra", F.when(F.col("bucket") < F.col("edge"), F.col("size")).otherwise(F.lit(0)).cast("long")
    )
    alike = ["key", "source", "size", "order", "source_size", "target", "repeats", "fraction", "before"]
    at_edge = ruled.where(F.col("bucket") == F.col("edge")).groupBy(*alike).agg(F.count("*").alias("copies"))
    turn = Window.partitionBy("source").orderBy("order", F.asc_nulls_first("key"), "size")
    passed = F.coalesce(
        F.sum(F.col("size") * F.col("copies")).over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    roomy = at_edge.withColumn("room", F.col("fraction") - F.col("before") - passed)
    dealt = counted_out(roomy, F.lit(0), "copies", "copy")
    left = F.col("room") - F.col("copy") * F.col("size")
    some = F.greatest(F.lit(0), F.least(F.col("size"), left))
    extra = F.when(2 * some >= F.col("size"), F.col("size")).otherwise(0) if whole else some
    at_edge = dealt.withColumn("extra", extra.cast("long"))
    out = ["key", "source", "size", "source_size", "target", "repeats", "extra"]
    return clear.select(*out).unionByName(at_edge.select(*out))
