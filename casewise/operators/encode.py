"""Categories of any number of values as dense codes and sparse vectors. The dictionary is a table, never on the driver."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from casewise.sources.storage import staged


def row_numbers(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with ``name``, the 0-based place of each row in a total order.

    Rows are sorted by ranges and written; a row's place is its place in the range after the rows of the ranges before. Only
    the ranges' sizes, a row each, meet in one task.
    """
    ordered = staged(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.min("_at").alias("_least"), F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_least")
    # written, so Spark sees how small it is and broadcasts it
    offsets = staged(sizes.select("_part", before.alias("_before")), "offsets")
    return ordered.join(offsets, part == F.col("_part")).select(*df.columns, (F.col("_at") + F.col("_before")).alias(name))


def dictionary(df: DataFrame, category: str) -> DataFrame:
    """(value, n, code) of every value but null: codes from 0 by falling frequency, ties by value."""
    counts = df.where(F.col(category).isNotNull()).groupBy(F.col(category).alias("value")).agg(F.count("*").alias("n"))
    return row_numbers(counts, [F.desc("n"), F.asc("value")], "code")


def encoded(df: DataFrame, category: str, codes: DataFrame, output: str) -> DataFrame:
    """``df`` with the code of its category; null and values the dictionary lacks share the next free code."""
    size = codes.agg(F.count("*")).scalar()
    found = codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    joined = df.join(found, F.col(category) == F.col("_value"), "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("_code", size).alias(output))


def one_hot(code: str, codes: DataFrame) -> Column:
    """A code as a sparse vector with a slot for every code and one for unseen values: (size, indices, values)."""
    size = codes.agg(F.count("*") + 1).scalar()
    return F.struct(size.alias("size"), F.array(F.col(code)).alias("indices"), F.array(F.lit(1.0)).alias("values"))


def assembled(before: Sequence[str], hot: str, after: Sequence[str]) -> Column:
    """Numbers, a sparse vector, and numbers as one sparse vector; null if a number is."""
    width = F.col(hot)["size"]

    def slots(columns: Sequence[str], first: Column) -> Column:
        pairs = [F.struct((first + i).cast("long").alias("i"), F.col(c).cast("double").alias("x")) for i, c in enumerate(columns)]
        return F.array(*pairs) if pairs else F.array().cast("array<struct<i: bigint, x: double>>")

    shifted = F.transform(
        F.arrays_zip(F.col(hot)["indices"].alias("i"), F.col(hot)["values"].alias("x")),
        lambda s: F.struct((s["i"] + len(before)).alias("i"), s["x"].alias("x")),
    )
    every = F.concat(slots(before, F.lit(0)), shifted, slots(after, len(before) + width))
    filled = F.filter(every, lambda s: s["x"] != 0)
    known = F.lit(True)
    for column in (*before, *after):
        known = known & F.col(column).isNotNull()
    vector = F.struct(
        (width + len(before) + len(after)).alias("size"),
        F.transform(filled, lambda s: s["i"]).alias("indices"),
        F.transform(filled, lambda s: s["x"]).alias("values"),
    )
    return F.when(known, vector)


def sparse_slots(df: DataFrame, vector: str) -> DataFrame:
    """(position, nonzero, total) of every slot that is not zero throughout."""
    slots = F.arrays_zip(F.col(vector)["indices"].alias("position"), F.col(vector)["values"].alias("x"))
    found = df.select(F.explode(slots).alias("slot"))
    return found.groupBy("slot.position").agg(F.count("*").alias("nonzero"), F.sum("slot.x").alias("total"))
