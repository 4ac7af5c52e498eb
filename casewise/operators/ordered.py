"""Order statistics over a whole table without sorting it in one task.

Rows are cut into value ranges, each range is ordered on its own, and the totals of the
ranges before it are added. Only the range totals, about as many as the square root of the rows, meet in one
place. The edges of the ranges only balance the work: any edges give the same result.
"""

import math
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

#: 1 / relative rank error of the sketch that brackets a percentile.
BRACKET = 100_000
#: Ranges that a first sketch cuts; more follow from the number of rows.
FIRST_RANGES = 512
_PREFIX = 6  # bytes of a text that a double holds exactly


def range_edges(df: DataFrame, numbers: Sequence[Column]) -> list[list[float]]:
    """Per number, inner edges that cut its values into ranges of about equal row count.

    There are about as many ranges as rows in a range, and at least ``FIRST_RANGES``. The edges come from
    quantile sketches in one pass over the table, or two if the rows ask for more ranges.
    """

    def sketch(ranges: int):
        wanted = [step / ranges for step in range(1, ranges)]
        return df.agg(F.count("*"), *[F.percentile_approx(n.cast("double"), wanted, 2 * ranges) for n in numbers]).first()

    found = sketch(FIRST_RANGES)
    if math.isqrt(found[0]) > FIRST_RANGES:
        found = sketch(math.isqrt(found[0]))
    return [sorted({edge for edge in edges or [] if math.isfinite(edge)}) for edges in found[1:]]


def _place_of(values: Column, edges: Sequence[float], df: DataFrame, name: str) -> DataFrame:
    """Add ``name``, how many edges do not exceed the value; null has -1 and NaN comes last."""
    ordered = df.withColumn("_order", values.cast("double"))
    if edges:
        cut = Bucketizer(
            splits=[float("-inf"), *edges, float("inf")], inputCol="_order", outputCol=name, handleInvalid="keep"
        )
        placed = cut.transform(ordered).withColumn(name, F.col(name).cast("int"))
    else:
        placed = ordered.withColumn(name, F.when(F.isnan("_order"), 1).otherwise(0))
    return placed.withColumn(name, F.when(F.col("_order").isNull(), -1).otherwise(F.col(name))).drop("_order")


def _tie_number(column: Column, kind: str) -> Column:
    """A number that does not order values of ``column`` against their own order."""
    if kind == "string":
        return F.conv(F.hex(F.rpad(F.substring(F.encode(column, "UTF-8"), 1, _PREFIX), _PREFIX, b"\x00")), 16, 10).cast("double")
    return column.cast("double")


def _with_range(
    df: DataFrame, order_by: str, edges: Sequence[float], then_by: Sequence[str] = (), tie_edges: Sequence[float] = ()
) -> DataFrame:
    """Add ``_range`` and ``_tie``: a value on an edge has a range of its own, which the tie-break cuts on."""
    placed = _place_of(F.col(order_by), edges, df, "_place")
    if not edges:
        return placed.withColumn("_range", 2 * F.col("_place")).withColumn("_tie", F.lit(0)).drop("_place")
    listed = F.array(*[F.lit(float(edge)) for edge in edges])
    on_edge = F.coalesce(F.col(order_by).cast("double") == F.get(listed, F.col("_place") - 1), F.lit(False))
    placed = placed.withColumn("_range", 2 * F.col("_place") - on_edge.cast("int"))
    if not then_by or not tie_edges:
        return placed.withColumn("_tie", F.lit(0)).drop("_place")
    number = _tie_number(F.col(then_by[0]), dict(df.dtypes)[then_by[0]])
    cut = _place_of(number, tie_edges, placed, "_tie")
    return cut.withColumn("_tie", F.when(F.col("_range") % 2 == 1, F.col("_tie")).otherwise(0)).drop("_place")


def running_totals(
    df: DataFrame,
    order_by: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    then_by: Sequence[str] = (),
    edges: Sequence[float] | None = None,
    with_ties: bool = False,
) -> DataFrame:
    """Add ``upto_<c>``, the sum of ``c`` over all rows up to and including this one.

    ``order_by`` is numeric and ascending, null first and NaN last; ``then_by`` breaks ties, null first.
    A value that fills many rows is cut along the first column of ``then_by``; without one, aggregate by
    value first. With ``with_ties``, the sum of every row also has all rows that tie with it.
    """
    tie_edges: list[float] = []
    if edges is None:
        numbers = [F.col(order_by)]
        if then_by and not with_ties:
            numbers.append(_tie_number(F.col(then_by[0]), dict(df.dtypes)[then_by[0]]))
        edges, *more = range_edges(df, numbers)
        tie_edges = more[0] if more else []
    ranged = _with_range(df, order_by, edges, () if with_ties else then_by, tie_edges)
    group = [*by, "_range", "_tie"]
    earlier = Window.partitionBy(*by).orderBy("_range", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    per_range = ranged.groupBy(*group).agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    offsets = per_range.select(
        *[F.col(c).alias(f"_of_{c}") for c in group],
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in sums],
    )
    within = Window.partitionBy(*group)
    frame = (Window.unboundedPreceding, Window.currentRow)
    within = within.orderBy(order_by).rangeBetween(*frame) if with_ties else within.orderBy(order_by, *then_by).rowsBetween(*frame)
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group]
    return ranged.join(offsets, same).select(
        *df.columns, *[(F.col(f"_before_{c}") + F.sum(c).over(within)).alias(f"upto_{c}") for c in sums]
    )


def exact_percentiles(df: DataFrame, column: str, points: Mapping[str, str], accuracy: int = BRACKET) -> DataFrame:
    """Exact discrete percentiles of a whole column, as one row.

    ``points`` maps an output name to a fraction written as a decimal string, e.g. ``"0.95"``. The
    percentile is the smallest value that at least that fraction of the non-null values do not
    exceed; NaN is the largest value.

    Two scans. A sketch, whose rank is off by at most one part in ``accuracy``, puts a bracket around every
    wanted rank. Then rows below each bracket are counted, and rows in it, a few parts in ``accuracy``
    and a hot value as one row per task, are grouped by value and ordered.
    """
    kind = dict(df.dtypes)[column]
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value"))
    number = F.col("value").cast("double")
    names = list(points)
    sides = [min(1.0, max(0.0, float(points[name]) + shift / accuracy)) for name in names for shift in (-2, 2)]
    sketch, total = values.agg(F.percentile_approx(number, sides, accuracy), F.count("*")).first()
    if not total:
        return df.sparkSession.createDataFrame([(None,) * len(names)], ", ".join(f"`{name}` {kind}" for name in names))
    brackets = [(sketch[2 * i], sketch[2 * i + 1]) for i in range(len(names))]
    # the lowest rows of a bracket may reach to the start, the highest to the end
    low = [F.lit(None) if float(points[n]) * accuracy <= 2 else F.lit(a) for n, (a, _) in zip(names, brackets, strict=True)]
    high = [F.lit(None) if (1 - float(points[n])) * accuracy <= 2 else F.lit(b) for n, (_, b) in zip(names, brackets, strict=True)]
    inside = [
        F.coalesce(number >= a, F.lit(True)) & F.coalesce(number <= b, F.lit(True)) for a, b in zip(low, high, strict=True)
    ]
    below = [F.coalesce(number < a, F.lit(False)) for a in low]
    anywhere = F.lit(False)
    for part in inside:
        anywhere = anywhere | part
    # one row per value in a bracket, and one for all others
    kept = F.when(anywhere, F.col("value"))
    counts = values.groupBy(anywhere.alias("near"), kept.alias("value")).agg(
        F.count("*").alias("n"), *[F.count_if(b).alias(f"below_{i}") for i, b in enumerate(below)]
    )
    rows = counts.select(
        "near",
        "value",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("point"),
                        F.when(F.col("near") & inside[i], F.col("n")).otherwise(0).alias("n"),
                        F.col(f"below_{i}").alias("below"),
                    )
                    for i in range(len(names))
                ]
            )
        ),
    )
    here = Window.partitionBy("point")
    upto = F.sum("below").over(here) + F.sum("n").over(here.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    reached = rows.select("point", "value", "n", upto.alias("upto")).where("n > 0")
    ranks = [max(1, math.ceil(total * Decimal(points[name]))) for name in names]
    return reached.agg(
        *[
            F.min(F.when((F.col("point") == i) & (F.col("upto") >= rank), F.col("value"))).alias(name)
            for i, (name, rank) in enumerate(zip(names, ranks, strict=True))
        ]
    )


def approximate_percentiles(df: DataFrame, column: str, points: Mapping[str, str], accuracy: int = 10000) -> DataFrame:
    """The same row from one pass and a bounded sketch, off by at most 1/accuracy in rank."""
    return df.agg(
        *[F.percentile_approx(column, float(fraction), accuracy).alias(name) for name, fraction in points.items()]
    )


def with_position(
    df: DataFrame, order_by: str, then_by: Sequence[str] = (), edges: Sequence[float] | None = None
) -> DataFrame:
    """Add the 1-based row position in ascending order, null first."""
    counted = running_totals(df.withColumn("_one", F.lit(1)), order_by, ["_one"], then_by=then_by, edges=edges)
    return counted.select(*df.columns, F.col("upto__one").alias("position"))
