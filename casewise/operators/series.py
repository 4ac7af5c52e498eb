"""Operations along an ordered series of group totals.

Neighbours are found by row position and brought together by an equi-grouping on that position or
on ranges of it, so a series of any length is handled without one sorted task. A null in the order comes first.
"""

from pyspark.sql import DataFrame, Window, functions as F

from casewise.functions.cleaning import percent
from casewise.operators.ordered import running_totals, with_position

RANGE = 4096  # positions in a range of a moving average


def with_halo(placed: DataFrame, before: int, after: int) -> DataFrame:
    """Rows with a ``position`` in ranges of it, ``_range``, where ``_own`` is the row's own; rows near an edge also in the range beyond.

    Ranges are at least as long as a frame, so a row is in two at most, or three of a very short one.
    """
    length = max(RANGE, before + after + 1)
    reach = [F.floor((F.col("position") + shift) / length) for shift in (-after, 0, before)]
    return placed.withColumn("_own", reach[1]).withColumn("_range", F.explode(F.array_distinct(F.array(*reach))))


def moving_average(series: DataFrame, order_by: str, value: str, before: int = 2, after: int = 1) -> DataFrame:
    """Mean of each row with its neighbours; null where the frame is not full.

    The default frame is a centred window of four rows. Gaps in ``order_by`` do not matter: the
    frame counts rows. Each range of positions is gone through on its own, so a wide frame costs no more copies of
    a row than a narrow one.
    """
    placed = with_position(series.select(order_by, value), order_by)
    around = Window.partitionBy("_range").orderBy("position").rowsBetween(-before, after)
    found = with_halo(placed, before, after).select(
        "_own", "_range", order_by, value, F.avg(value).over(around).alias("_mean"), F.count(value).over(around).alias("_present")
    )
    full = F.col("_present") == before + after + 1
    return found.where(F.col("_own") == F.col("_range")).select(order_by, value, F.when(full, F.col("_mean")).alias("moving_avg"))


def step_delta(series: DataFrame, order_by: str, value: str) -> DataFrame:
    """Drop from the previous row, relative to the first value of the series."""
    series = series.select(order_by, value)
    first = series.agg(F.min_by(value, order_by)).scalar()
    spread = with_position(series, order_by).select(
        order_by, value, "position", F.explode(F.array(F.lit(0), F.lit(1))).alias("shift")
    )
    own = F.col("shift") == 0
    gathered = spread.groupBy((F.col("position") + F.col("shift")).alias("target")).agg(
        F.max(F.when(own, F.col(order_by))).alias(order_by),
        F.max(F.when(own, F.col(value))).alias(value),
        F.max(F.when(~own, F.col(value))).alias("previous"),
        F.max(own).alias("real"),
    )
    drop = F.try_divide((F.col("previous") - F.col(value)).cast("double"), first)
    return gathered.where("real").select(order_by, value, drop.alias("delta"))


def cumulative_share(groups: DataFrame, name: str, total: str) -> DataFrame:
    """Groups from largest to smallest with rank, share and cumulative share of the total.

    Groups of equal total go by name.
    """
    groups = groups.select(name, total)
    whole = groups.agg(F.sum(total)).scalar()
    falling = groups.withColumn("_falling", -F.col(total)).withColumn("_one", F.lit(1))
    ranked = running_totals(falling, "_falling", [total, "_one"], then_by=[name])
    return ranked.select(
        name,
        total,
        F.col("upto__one").alias("rank"),
        F.try_divide(F.col(total).cast("double"), whole).alias("share"),
        F.try_divide(F.col(f"upto_{total}").cast("double"), whole).alias("cum_share"),
    )


def share_of_total(groups: DataFrame, amount: str, name: str = "pct") -> DataFrame:
    """Each group's percentage of the sum over all groups."""
    whole = groups.agg(F.sum(amount)).scalar()
    return groups.withColumn(name, percent(F.col(amount), whole))
