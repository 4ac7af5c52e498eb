"""Totals, rates, concentration, peaks and rankings."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from casewise.functions.cleaning import percent


def total_by(df: DataFrame, keys: Sequence[str], amount: str, name: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(amount).alias(name))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of a total order; each task keeps ``k`` rows, nothing is fully sorted."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of every group, with their ``rank``.

    Spark limits each group to ``k`` rows per task before the shuffle, so a hot group stays small.
    """
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def rate_per_group(df: DataFrame, key: str, focus: Column, amount: str, per: int = 1000) -> DataFrame:
    """Focus amount per ``per`` of the group's amount, for groups that have focus rows.

    Both sums come from one pass over the data.
    """
    sums = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.sum(F.when(focus, F.col(amount))).alias("focus_total"),
            F.sum(amount).alias("group_total"),
            F.count_if(focus).alias("_focus_rows"),
        )
        .where(F.col("_focus_rows") > 0)
        .drop("_focus_rows")
    )
    return sums.withColumn("rate", _rate("focus_total", "group_total", per))


def rate_by_join(focus_totals: DataFrame, group_totals: DataFrame, key: str, per: int = 1000) -> DataFrame:
    """The same rate from two totals made elsewhere, ``focus_total`` and ``group_total``.

    Both sides hold one row per group, so no key is hot.
    """
    return focus_totals.join(group_totals, key).withColumn("rate", _rate("focus_total", "group_total", per))


def _rate(part: str, whole: str, per: int) -> Column:
    return F.round(F.try_divide(F.col(part).cast("double"), F.col(whole)) * per, 2)


def concentration(groups: DataFrame, name: str, total: str, ks: Sequence[int]) -> DataFrame:
    """Leader and share of the ``k`` largest groups, for each ``k``, in one row.

    Only the largest ``max(ks)`` groups are ranked.
    """
    whole = groups.agg(F.sum(total)).scalar()
    largest = top_k(groups, [F.desc(total), F.asc(name)], max(ks))
    # at most max(ks) rows are left here
    ranked = largest.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(total), F.asc(name))))
    tops = [F.sum(F.when(F.col("rank") <= k, F.col(total))) for k in ks]
    summed = ranked.agg(
        F.max(F.when(F.col("rank") == 1, F.col(name))).alias("leader"),
        F.max(F.when(F.col("rank") == 1, F.col(total))).alias("leader_total"),
        *[top.alias(f"top{k}_total") for k, top in zip(ks, tops)],
    )
    return summed.select(
        "leader",
        "leader_total",
        percent(F.col("leader_total"), whole).alias("leader_pct"),
        *[c for k in ks for c in (F.col(f"top{k}_total"), percent(F.col(f"top{k}_total"), whole).alias(f"top{k}_pct"))],
        whole.alias("grand_total"),
    )


def top_sum(groups: DataFrame, name: str, total: str, k: int) -> DataFrame:
    """Sum over the ``k`` largest groups."""
    return top_k(groups, [F.desc(total), F.asc(name)], k).agg(F.sum(total).alias("top_total"))


def peak(groups: DataFrame, name: str, total: str) -> DataFrame:
    """The group with the largest total; the first by name among equals."""
    return top_k(groups, [F.desc(total), F.asc(name)], 1)


def group_rollup(
    df: DataFrame, keys: Sequence[str], amount: str, lists: Sequence[str], whole: str = "all"
) -> DataFrame:
    """Row count and total of every group, and of every value of ``lists`` in it, in one pass.

    Each group has one row with list ``whole``, whose ``copies`` and ``amount`` are the group's row
    count and total, and one row per value of each list. Repeating a list's values that are not
    null ``copies`` times gives the plain list back, without ever gathering the list of a group,
    which may hold a large part of the table, into one row or one task.
    """
    without = {c: F.col(f"_without_{c}") for c in lists}
    return (
        df.groupingSets([*[[*keys, c] for c in lists], list(keys)], *keys, *lists)
        .agg(
            F.count("*").alias("copies"),
            F.sum(amount).alias("amount"),
            *[F.grouping(c).alias(f"_without_{c}") for c in lists],
        )
        .select(
            *keys,
            F.coalesce(*[F.when(without[c] == 0, F.lit(c)) for c in lists], F.lit(whole)).alias("list"),
            F.coalesce(*[F.when(without[c] == 0, F.col(c).cast("string")) for c in lists]).alias("value"),
            "copies",
            "amount",
        )
    )


def describe_group(parts: Sequence[str | Column]) -> Column:
    """One sentence out of literals and columns, joined by blanks; null parts are left out."""
    return F.concat_ws(" ", *[F.lit(part) if isinstance(part, str) else part.cast("string") for part in parts])
