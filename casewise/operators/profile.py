"""Profiles of a table: shape, nulls, duplicates, percentiles, outliers."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casewise.functions.cleaning import percent
from casewise.operators.ordered import exact_percentiles

QUARTILES = {"p25": "0.25", "p50": "0.50", "p75": "0.75"}


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the row count of the table."""
    columns = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(name).alias("column"), F.lit(kind).alias("type"))
            for i, (name, kind) in enumerate(df.dtypes, 1)
        ]
    )
    counted = df.agg(F.count("*").alias("rows"))
    return counted.select(F.inline(columns), "rows").withColumn("columns", F.lit(len(df.columns)))


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, smallest and largest value: one row per numeric column."""
    stats = {"n": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(*[make(c).alias(f"{c}:{stat}") for c in columns for stat, make in stats.items()])
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"`{c}:n`").alias("n"),
            *[F.col(f"`{c}:{stat}`").cast("double").alias(stat) for stat in stats if stat != "n"],
        )
        for c in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def summary(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of one column, as one row."""
    found = exact_percentiles(df, column, QUARTILES).select(F.struct(*QUARTILES)).scalar()
    return df.agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("stddev"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    ).select("*", *[found[name].alias(name) for name in QUARTILES])


def null_audit(df: DataFrame) -> DataFrame:
    """Null count and percentage of every column, from one pass."""
    wide = df.agg(F.count("*").alias(":rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]
    return wide.select(F.inline(F.array(*rows)), F.col("`:rows`").alias("rows")).select(
        "column", "nulls", percent(F.col("nulls"), F.col("rows")).alias("pct")
    )


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and surplus copies of a table, as one row.

    Text columns are grouped by SHA-256 fingerprint and length, so whole texts do not travel.
    Copies are counted in each task before the shuffle, however many one row has.
    """
    keys: list[Column] = []
    for name, kind in df.dtypes:
        if kind == "string":
            keys += [F.sha2(name, 256).alias(f"{name}:sha"), F.length(name).alias(f"{name}:len")]
        else:
            keys.append(F.col(name))
    copies = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
    ).select("*", percent(F.col("duplicates"), F.col("rows")).alias("pct"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Logical keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def outlier_limit(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Exact quartiles, their distance, and the limit ``reach`` distances above, as one row."""
    quartiles = exact_percentiles(df, column, {"q1": "0.25", "q3": "0.75"})
    spread = F.col("q3") - F.col("q1")
    return quartiles.select("q1", "q3", spread.alias("iqr"), (F.col("q3") + reach * spread).alias("upper"))


def iqr_outliers(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, upper limit, and how many values lie above it, as one row."""
    limit = outlier_limit(df, column, reach)
    found = limit.select(F.struct("*")).scalar()
    counted = df.agg(F.count_if(F.col(column) > found["upper"]).alias("outliers"), F.count("*").alias("rows"))
    return counted.select(
        *[found[name].alias(name) for name in limit.columns],
        "outliers",
        percent(F.col("outliers"), F.col("rows")).alias("pct"),
    )


def rows_above_limit(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """The outlying rows themselves."""
    return df.where(F.col(column) > outlier_limit(df, column, reach).select("upper").scalar())


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of distinct values of each column, as one row."""
    return df.agg(*[F.count_distinct(c).alias(c) for c in columns])


def approximate_distinct_counts(df: DataFrame, columns: Sequence[str], rsd: float = 0.01) -> DataFrame:
    """The same row from bounded sketches, with relative error ``rsd``."""
    return df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in columns])


def histogram(counts: DataFrame, value: str, n: str, bins: int) -> DataFrame:
    """Equal-width bins over a table of (value, number of rows); the last bin is closed.

    Values that are all equal fall into the first bin. Empty bins are not listed.
    """
    found = counts.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    width = (found["high"] - found["low"]).cast("double")
    place = F.coalesce(F.floor(F.try_divide((F.col(value) - found["low"]) * F.lit(float(bins)), width)), F.lit(0))
    return (
        counts.withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
        .groupBy("bin")
        .agg(F.sum(n).alias("rows"), F.min(value).alias("smallest"), F.max(value).alias("largest"))
    )


def percentile_points(fractions: Sequence[int]) -> Mapping[str, str]:
    """Names and decimal fractions for whole percentages, e.g. 95 gives ``p95``."""
    return {f"p{p}": f"{p / 100:.2f}" for p in fractions}
