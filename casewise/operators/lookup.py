"""Joins to code tables and to per-group facts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casewise.sources.readers import literal_table


def map_codes(
    df: DataFrame,
    code: str,
    rows: Sequence[tuple],
    outputs: Sequence[tuple[str, str, object]],
) -> DataFrame:
    """Look ``code`` up in a literal table; a code that is not in it gets the defaults.

    ``rows`` are (code, value, ...) and ``outputs`` name the leading values as (name, type, default).
    The table lives in code; Spark knows its size and broadcasts it if it is small.
    """
    key = dict(df.dtypes)[code]
    schema = ", ".join([f"_code {key}", *[f"_value_{i} {kind}" for i, (_, kind, _) in enumerate(outputs)]])
    codes = literal_table(df.sparkSession, [row[: len(outputs) + 1] for row in rows], schema)
    defaulted: list[Column] = [
        F.coalesce(F.col(f"_value_{i}"), F.lit(default).cast(kind)).alias(name)
        for i, (name, kind, default) in enumerate(outputs)
    ]
    return df.join(codes, F.col(code) == F.col("_code"), "left").select(*df.columns, *defaulted)


def fold_rare(df: DataFrame, category: str, min_rows: int = 10, other: str = "Otros") -> DataFrame:
    """Replace categories with fewer than ``min_rows`` rows by ``other``; null counts as blank.

    Sizes are joined to the rows; adaptive execution broadcasts them if they are few and splits hot categories if not.
    """
    named = df.withColumn(category, F.coalesce(F.col(category).cast("string"), F.lit("")))
    sizes = named.groupBy(category).agg(F.count("*").alias("_rows"))
    kept = F.when(F.col("_rows") >= min_rows, F.col(category)).otherwise(F.lit(other))
    return named.join(sizes, category).withColumn(category, kept).select(*df.columns)


def attach_predictions(sample: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Left join of a sample to predictions keyed the same way, whatever the size of either."""
    return sample.join(predictions, key, "left")
