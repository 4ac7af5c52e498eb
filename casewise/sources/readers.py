"""Table readers. Files are read by the executors, never through the driver."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from casewise.functions.cleaning import blank_to_null, dotted_year, to_int
from casewise.sources.split_csv import csv_records

# Columns of a notification file, all text on disk.
NOTIFICATION_COLUMNS = ["COD_EVE", "Nombre", "ANO", "SEMANA", "COD_DPTO_O", "COD_MUN_O", "nom_mun", "conteo_casos"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table; filters and column choice reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give work that is heavy per row to all cores, where the files alone would not.

    A large input has more splits than the session has cores and stays as it is, unshuffled. Only
    an input of fewer splits is dealt out by key, which is a small shuffle by the same measure.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def read_text_columns(
    spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = True, by_ranges: bool = True
) -> DataFrame:
    """CSV with a header, every column kept as text and blanks kept as ``''``.

    Columns are matched by name through the header, in whatever order the file has them. A quote
    inside a quoted cell is doubled, and line breaks inside quotes belong to the cell. Files are read by ranges, in as
    many tasks as they have splits. ``by_ranges=False`` reads each file in one task, which bears a
    stray quote inside an unquoted cell; ``multi_line=False`` is for files whose cells have no line breaks.
    """
    options = {"header": True, "inferSchema": False, "encoding": "UTF-8", "escape": '"', "multiLine": multi_line}
    found = spark.read.options(**options).csv(path)
    if multi_line and by_ranges:
        cells = ", ".join(f"c{i} string" for i in range(len(found.columns)))
        parsed = F.from_csv("record", cells, {"escape": '"', "multiLine": "true"})
        found = csv_records(spark, path).select(parsed.alias("row")).select("row.*").toDF(*found.columns)
    return found.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns])


def clean_notifications(raw: DataFrame, town: Column | None = None) -> DataFrame:
    """Typed notifications from raw text columns, in one projection.

    ``town`` replaces the default treatment of town names (blank becomes null).
    """
    return raw.select(
        to_int("COD_EVE").alias("event_code"),
        F.col("Nombre").alias("event"),
        dotted_year("ANO").alias("year"),
        to_int("SEMANA").alias("week"),
        to_int("COD_DPTO_O").alias("dept"),
        to_int("COD_MUN_O").alias("town_code"),
        (blank_to_null("nom_mun") if town is None else town).alias("town"),
        to_int("conteo_casos").alias("cases"),
    )


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A small table written out in code."""
    return spark.createDataFrame(list(rows), schema)
