"""Totals that follow a folder of arriving files, by Structured Streaming.

A run takes what has arrived since the last one and ends; the checkpoint holds what was read. Every micro-batch adds its own
totals as one small table under its batch number, which a batch that is run again after a failure overwrites, so each
row counts once. The kept table is the sum over these tables: late rows count whenever they come, and old files are
never read again.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from casewise.sources.storage import fresh_path


def arriving(spark: SparkSession, folder: str, schema: T.StructType, files_at_once: int = 100) -> DataFrame:
    """The rows of all Parquet files that are in a folder or will come to it, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def keep_totals(stream: DataFrame, keys: Sequence[str], amount: str, path: str) -> DataFrame:
    """Add what has arrived to the totals kept under ``path``, and give the kept table: (keys, n, total).

    With all columns as ``keys``, ``n`` counts exact duplicates. ``amount`` is a whole number or a decimal, so the sum does not depend
    on how rows are dealt into batches.
    """

    def add(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(amount).alias("total"))
        sums.write.mode("overwrite").parquet(f"{path}/totals/batch={number}")

    run = stream.writeStream.foreachBatch(add).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    fields = {f.name: f.dataType for f in stream.schema}
    kinds = ", ".join(f"`{k}` {fields[k].simpleString()}" for k in keys)
    return kept_totals(stream.sparkSession, keys, path, f"{kinds}, n long, total {_sum_type(fields[amount])}")


def kept_totals(spark: SparkSession, keys: Sequence[str], path: str, schema: str | None = None) -> DataFrame:
    """The kept table as of now."""
    reader = spark.read.schema(schema) if schema else spark.read
    found = reader.parquet(f"{path}/totals")
    return found.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def _sum_type(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"decimal({min(38, kind.precision + 10)},{kind.scale})"
    return "bigint" if isinstance(kind, T.IntegralType) else "double"


def closed_windows(
    stream: DataFrame, time: str, window: str, delay: str, keys: Sequence[str], amount: str, path: str, start: str | None = None
) -> DataFrame:
    """Totals of event-time windows that are closed: no row of theirs is waited for longer than ``delay``. One row per window and key, for good.

    Rows later than that are left out, which the state's bound costs; ``keep_totals`` counts them.
    """
    spans = F.window(time, window, startTime=start) if start else F.window(time, window)
    sums = stream.withWatermark(time, delay).groupBy(spans.alias("span"), *keys).agg(F.count("*").alias("n"), F.sum(amount).alias("total"))
    flat = sums.select(F.col("span.start").alias("start"), *keys, "n", "total")
    run = flat.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/checkpoint").option("path", f"{path}/closed")
    run.trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(flat.schema).parquet(f"{path}/closed")


def scratch(spark: SparkSession) -> str:
    """A new folder for a stream that no one named a folder for."""
    return fresh_path(spark, "stream")
