"""CSV with line breaks inside quotes, read by ranges of its files.

A range of a file does not know whether it starts inside a quoted cell. The quotes before it tell: an even number of them
leaves every cell closed. So each range counts the lines with an odd number of quotes, which open or close a cell
that goes on beyond its line; the sums over the ranges before it, one row per range, number these
lines through the file; and then every line knows for itself whether it is inside a cell. A line that is
a whole record stays in its task. Only lines of records with line breaks are brought together, by the number
of the line that opened them.

Quotes must be as RFC 4180 has them: a cell with a quote in it is quoted as a whole, and the quote doubled.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from casewise.sources.storage import staged

_NUMBERED = "value string, file string, block long, line long, odd boolean, turns long"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their number in the range, whether they have an odd number of quotes, and how many such lines came before.

    The lines of a range come one after the other; a task may have several ranges.
    """
    here, line, turns = None, 0, 0
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        odd = pc.count_substring(batch.column("value"), '"').to_numpy(zero_copy_only=False) % 2
        files, blocks = batch.column("file"), batch.column("block").to_numpy()
        moved = (blocks[1:] != blocks[:-1]) | pc.not_equal(files.slice(1), files.slice(0, n - 1)).to_numpy(zero_copy_only=False).astype(bool)
        numbers, before = np.arange(n), np.cumsum(odd) - odd
        starts = np.flatnonzero(np.concatenate([[True], moved]))
        of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
        numbers, counted = numbers - starts[of], before - before[starts][of]
        if (files[0].as_py(), blocks[0]) == here:  # the range goes on from the batch before
            numbers[of == 0] += line
            counted[of == 0] += turns
        here = (files[n - 1].as_py(), blocks[-1])
        line, turns = int(numbers[-1]) + 1, int(counted[-1] + odd[-1])
        added = [pa.array(numbers, pa.int64()), pa.array(odd.astype(bool)), pa.array(counted, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], ["value", "file", "block", "line", "odd", "turns"])


def _blank(value: Column) -> Column:
    return value.isin("", "\r")


def _place(line: Column | None = None) -> Column:
    """Where a line lies in its file, and whether a carriage return ends it."""
    of = line.getField if line is not None else F.col
    return F.struct(of("block").alias("block"), of("line").alias("line"), F.endswith(of("value"), F.lit("\r")).alias("returns"))


def _ranges(lines: DataFrame) -> DataFrame:
    """Per range, how many odd lines its file has before it, and the place of the file's header."""
    found = lines.groupBy("file", "block").agg(
        F.count_if("odd").alias("odds"), F.min(F.when(~_blank(F.col("value")), _place())).alias("first")
    )
    file = Window.partitionBy("file")
    earlier = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    message = F.concat(F.lit("a quoted cell is not closed, or a quote in a cell is not doubled: "), F.col("file"))
    before = F.coalesce(F.sum("odds").over(earlier), F.lit(0))
    closed = F.when(F.sum("odds").over(file) % 2 == 1, F.raise_error(message).cast("long")).otherwise(before)
    return found.select("file", "block", closed.alias("before"), F.min("first").over(file).alias("header"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record) of every record but the header of each file, as its text.

    Line breaks in cells are as in the file, but for files whose records end in a carriage return and a line feed: there
    the two are one line feed in cells as well, as Spark's own reader has it.

    Two scans, one for the quotes, which runs at once, and one for the records. Blank lines between records are no records.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = lines.mapInArrow(_numbered, _NUMBERED)
    # written, so Spark knows that one row per range is small, and broadcasts it instead of shuffling the lines
    placed = lines.join(staged(_ranges(lines), "ranges"), ["file", "block"])
    turn = F.col("before") + F.col("turns")
    placed = placed.withColumn("inside", turn % 2 == 1).withColumn("opened", F.when(turn % 2 == 1, turn).otherwise(turn + 1))
    whole = placed.where(~F.col("inside") & ~F.col("odd") & ~_blank(F.col("value")) & (_place() != F.col("header"))).select("value")
    parts = placed.where(F.col("inside") | F.col("odd")).groupBy("file", "opened").agg(
        F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("lines"), F.first("header").alias("header")
    )
    text = F.array_join("lines.value", "\n")
    text = F.when(F.col("header.returns"), F.replace(text, F.lit("\r\n"), F.lit("\n"))).otherwise(text)
    joined = parts.where(_place(F.col("lines")[0]) != F.col("header")).select(text.alias("value"))
    return whole.unionByName(joined).select(F.regexp_replace("value", "\r$", "").alias("record"))
