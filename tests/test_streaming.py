"""Kept totals equal the batch table: late rows, restarts, and a batch that runs twice."""

import os
from collections import Counter

from pyspark.sql import functions as F

from casewise.streaming.kept import arriving, closed_windows, keep_totals, kept_totals

SCHEMA = "at timestamp, kind string, cases int"


def rows_of(days, kind="x"):
    return [(f"2024-01-{d:02d} 10:00:00", kind, d) for d in days]


def arrive(spark, folder, rows):
    df = spark.createDataFrame(rows, "at string, kind string, cases int").withColumn("at", F.to_timestamp("at"))
    df.coalesce(1).write.mode("append").parquet(folder)


def daily(stream):
    return stream.withColumn("day", F.to_date("at"))


def totals(df):
    return {(str(r["day"]), r["kind"]): (r["n"], r["total"]) for r in df.collect()}


def batch(spark, folder):
    df = daily(spark.read.parquet(folder))
    return totals(df.groupBy("day", "kind").agg(F.count("*").alias("n"), F.sum("cases").alias("total")))


def test_totals_equal_the_batch_table_after_each_run(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "kept")
    arrive(spark, folder, rows_of([20, 21, 21]) + [(None, None, None)])
    schema = spark.read.parquet(folder).schema
    for rows in (rows_of([22], "y"), rows_of([1, 2, 2, 21]), []):  # the second arrival is weeks late, the third has none
        if rows:
            arrive(spark, folder, rows)
        found = keep_totals(daily(arriving(spark, folder, schema, 1)), ["day", "kind"], "cases", path)
        assert totals(found) == batch(spark, folder)
    assert totals(kept_totals(spark, ["day", "kind"], path)) == batch(spark, folder)


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "kept")
    arrive(spark, folder, rows_of([1, 2, 3]))
    schema = spark.read.parquet(folder).schema
    keep_totals(daily(arriving(spark, folder, schema)), ["day", "kind"], "cases", path)
    commits = f"{path}/checkpoint/commits"
    for name in os.listdir(commits):  # as if the driver was lost before it could commit
        os.remove(f"{commits}/{name}")
    arrive(spark, folder, rows_of([4]))
    found = keep_totals(daily(arriving(spark, folder, schema)), ["day", "kind"], "cases", path)
    assert totals(found) == batch(spark, folder)


def test_exact_duplicates_across_files(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "kept")
    arrive(spark, folder, rows_of([1, 2, 2]))
    arrive(spark, folder, rows_of([1, 5]))
    schema = spark.read.parquet(folder).schema
    found = keep_totals(arriving(spark, folder, schema, 1), ["at", "kind", "cases"], "cases", path)
    assert Counter(r["cases"] for r in found.where("n > 1").collect()) == Counter([1, 2])


def test_windows_close_behind_the_watermark(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "closed")
    arrive(spark, folder, rows_of([1, 1, 2]))
    schema = spark.read.parquet(folder).schema

    def closed():
        found = closed_windows(arriving(spark, folder, schema, 1), "at", "1 day", "2 days", ["kind"], "cases", path)
        return {r["start"].day: (r["n"], r["total"]) for r in found.collect()}

    assert closed() == {}
    arrive(spark, folder, rows_of([1, 6]))  # late by less than the delay, after a restart
    closed()
    arrive(spark, folder, rows_of([7]))
    assert closed() == {1: (3, 3), 2: (1, 2)}
