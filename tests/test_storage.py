"""Reports survive writes that fail; staged tables are deleted when spent."""

import os

import pytest
from pyspark.sql import functions as F

from casewise.sources.storage import drop_staged, read_report, report_versions, shared_folder, staged, write_report


def test_a_failed_write_leaves_the_old_report(spark, tmp_path):
    path = str(tmp_path / "report")
    assert write_report(spark.range(3), path).count() == 3
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("id").cast("string")).alias("id"))
    with pytest.raises(Exception, match="no"):
        write_report(broken, path)
    assert sorted(r["id"] for r in read_report(spark, path).collect()) == [0, 1, 2] and len(report_versions(spark, path)) == 1


def test_versions(spark, tmp_path):
    path = str(tmp_path / "report")
    with pytest.raises(FileNotFoundError):
        read_report(spark, path)
    old = None
    for n in (1, 2, 3):
        new = write_report(spark.range(n), path)
        assert old is None or old.count() == n - 1  # a reader of the version before still reads it
        old = new
    assert read_report(spark, path).count() == 3 and len(report_versions(spark, path)) == 2
    assert len([name for name in os.listdir(path) if not name.startswith("_")]) == 2
    write_report(spark.range(7), path + "/")
    assert read_report(spark, path + "/").count() == 7


def test_a_report_from_its_own_old_version(spark, tmp_path):
    path = str(tmp_path / "report")
    first = write_report(spark.range(4), path)
    assert write_report(first.where("id > 1"), path).count() == 2


def test_staged_tables_are_deleted_and_others_are_not(spark, tmp_path):
    df = staged(spark.range(5), "spent")
    place = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(place) and place.startswith(shared_folder(spark))
    drop_staged(spark, df)
    assert not os.path.exists(place)
    other = str(tmp_path / "own")
    spark.range(2).write.parquet(other)
    drop_staged(spark, spark.read.parquet(other))
    assert os.path.isdir(other)
