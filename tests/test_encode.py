"""Dictionary codes and sparse vectors at any number of values."""

import pytest
from pyspark.sql import DataFrame, functions as F

from casewise.operators import encode, features
from casewise.operators.series import moving_average, with_halo


def test_codes_are_those_of_the_indexer(spark):
    values = ["b", "a", "a", None, "ß", "b", "c", "", "Z"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, kind string").repartition(3)
    codes = encode.dictionary(df, "kind")
    found = {r["id"]: r["code"] for r in encode.encoded(df, "kind", codes, "code").collect()}
    model = features.indexer("kind", "idx").fit(df)
    assert found == {r["id"]: int(r["idx"]) for r in model.transform(df).collect()}
    unseen = spark.createDataFrame([("new",), ("a",), (None,)], "kind string")
    assert [r["code"] for r in encode.encoded(unseen, "kind", codes, "code").orderBy(F.desc("kind")).collect()] == [6, 0, 6]


def test_a_million_values_without_a_collect(spark, monkeypatch):
    df = spark.range(1_500_000, numPartitions=8).select((F.col("id") % 1_000_000).cast("string").alias("kind"))

    def refused(*_):
        raise AssertionError("rows on the driver")

    for name in ("collect", "toPandas", "first", "take", "toLocalIterator"):
        monkeypatch.setattr(DataFrame, name, refused)
    coded = encode.encoded(df, "kind", encode.dictionary(df, "kind"), "code")
    facts = coded.groupBy("kind").agg(F.max("code").alias("code"), F.count("*").alias("n"))
    facts = facts.agg(F.countDistinct("code"), F.min("code"), F.max("code"), F.max(F.when(F.col("n") == 2, F.col("code"))))
    monkeypatch.undo()
    assert tuple(facts.first()) == (1_000_000, 0, 999_999, 499_999)


def test_no_rows_and_nulls_alone(spark):
    for rows in ([], [(None,), (None,)]):
        df = spark.createDataFrame(rows, "kind string")
        codes = encode.dictionary(df, "kind")
        assert codes.count() == 0
        assert [r["code"] for r in encode.encoded(df, "kind", codes, "code").collect()] == [0] * len(rows)


def test_assembled_vectors(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 0.0), (2, 0.0, "y", 7.0), (3, 1.0, None, 5.0), (4, None, "x", 1.0)], "id int, a double, kind string, b double")
    codes = encode.dictionary(df, "kind")
    hot = encode.encoded(df, "kind", codes, "code").withColumn("hot", encode.one_hot("code", codes))
    rows = {r["id"]: r["v"] for r in hot.select("id", encode.assembled(["a"], "hot", ["b"]).alias("v")).collect()}
    assert {k: v and (v["size"], v["indices"], v["values"]) for k, v in rows.items()} == {
        1: (5, [0, 1], [2.0, 1.0]),
        2: (5, [2, 4], [1.0, 7.0]),
        3: (5, [0, 3, 4], [1.0, 1.0, 5.0]),
        4: None,
    }


@pytest.mark.parametrize("before, after", [(2, 1), (0, 0), (300, 64), (5000, 5000)])
def test_moving_averages_of_any_width(spark, before, after):
    n = 12_000
    df = spark.range(n, numPartitions=5).select((F.col("id") * 3 - 50).alias("day"), (F.col("id") * 7919 % 1000).alias("total"))
    values = [i * 7919 % 1000 for i in range(n)]
    sums = [0]
    for v in values:
        sums.append(sums[-1] + v)
    want = [
        (sums[i + after + 1] - sums[i - before]) / (before + after + 1) if i >= before and i + after < n else None for i in range(n)
    ]
    rows = moving_average(df, "day", "total", before, after).orderBy("day").collect()
    assert [r["total"] for r in rows] == values and [r["moving_avg"] for r in rows] == want


def test_a_wide_frame_copies_rows_no_more_than_a_narrow_one(spark):
    placed = spark.range(400_000).withColumnRenamed("id", "position")
    narrow, wide = with_halo(placed, 2, 1).count(), with_halo(placed, 300, 64).count()
    assert 400_000 < narrow < wide < 1.1 * narrow
