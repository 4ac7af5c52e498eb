"""Order statistics and joins against brute force, with hot values and many ranges."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from casewise.operators import metrics, totals
from casewise.operators.lookup import fold_rare
from casewise.operators.ordered import (
    approximate_percentiles,
    exact_percentiles,
    range_edges,
    running_totals,
    with_position,
)
from casewise.operators.series import cumulative_share, moving_average, step_delta
from checking import plan

POINTS = {"p00": "0.00", "p25": "0.25", "p50": "0.50", "p75": "0.75", "p99": "0.99", "p100": "1.00"}


def skewed(n=3000, seed=1):
    """A third of the values are one value; the rest are spread over many magnitudes."""
    draw = random.Random(seed)
    return [7.0 if draw.random() < 0.34 else round(draw.lognormvariate(0, 4), 3) * draw.choice([-1, 1]) for _ in range(n)]


def discrete(values, point):
    ordered = sorted(values)
    return ordered[max(1, math.ceil(round(len(ordered) * point, 9))) - 1]


def test_percentiles_with_a_hot_value(spark):
    values = skewed()
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, "v double")
    found = exact_percentiles(df, "v", POINTS).first().asDict()
    assert found == {name: discrete(values, float(point)) for name, point in POINTS.items()}
    close = approximate_percentiles(df, "v", {"p50": "0.50"}).first()["p50"]
    assert abs(close - found["p50"]) < 1.0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-5, 5), min_size=1, max_size=40), accuracy=st.sampled_from([2, 5, 100]))
def test_percentiles_do_not_depend_on_the_sketch(spark, values, accuracy):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    found = exact_percentiles(df, "v", POINTS, accuracy=accuracy).first().asDict()
    assert found == {name: discrete(values, float(point)) for name, point in POINTS.items()}


def test_percentiles_of_many_values_by_a_rough_sketch(spark):
    values = skewed(20_000, seed=4)
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    found = exact_percentiles(df, "v", POINTS, accuracy=50).first().asDict()
    assert found == {name: discrete(values, float(point)) for name, point in POINTS.items()}


def test_percentiles_read_the_table_once_after_the_sketch(spark, tmp_path):
    spark.range(10_000).selectExpr("id as v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    text = plan(exact_percentiles(df, "v", {"p25": "0.25", "p50": "0.5"}))
    assert text.count("FileScan") - text.count("ReusedExchange") <= 1


def test_percentiles_without_values(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_percentiles(df, "v", {"p50": "0.5"}).collect()[0].asDict() == {"p50": None}


KEY = st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 1.0, 2.5, float("nan")]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(KEY, min_size=1, max_size=25), edges=st.sets(st.sampled_from([-1.0, 0.0, 0.5, 1.0, 3.0]), max_size=4))
def test_running_totals_do_not_depend_on_the_edges(spark, keys, edges):
    df = spark.createDataFrame([(k, f"n{i % 5}é" if i % 6 else None, i) for i, k in enumerate(keys)], "o double, t string, x int")

    def found(**options):
        rows = running_totals(df, "o", ["x"], then_by=["t", "x"], **options).collect()
        return sorted((r["x"], r["upto_x"]) for r in rows)

    def place(row):
        o, t, x = row
        return (o is not None, o is not None and math.isnan(o), 0.0 if o is None or math.isnan(o) else o, t is not None, (t or "").encode(), x)

    total, want = 0, []
    for row in sorted((tuple(r) for r in df.collect()), key=place):
        total += row[2]
        want.append((row[2], total))
    assert found(edges=[]) == found(edges=sorted(edges)) == found() == sorted(want)


def test_one_total_in_half_of_the_groups(spark):
    data = [(f"g{i:05d}", 7 if i % 2 else i) for i in range(4000)]
    df = spark.createDataFrame(data, "g string, total long")
    found = {r["g"]: r["rank"] for r in cumulative_share(df, "g", "total").collect()}
    assert found == {g: i for i, (g, _) in enumerate(sorted(data, key=lambda r: (-r[1], r[0])), 1)}


@pytest.mark.parametrize("parts", [1, 4])
def test_series_keep_rows_without_an_order(spark, parts):
    data = [(i, i * 2) for i in range(16)] + [(None, 5)]
    df = spark.createDataFrame(data, "week int, total int").repartition(parts)
    assert moving_average(df, "week", "total").count() == 17
    assert {r["week"] for r in step_delta(df, "week", "total").collect()} == {w for w, _ in data}


def test_running_totals_per_group(spark):
    draw = random.Random(3)
    data = [(draw.choice("ab"), i, draw.randint(0, 9)) for i in draw.sample(range(10**6), 500)]
    df = spark.createDataFrame(data, "g string, o int, x int")
    found = {(r["g"], r["o"]): r["upto_x"] for r in running_totals(df, "o", ["x"], by=["g"]).collect()}
    seen = {"a": 0, "b": 0}
    for group, order, amount in sorted(data, key=lambda row: row[1]):
        seen[group] += amount
        assert found[group, order] == seen[group]
    (edges,) = range_edges(df, [F.col("o")])
    assert edges == sorted(set(edges)) and 400 < len(edges) < 512


def test_positions_are_complete(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"))
    found = with_position(df, "v").collect()
    assert sorted(r["position"] for r in found) == list(range(1, 1001))
    assert all(r["position"] == r["v"] + 1 for r in found)


def brute_auc(labels, scores, value):
    inside = np.array([s for l, s in zip(labels, scores) if l == value])
    outside = np.array([s for l, s in zip(labels, scores) if l != value])
    wins = (inside[:, None] > outside[None, :]).sum() + (inside[:, None] == outside[None, :]).sum() / 2
    return wins / (len(inside) * len(outside))


def test_auc_with_ties(spark):
    draw = random.Random(5)
    labels = [draw.choice([0, 0, 1, 2]) for _ in range(400)]
    scores = [0.5 if draw.random() < 0.4 else round(draw.random(), 2) + label / 10 for label in labels]
    other = [draw.random() for _ in labels]
    df = spark.createDataFrame(list(zip(labels, scores, other)), "label int, s double, o double")
    found = {r["class"]: r["auc"] for r in metrics.auc_one_vs_rest(df, {0: "o", 1: "s", 2: "s"}).collect()}
    assert math.isclose(found[0], brute_auc(labels, other, 0))
    assert math.isclose(found[1], brute_auc(labels, scores, 1))
    assert math.isclose(found[2], brute_auc(labels, scores, 2))


def test_metrics_equal_the_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    draw = random.Random(9)
    data = [(float(draw.choice([0, 1, 1, 2])), float(draw.choice([0, 1, 3]))) for _ in range(300)]
    df = spark.createDataFrame(data, "label double, prediction double")
    found = metrics.classification_metrics(df).first()
    names = {"accuracy": "accuracy", "f1": "f1", "weightedPrecision": "weighted_precision", "weightedRecall": "weighted_recall"}
    for metric, name in names.items():
        assert math.isclose(MulticlassClassificationEvaluator(metricName=metric).evaluate(df), found[name])


def test_fold_rare_keeps_hot_small_and_null_groups(spark):
    data = [("hot",)] * 500 + [(f"k{i % 400}",) for i in range(800)] + [(None,)] * 12
    df = spark.createDataFrame(data, "k string")
    found = {r["k"]: r["count"] for r in fold_rare(df, "k", 10).groupBy("k").count().collect()}
    assert found == {"hot": 500, "": 12, "Otros": 800}


def test_top_k_per_group_of_a_hot_group(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1500, "hot").otherwise("cold").alias("g"), "id")
    found = totals.top_k_per_group(df, ["g"], [F.desc("id")], 2).collect()
    assert sorted((r["g"], r["rank"], r["id"]) for r in found) == [
        ("cold", 1, 1999), ("cold", 2, 1998), ("hot", 1, 1499), ("hot", 2, 1498),
    ]
