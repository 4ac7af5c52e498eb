"""Leading components against the full decomposition, and kept sketches against the rows."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from casewise.operators import sketches
from casewise.operators.subspace import leading_components, projected, sparse_rows, tree_sum, _block


def sparse(spark, matrix, parts=4):
    rows = [(i, Vectors.sparse(matrix.shape[1], {j: float(x) for j, x in enumerate(row) if x}) if i % 2 else Vectors.dense(row.tolist())) for i, row in enumerate(matrix)]
    return spark.createDataFrame([*rows, (-1, None)], ["id", "v"]).repartition(parts)


@pytest.mark.parametrize("width, k", [(300, 6), (12, 12), (40, 3)])
def test_components_are_those_of_the_covariance(spark, width, k):
    rng = np.random.default_rng(width)
    matrix = rng.standard_normal((200, width)) * (rng.random((200, width)) < 0.2) * np.linspace(6, 0.2, width) ** 2
    found = leading_components(sparse_rows(sparse(spark, matrix), "v"), width, k)
    values, vectors = np.linalg.eigh(np.cov(matrix.T))
    assert found.rows == 200 and abs(found.total - values.sum()) < 1e-9 * values.sum()
    assert np.abs(found.variances - values[::-1][:k]).max() < 1e-6 * values[-1]
    lined_up = np.abs((vectors[:, ::-1][:, :k] * found.basis).sum(axis=0))
    assert lined_up.min() > 0.999
    along = {r["id"]: r["components"] for r in projected(sparse(spark, matrix), "v", found).collect()}
    assert along.pop(-1) is None
    assert max(np.abs(np.array(along[i]) - matrix[i] @ found.basis).max() for i in along) < 1e-9


def test_no_rows_and_equal_rows(spark):
    empty = spark.createDataFrame([], "indices array<int>, values array<double>")
    found = leading_components(empty, 5, 2)
    assert found.rows == 0 and found.total == 0 and found.variances.tolist() == [0, 0]
    assert [r["variance"] for r in found.shares(spark).collect()] == [0.0, 0.0]
    equal = spark.createDataFrame([([0, 3], [1.0, 2.0])] * 9, "indices array<int>, values array<double>")
    assert np.abs(leading_components(equal, 5, 2).variances).max() < 1e-12


def test_a_tree_of_sums(spark):
    blocks = spark.range(1100, numPartitions=1100).mapInArrow(
        lambda batches: (_block(np.array(b.column(0).to_numpy(), float)) for b in batches if len(b)), "block binary"
    )
    assert tree_sum(blocks, 1100).tolist() == [1100 * 1099 / 2]


def test_merged_states_keep_their_bounds(spark):
    df = spark.range(60_000, numPartitions=6).select(
        (F.col("id") % 50).alias("week"), (F.col("id") % 2).alias("year"), (F.col("id") * 7919 % 60_013).alias("x"), (F.col("id") % 9000).alias("item")
    )
    states = sketches.group_states(df, ["year", "week"], "x", "item")
    merged = sketches.merged_states(states, ["year"])
    points = {"low": 0.1, "mid": 0.5, "high": 0.99}
    found = sketches.answers(merged, ["year"], points)
    for row in sketches.rank_bounds(df, ["year"], "x", found, points).collect():
        assert row["n"] == 30_000 and max(row[p] for p in points) < 0.01
    assert all(r["rows"] == 30_000 and abs(r["distinct"] - 4500) < 225 for r in found.collect())
    sizes = states.agg(F.max(F.length("quantiles")), F.max(F.length("items"))).first()
    assert max(sizes) < 70_000


def test_states_of_nulls(spark):
    df = spark.createDataFrame([("a", None, None), ("a", float("nan"), None), ("b", 2.0, "x"), ("b", None, "x")], "g string, x double, item string")
    states = sketches.group_states(df, ["g"], "x", "item")
    rows = {r["g"]: r for r in sketches.answers(states, ["g"], {"mid": 0.5}).collect()}
    assert rows["a"]["rows"] == 2 and rows["a"]["mid"] is None and rows["b"]["mid"] == 2.0 and rows["b"]["distinct"] == 1
    whole = sketches.answers(sketches.merged_states(states), [], {"mid": 0.5}).first()
    assert whole["rows"] == 4 and whole["mid"] == 2.0 and whole["distinct"] == 1
