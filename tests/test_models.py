"""What fitted models must satisfy, whatever they have learnt."""

import math

import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from __spark_entry__ import queries
from casewise.operators import classify, cluster, features, series
from casewise.sources import bindings

BUILD = queries()
MODEL_DIR = "/root/testdata/sf0.01"


def test_variance_shares_sum_to_one(spark, sf_dir):
    found = BUILD["pca_variance"](spark, sf_dir).collect()
    assert len(found) == 64
    assert math.isclose(sum(r["share"] for r in found), 1.0, abs_tol=1e-3)


def test_kept_components_of_the_rule(spark):
    shares = spark.createDataFrame([(1, 0.5), (2, 0.31), (3, 0.1), (4, 0.09)], "component int, variance double")
    found = cluster.choose_components(series.cumulative_share(shares, "component", "variance")).first()
    assert found.asDict() == {"n": 4, "k_reported": 2, "k_kept": 3, "k_chosen": 3, "k_above_even": 2}


def test_elbow_costs_are_finite(spark, sf_dir):
    found = BUILD["kmeans_elbow"](spark, sf_dir).collect()
    assert [r["k"] for r in sorted(found)] == list(range(2, 11))
    assert all(r["wcss"] >= 0 and math.isfinite(r["wcss"]) for r in found)


def test_kmeans_assigns_the_nearest_center(spark, sf_dir):
    vectors = bindings.embeddings(spark, sf_dir).select(
        "vec_id", "embedding", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    model = cluster.fit_kmeans(vectors, "features", 4)
    placed = model.transform(vectors).select("vec_id", "cluster", vector_to_array("features").alias("point"))
    found = cluster.nearest_centroid(placed, "point", cluster.kmeans_centroids(model, spark), "cluster")
    assert found.where(F.col("nearest") != F.col("cluster")).count() == 0
    assert math.isclose(
        found.agg(F.sum("sq_distance")).first()[0], model.summary.trainingCost, rel_tol=1e-6
    )


def test_many_centers(spark):
    points = spark.createDataFrame([([float(i) + 0.2],) for i in range(50)], "v array<double>")
    centers = spark.createDataFrame([(i, [float(i)]) for i in range(1500)], "id int, centroid array<double>")
    found = cluster.nearest_centroid(points, "v", centers, "id").collect()
    assert sorted(r["nearest"] for r in found) == list(range(50))


@pytest.mark.parametrize("name, least", [("lr_classify", 0.65), ("rf_classify", 0.8), ("lr_text_classify", 0.9)])
def test_model_beats_the_majority(name, least, spark):
    found = BUILD[name](spark, MODEL_DIR).first()
    assert least < found["accuracy"] <= 1.0
    assert 0.5 < found["weighted_auc"] <= 1.0


def test_importance_sums_to_one_per_source(spark, sf_dir):
    found = {r["source"]: r for r in BUILD["rf_importance"](spark, sf_dir).collect()}
    assert set(found) == {"n_chars", "n_tokens", "non_ascii_share"}
    assert math.isclose(sum(r["importance"] for r in found.values()), 1.0, abs_tol=1e-5)


def test_importance_of_a_one_hot_block_is_one_number(spark):
    data = [(i % 50, f"d{i % 4}", i % 7, float(i % 4 == 0)) for i in range(400)]
    df = spark.createDataFrame(data, "week int, dept string, cases int, label double")
    _, ready = features.prepared(df, features.feature_stages(["week"], "dept", ["cases"]))
    model = classify.forest(trees=5, depth=3).fit(ready)
    names = features.slot_names(ready)
    found = {r["source"]: r for r in classify.importance_by_source(model, names, ["week", "dept", "cases"], spark).collect()}
    assert {name: r["slots"] for name, r in found.items()} == {"week": 1, "dept": 5, "cases": 1}
    assert max(found, key=lambda name: found[name]["importance"]) == "dept"


def test_grid_has_every_setting_and_one_winner(spark, sf_dir):
    found = BUILD["cv_grid"](spark, sf_dir).collect()
    assert sorted((r["max_depth"], r["num_trees"]) for r in found) == [(5, 20), (5, 50), (10, 20), (10, 50)]
    assert all(0.0 <= r["f1"] <= 1.0 for r in found)
    best = [r for r in found if r["best"]]
    assert len(best) == 1 and best[0]["f1"] == max(r["f1"] for r in found)


def test_search_keeps_only_what_it_fits(spark):
    rows = spark.range(60).select("id", (F.col("id") % 2).cast("double").alias("label"), F.lit("wide").alias("text"))
    rows = rows.withColumn("features", array_to_vector(F.array("label")))
    search = classify.cross_validate(rows, "id", depths=(2,), trees=(1,), features="features")
    kept = set(search.bestModel.summary.predictions.columns)
    assert {"features", "label"} <= kept and not {"id", "text"} & kept
    assert search.bestModel.summary.predictions.count() == 60


def test_terms_speak_for_and_against_each_class(spark, sf_dir):
    found = BUILD["lr_text_coefficients"](spark, sf_dir).collect()
    assert {(r["class"], r["side"]) for r in found} == {(c, s) for c in ("en", "fr", "de", "es") for s in ("for", "against")}
    assert all(r["weight"] >= 0 for r in found if r["side"] == "for")


def test_split_does_not_depend_on_the_partitions(spark):
    df = spark.range(1000)
    wide, narrow = df.repartition(13), df.coalesce(1)
    for part in (wide, narrow):
        assert part.where(features.in_train("id")).agg(F.sum("id")).first() == df.where(features.in_train("id")).agg(F.sum("id")).first()
    assert [r[0] for r in features.sample_n(wide, "id", 5).collect()] == [r[0] for r in features.sample_n(narrow, "id", 5).collect()]
