"""Classifiers, what they learnt, and how they compare."""

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from casewise.operators.features import draw
from casewise.operators.metrics import auc_one_vs_rest, classification_metrics, weighted_auc
from casewise.operators.totals import top_k_per_group
from casewise.sources.readers import literal_table
from casewise.sources.storage import staged


def logistic(features: str = "scaled", label: str = "label", reg: float = 0.1, family: str = "auto") -> LogisticRegression:
    return LogisticRegression(
        featuresCol=features, labelCol=label, maxIter=100, regParam=reg, elasticNetParam=0.0, family=family
    )


def forest(features: str = "scaled", label: str = "label", trees: int = 50, depth: int = 10) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=features, labelCol=label, numTrees=trees, maxDepth=depth, seed=42, featureSubsetStrategy="sqrt"
    )


def with_class_scores(predicted: DataFrame, classes: int) -> tuple[DataFrame, dict[int, str]]:
    """Probability of each class as a column, and the name of that column per class."""
    names = {c: f"score_{c}" for c in range(classes)}
    spread = vector_to_array("probability")
    return predicted.withColumns({name: F.get(spread, F.lit(c)) for c, name in names.items()}), names


def evaluation_rows(predicted: DataFrame, classes: int, name: str = "scored") -> tuple[DataFrame, dict[int, str]]:
    """Label, prediction and class scores of a model's predictions, written once, so it scores each row once."""
    spread, names = with_class_scores(predicted, classes)
    return staged(spread.select("label", "prediction", *names.values()), name), names


def importance_by_source(
    model: RandomForestClassificationModel, slots: Sequence[str], sources: Sequence[str], spark
) -> DataFrame:
    """Feature importance summed per source column.

    ``slots`` names every vector slot; a slot belongs to the source it is named after, a one-hot
    slot being named ``<source>_<value>``.
    """
    weights = literal_table(
        spark,
        [(_source_of(slot, sources), float(w)) for slot, w in zip(slots, model.featureImportances.toArray())],
        "source string, weight double",
    )
    return weights.groupBy("source").agg(F.sum("weight").alias("importance"), F.count("*").alias("slots"))


def _source_of(slot: str, sources: Sequence[str]) -> str:
    owners = [s for s in sources if slot == s or slot.startswith(f"{s}_")]
    return max(owners, key=len) if owners else slot


def cross_validate(
    train: DataFrame,
    key: str,
    depths: Sequence[int] = (5, 10),
    trees: Sequence[int] = (20, 50),
    folds: int = 3,
    features: str = "scaled",
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Grid search of a forest by weighted F1. Folds follow from the row key alone.

    Only the columns that a fit and its score read are kept, as the search caches the rows of a fold.
    """
    estimator = forest(features)
    grid = ParamGridBuilder().addGrid(estimator.maxDepth, list(depths)).addGrid(estimator.numTrees, list(trees)).build()
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="f1"),
        numFolds=folds,
        seed=42,
        parallelism=parallelism,
        foldCol="fold",
    )
    return search.fit(train.select(features, "label", draw(key, seed=7, parts=folds).cast("int").alias("fold")))


def grid_results(search: CrossValidatorModel, spark) -> DataFrame:
    """One row per setting with its mean F1, and which one won."""
    rows = [
        (*[int(settings[p]) for p in sorted(settings, key=lambda p: p.name)], float(metric))
        for settings, metric in zip(search.getEstimatorParamMaps(), search.avgMetrics)
    ]
    table = literal_table(spark, rows, "max_depth int, num_trees int, f1 double")
    # the search itself keeps the first setting among equals
    winner = max(range(len(rows)), key=lambda i: (rows[i][2], -i))
    is_winner = (F.col("max_depth") == rows[winner][0]) & (F.col("num_trees") == rows[winner][1])
    return table.withColumn("best", is_winner)


def compare_models(scored: Mapping[str, tuple[DataFrame, Mapping[int, str]]]) -> DataFrame:
    """One row of metrics and the weighted area per named set of evaluation rows."""
    rows = None
    for name, (frame, names) in scored.items():
        area = weighted_auc(auc_one_vs_rest(frame, names)).scalar()
        row = classification_metrics(frame).select(F.lit(name).alias("model"), "*", area.alias("weighted_auc"))
        rows = row if rows is None else rows.unionByName(row)
    return rows


def strongest_terms(model: LogisticRegressionModel, terms: Sequence[str], labels: Sequence[str], k: int, spark):
    """The ``k`` terms that speak most for and most against each class."""
    weights = model.coefficientMatrix.toArray()
    rows = [
        (labels[c], terms[i], float(weights[c][i])) for c in range(min(len(labels), len(weights))) for i in range(len(terms))
    ]
    table = literal_table(spark, rows, "class string, term string, weight double")
    top = top_k_per_group(table, ["class"], [F.desc("weight"), F.asc("term")], k)
    bottom = top_k_per_group(table, ["class"], [F.asc("weight"), F.asc("term")], k)
    return top.withColumn("side", F.lit("for")).unionByName(bottom.withColumn("side", F.lit("against")))
