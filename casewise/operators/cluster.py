"""Components, clusters, and the rules that choose how many of each."""

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from casewise.functions.cleaning import percent
from casewise.operators.series import step_delta
from casewise.operators.totals import top_k_per_group
from casewise.sources.readers import literal_table


def fit_pca(df: DataFrame, features: str, k: int) -> PCAModel:
    return PCA(k=k, inputCol=features, outputCol="components").fit(df)


def explained_variance(model: PCAModel, spark) -> DataFrame:
    """(component, variance): the explained share of every component, from 1."""
    shares = [(i, float(share)) for i, share in enumerate(model.explainedVariance.toArray(), 1)]
    return literal_table(spark, shares, "component int, variance double")


def choose_components(ranked: DataFrame, kept: float = 0.90, reported: float = 0.80, least: int = 3) -> DataFrame:
    """How many components to keep, from (rank, share, cum_share), as one row.

    Keeps the first rank that reaches ``kept``, at least ``least``; also reports the rank that
    reaches ``reported`` and how many shares exceed the even share 1/n.
    """
    first = F.min(F.when(F.col("cum_share") >= kept, F.col("rank")))
    n = F.max("rank")
    even = ranked.agg(F.try_divide(F.lit(1.0), F.max("rank"))).scalar()
    return ranked.agg(
        n.alias("n"),
        F.min(F.when(F.col("cum_share") >= reported, F.col("rank"))).alias("k_reported"),
        first.alias("k_kept"),
        F.greatest(F.lit(least), F.least(first, n)).alias("k_chosen"),
        F.count_if(F.col("share") > even).alias("k_above_even"),
    )


def first_components(df: DataFrame, features: str, model: PCAModel, k: int) -> DataFrame:
    """``components``, the first ``k`` of a fitted model with at least as many: the fit is not repeated."""
    weights = model.pc.toArray()[:, :k].T.tolist()
    values = vector_to_array(features)

    def dot(weight):
        products = F.zip_with(values, F.array(*[F.lit(float(w)) for w in weight]), lambda a, b: a * b)
        return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)

    return df.withColumn("components", array_to_vector(F.array(*[dot(w) for w in weights])))


def project(model: PCAModel, df: DataFrame) -> DataFrame:
    """Rows with their ``components`` as an array."""
    return model.transform(df).withColumn("components", vector_to_array("components"))


def fit_kmeans(df: DataFrame, features: str, k: int, seed: int = 42) -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(df)


def elbow_costs(
    df: DataFrame, features: str, ks: Sequence[int], seed: int = 42, parallelism: int = 4
) -> DataFrame:
    """(k, wcss): one fit per ``k``, several at a time, all on one copy of the vectors.

    Pass vectors that are staged: a lost cache block is then read again, not computed again.
    """
    vectors = df.select(features).persist()

    @inheritable_thread_target(df.sparkSession)
    def cost(k: int) -> tuple[int, float]:
        return k, float(fit_kmeans(vectors, features, k, seed).summary.trainingCost)

    try:
        with ThreadPool(parallelism) as pool:
            costs = pool.map(cost, ks)
    finally:
        vectors.unpersist()
    return literal_table(df.sparkSession, costs, "k int, wcss double")


def elbow_choice(costs: DataFrame, threshold: float = 0.15, default: int = 3, rule: str = "customary") -> DataFrame:
    """The chosen ``k`` from (k, wcss), with every step's relative gain.

    Both rules take the first ``k`` whose gain over the one before is below ``threshold`` of the
    first cost. Rule ``customary`` falls back to ``default`` and then mistakes a real answer
    equal to ``default`` for that fallback, taking the ``k`` of the largest gain instead. Rule
    ``first_below`` takes the largest gain only if no step is below the threshold.
    """
    if rule not in ("customary", "first_below"):
        raise ValueError(f"unknown rule: {rule}")
    steps = step_delta(costs, "k", "wcss")
    gain = F.struct(F.col("delta"), -F.col("k"))
    found = steps.where(F.col("delta").isNotNull()).agg(
        F.min(F.when(F.col("delta") < threshold, F.col("k"))).alias("below"), F.max_by("k", gain).alias("largest")
    )
    if rule == "customary":
        answer = F.coalesce(F.col("below"), F.lit(default))
        chosen = F.when(answer != default, answer).otherwise(F.coalesce(F.col("largest"), F.lit(default)))
    else:
        chosen = F.coalesce("below", "largest", F.lit(default))
    return steps.withColumn("chosen", found.select(chosen).scalar())


def group_sizes(df: DataFrame, group: str) -> DataFrame:
    sizes = df.groupBy(group).agg(F.count("*").alias("n"))
    return sizes.withColumn("pct", percent(F.col("n"), sizes.agg(F.sum("n")).scalar()))


def group_profile(df: DataFrame, group: str, category: str, k: int = 3) -> DataFrame:
    """The ``k`` most frequent categories of every group, ties by name.

    ``pct_of_group`` is relative to the whole group, ``pct_of_top`` to the listed categories.
    """
    counts = df.groupBy(group, category).agg(F.count("*").alias("n"))
    sizes = counts.groupBy(group).agg(F.sum("n").alias("size"))
    top = top_k_per_group(counts, [group], [F.desc("n"), F.asc(category)], k)
    listed = top.groupBy(group).agg(F.sum("n").alias("listed"))
    return (
        top.join(sizes, group)
        .join(listed, group)
        .select(
            group, "rank", category, "n",
            percent(F.col("n"), F.col("size")).alias("pct_of_group"),
            percent(F.col("n"), F.col("listed")).alias("pct_of_top"),
        )
    )


def centroids(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector of every group as an array of doubles."""
    values = array_to_vector(F.col(vector).cast("array<double>"))
    return df.groupBy(group).agg(vector_to_array(Summarizer.mean(values)).alias("centroid"))


def kmeans_centroids(model: KMeansModel, spark) -> DataFrame:
    """Centroids of a fitted model, one row per cluster."""
    rows = [(i, [float(x) for x in center]) for i, center in enumerate(model.clusterCenters())]
    return literal_table(spark, rows, "cluster int, centroid array<double>")


def nearest_centroid(df: DataFrame, vector: str, centers: DataFrame, center_id: str) -> DataFrame:
    """Add ``nearest``, the id of the closest centroid, and ``sq_distance``.

    The centroids, as few as a fit can hold, travel as one array value to every task and each row is
    compared in place, with no join.
    """
    gathered = centers.agg(F.collect_list(F.struct(F.col(center_id).alias("id"), F.col("centroid").alias("at")))).scalar()

    def distance(center):
        squares = F.zip_with(vector, center["at"], lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0.0), lambda total, square: total + square)

    closest = F.array_min(
        F.transform("_centers", lambda c: F.struct(distance(c).alias("sq_distance"), c["id"].alias("nearest")))
    )
    found = df.withColumn("_centers", gathered).withColumn("_closest", closest)
    return found.select(*df.columns, "_closest.nearest", "_closest.sq_distance")
