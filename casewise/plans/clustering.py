"""Components and clusters of vectors."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from casewise.functions.text import tokens
from casewise.operators import cluster, features, series, subspace, tfidf
from casewise.plans.exploring import CUMULATIVE_SQL, _cumulative
from casewise.plans.registry import REGISTRY
from casewise.sources import bindings
from casewise.sources.readers import literal_table, table
from casewise.sources.storage import staged_for_rounds

DIMENSIONS = 64
CLUSTERS = 8


def _vectors(spark, sf_dir):
    wide = F.col("embedding").cast("array<double>")
    return bindings.embeddings(spark, sf_dir).select("vec_id", "label", array_to_vector(wide).alias("features"))


@REGISTRY.add("pca_variance")
def pca_variance(spark, sf_dir):
    model = cluster.fit_pca(_vectors(spark, sf_dir), "features", DIMENSIONS)
    shares = cluster.explained_variance(model, spark)
    return series.cumulative_share(shares, "component", "variance").select(
        "component", F.round("share", 6).alias("share"), F.round("cum_share", 6).alias("cum_share")
    )


SPREAD_SQL = "with dims as (select i, embedding[i]::double as x from embeddings, unnest(range(1, 65)) as d(i))"


@REGISTRY.add(
    "pca_total_variance",
    f"""{SPREAD_SQL}, variances as (select var_samp(x) as v from dims group by i)
select 64 as components, round(sum(v), 6) as total, 1.0::double as shares from variances""",
)
def pca_total_variance(spark, sf_dir):
    """All components keep the variance of all dimensions, and their shares add up to 1."""
    vectors = _vectors(spark, sf_dir)
    model = cluster.fit_pca(vectors, "features", DIMENSIONS)
    projected = cluster.project(model, vectors)
    kept = projected.agg(*[F.var_samp(F.get("components", F.lit(i))).alias(f"v{i}") for i in range(DIMENSIONS)])
    total = sum((F.col(f"v{i}") for i in range(DIMENSIONS)), F.lit(0.0))
    shares = sum(float(s) for s in model.explainedVariance.toArray())
    return kept.select(F.lit(DIMENSIONS).alias("components"), F.round(total, 6).alias("total"), F.round(F.lit(shares), 6).alias("shares"))


@REGISTRY.add(
    "subspace_total_variance",
    f"""{SPREAD_SQL}, variances as (select var_samp(x) as v from dims group by i)
select 64 as components, (select count(*) from embeddings) as rows, round(sum(v), 6) as total, round(sum(v), 6) as kept,
       true as as_fitted from variances""",
)
def subspace_total_variance(spark, sf_dir):
    """A basis of all dimensions keeps their variance, and gives the shares of the fit over the full covariance."""
    vectors = _vectors(spark, sf_dir)
    found = subspace.leading_components(subspace.sparse_rows(vectors, "features"), DIMENSIONS, DIMENSIONS)
    fitted = cluster.fit_pca(vectors, "features", DIMENSIONS).explainedVariance.toArray()
    as_fitted = bool(abs(found.variances / found.total - fitted).max() < 1e-6)
    row = (DIMENSIONS, found.rows, round(found.total, 6), round(float(found.variances.sum()), 6), as_fitted)
    return literal_table(spark, [row], "components int, rows long, total double, kept double, as_fitted boolean")


WIDE_TERMS = 20_000


@REGISTRY.add("wide_components")
def wide_components(spark, sf_dir):
    """Ten components of TF-IDF over 20,000 terms."""
    docs = bindings.documents(spark, sf_dir, heavy=True).select("doc_id", tokens("text").alias("tokens"))
    vocabulary = tfidf.fit_vocabulary(docs, size=WIDE_TERMS)
    weighed = tfidf.weighed(tfidf.term_vectors(docs, vocabulary), vocabulary)
    rows = subspace.sparse_rows(weighed, "features")
    return subspace.leading_components(rows, len(vocabulary.terms), 10).shares(spark)


@REGISTRY.add(
    "pca_keeps_lengths",
    """select vec_id, label, round(list_sum(list_transform(embedding, lambda x: x::double * x::double)), 5) as sq_length
from embeddings""",
)
def pca_keeps_lengths(spark, sf_dir):
    """Projected on all components, every vector keeps its length."""
    vectors = _vectors(spark, sf_dir)
    projected = cluster.project(cluster.fit_pca(vectors, "features", DIMENSIONS), vectors)
    length = F.aggregate("components", F.lit(0.0), lambda total, x: total + x * x)
    return projected.select("vec_id", "label", F.round(length, 5).alias("sq_length"))


@REGISTRY.add(
    "kmeans_covers_all",
    "select label, count(*) as n, 0::bigint as not_nearest from embeddings group by label",
)
def kmeans_covers_all(spark, sf_dir):
    """Every row is counted and lies in the cluster of its nearest center."""
    vectors = staged_for_rounds(_vectors(spark, sf_dir), "vectors")
    model = cluster.fit_kmeans(vectors, "features", CLUSTERS)
    placed = model.transform(vectors).select("label", "cluster", vector_to_array("features").alias("point"))
    found = cluster.nearest_centroid(placed, "point", cluster.kmeans_centroids(model, spark), "cluster")
    return found.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if(F.col("nearest") != F.col("cluster")).alias("not_nearest")
    )


@REGISTRY.add(
    "kmeans_two_spots",
    """select 2 as k, 0.0::double as wcss, count(*) filter (l_quantity > 25) as larger, count(*) filter (l_quantity <= 25) as smaller
from lineitem""",
)
def kmeans_two_spots(spark, sf_dir):
    """Rows on two spots: two clusters cost nothing and hold the rows of one spot each."""
    spot = F.when(F.col("l_quantity") > 25, 100.0).otherwise(0.0)
    lines = table(spark, sf_dir, "lineitem").select(array_to_vector(F.array(spot)).alias("features"), spot.alias("spot"))
    rows = staged_for_rounds(lines, "spots")
    placed = cluster.fit_kmeans(rows, "features", 2).transform(rows)
    sizes = placed.groupBy("cluster").agg(F.count("*").alias("n"), F.min("spot").alias("low"), F.max("spot").alias("high"))
    counts = sizes.where("low = high").agg(
        F.max(F.when(F.col("low") == 100, F.col("n"))).alias("larger"), F.max(F.when(F.col("low") == 0, F.col("n"))).alias("smaller")
    )
    costs = cluster.elbow_costs(rows, "features", [2])
    found = counts.select(F.struct("larger", "smaller")).scalar()
    return costs.select("k", F.round("wcss", 4).alias("wcss"), found["larger"].alias("larger"), found["smaller"].alias("smaller"))


@REGISTRY.add(
    "pca_two_feature",
    """with found as (select abs(corr(l_quantity, l_extendedprice)) as r from lineitem)
select 1 as component, round((1 + r) / 2, 6) as share from found
union all select 2, round((1 - r) / 2, 6) from found""",
)
def pca_two_feature(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    scaled = features.prepared(lines, features.numeric_stages(["l_quantity", "l_extendedprice"]))[1]
    shares = cluster.explained_variance(cluster.fit_pca(scaled, "scaled", 2), spark)
    return shares.select("component", F.round("variance", 6).alias("share"))


CHOICE_SQL = f"""{CUMULATIVE_SQL}, shares as (
  select rank, total::double / whole as share, upto::double / whole as cum_share from ranked)
select count(*) as n, min(rank) filter (cum_share >= 0.8) as k_reported, min(rank) filter (cum_share >= 0.9) as k_kept,
       greatest(3, least(min(rank) filter (cum_share >= 0.9), count(*)))::bigint as k_chosen,
       count(*) filter (share > 1.0::double / (select count(*) from shares)) as k_above_even from shares"""


@REGISTRY.add("pca_choose_k", CHOICE_SQL)
def pca_choose_k(spark, sf_dir):
    return cluster.choose_components(_cumulative(spark, sf_dir))


@REGISTRY.add("kaiser_count", f"select n, k_above_even from ({CHOICE_SQL})")
def kaiser_count(spark, sf_dir):
    return pca_choose_k(spark, sf_dir).select("n", "k_above_even")


@REGISTRY.add("pca_choose_k_vectors")
def pca_choose_k_vectors(spark, sf_dir):
    model = cluster.fit_pca(_vectors(spark, sf_dir), "features", DIMENSIONS)
    shares = cluster.explained_variance(model, spark)
    return cluster.choose_components(series.cumulative_share(shares, "component", "variance"))


@REGISTRY.add("pca_project")
def pca_project(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    projected = cluster.project(cluster.fit_pca(vectors, "features", 3), vectors)
    return projected.select(
        "vec_id", "label", *[F.round(F.col("components")[i], 6).alias(f"component_{i + 1}") for i in range(3)]
    )


@REGISTRY.add("kmeans_elbow")
def kmeans_elbow(spark, sf_dir):
    vectors = staged_for_rounds(_vectors(spark, sf_dir).select("features"), "vectors")
    costs = cluster.elbow_costs(vectors, "features", range(2, 11))
    return cluster.elbow_choice(costs).select(
        "k", F.round("wcss", 4).alias("wcss"), F.round("delta", 6).alias("delta"), "chosen"
    )


@REGISTRY.add(
    "elbow_rule",
    """with cells as (
  select k, floor((l_quantity - 1) * k / 50)::int as cell, count(*)::double as n, sum(l_quantity) as s,
         sum(l_quantity * l_quantity) as ss
  from lineitem, unnest(range(2, 11)) as ks(k) group by 1, 2),
costs as (select k::int as k, sum(ss - s * s / n) as wcss from cells group by k),
steps as (select k, wcss, (lag(wcss) over (order by k) - wcss) / first(wcss) over (order by k) as delta from costs),
answer as (select coalesce(min(k) filter (delta < 0.15), 3) as k, arg_max(k, delta) as largest from steps)
select s.k, round(wcss, 4) as wcss, round(delta, 9) as delta,
       case when answer.k <> 3 then answer.k else largest end::int as chosen from steps s, answer""",
)
def elbow_rule(spark, sf_dir):
    """The rule on the cost of cutting quantities into k equal ranges, known exactly for every k."""
    value = F.col("l_quantity")
    counts = table(spark, sf_dir, "lineitem").groupBy("l_quantity").agg(F.count("*").cast("double").alias("rows"))
    cells = (
        counts.select("*", F.explode(F.sequence(F.lit(2), F.lit(10))).alias("k"))
        .groupBy("k", F.floor((value - 1) * F.col("k") / 50).alias("cell"))
        .agg(
            F.sum("rows").alias("n"),
            F.sum(value * F.col("rows")).alias("s"),
            F.sum(value * value * F.col("rows")).alias("ss"),
        )
    )
    costs = cells.groupBy("k").agg(F.sum(F.col("ss") - F.col("s") * F.col("s") / F.col("n")).alias("wcss"))
    return cluster.elbow_choice(costs).select(
        "k", F.round("wcss", 4).alias("wcss"), F.round("delta", 9).alias("delta"), "chosen"
    )


@REGISTRY.add("kmeans_assign")
def kmeans_assign(spark, sf_dir):
    vectors = staged_for_rounds(_vectors(spark, sf_dir), "vectors")
    model = cluster.fit_kmeans(vectors, "features", CLUSTERS)
    return model.transform(vectors).select("vec_id", "label", "cluster")


CENTROID_SQL = """cells as (
  select label, i, avg(embedding[i]::double) as mean from embeddings, unnest(range(1, 65)) as dims(i) group by label, i),
centers as (select label, list(mean order by i) as centroid from cells group by label)"""


@REGISTRY.add(
    "centroids",
    f"""with {CENTROID_SQL} select label, round(centroid[1], 6) as x1, round(centroid[2], 6) as x2,
       round(centroid[3], 6) as x3 from centers""",
)
def centroids(spark, sf_dir):
    centers = cluster.centroids(bindings.embeddings(spark, sf_dir), "label", "embedding")
    return centers.select("label", *[F.round(F.col("centroid")[i], 6).alias(f"x{i + 1}") for i in range(3)])


@REGISTRY.add(
    "nearest_centroid",
    f"""with {CENTROID_SQL}, far as (
  select vec_id, e.label, c.label as nearest,
         list_sum(list_transform(list_zip(embedding, centroid), lambda p: (p[1]::double - p[2]) * (p[1]::double - p[2]))) as d
  from embeddings e, centers c)
select vec_id, any_value(label) as label, arg_min(nearest, d) as nearest, round(min(d), 6) as sq_distance
from far group by vec_id""",
)
def nearest_centroid(spark, sf_dir):
    vectors = bindings.embeddings(spark, sf_dir)
    centers = cluster.centroids(vectors, "label", "embedding")
    found = cluster.nearest_centroid(vectors, "embedding", centers, "label")
    return found.select("vec_id", "label", "nearest", F.round("sq_distance", 6).alias("sq_distance"))


@REGISTRY.add(
    "group_sizes",
    """select label, count(*) as n, round(count(*) * 100.0::double / sum(count(*)) over (), 6) as pct
from embeddings group by label""",
)
def group_sizes(spark, sf_dir):
    sizes = cluster.group_sizes(bindings.embeddings(spark, sf_dir), "label")
    return sizes.withColumn("pct", F.round("pct", 6))


@REGISTRY.add(
    "cluster_profile",
    """with counts as (select lang, source, count(*) as n from documents group by all),
ranked as (select *, row_number() over (partition by lang order by n desc, source)::int as rank,
                  sum(n) over (partition by lang) as size from counts)
select lang, rank, source, n, round(n * 100.0::double / size, 6) as pct_of_group,
       round(n * 100.0::double / sum(n) over (partition by lang), 6) as pct_of_top from ranked where rank <= 3""",
)
def cluster_profile(spark, sf_dir):
    found = cluster.group_profile(bindings.documents(spark, sf_dir), "lang", "source")
    return found.withColumns({c: F.round(c, 6) for c in ("pct_of_group", "pct_of_top")})
