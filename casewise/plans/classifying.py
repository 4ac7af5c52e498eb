"""Classifiers of documents, from numbers and from terms."""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from casewise.functions.domain import STOP_WORDS_ES
from casewise.functions.text import tokens
from casewise.operators import classify, features, metrics, tfidf
from casewise.plans.registry import REGISTRY
from casewise.plans.scoring import DRAW
from casewise.sources import bindings
from casewise.sources.readers import literal_table, table
from casewise.sources.storage import staged, staged_for_rounds

NUMBERS = ["n_chars", "n_tokens", "non_ascii_share"]
TERMS = 3000


def _numbers(spark, sf_dir):
    """Train and test rows with scaled numbers, and the languages in label order.

    Scaling and labels are fitted on the train rows. The numbers are written once: the texts are
    read for them alone, and every fit reads the numbers many times.
    """
    numbers = bindings.document_numbers(spark, sf_dir).withColumn("train", features.in_train("doc_id"))
    docs = staged_for_rounds(numbers, "numbers")
    labels = features.indexer("lang", "label").fit(docs.where("train"))
    _, prepared = features.prepared(labels.transform(docs), features.numeric_stages(NUMBERS), F.col("train"))
    kept = prepared.select("doc_id", "lang", "label", "features", "scaled", "train")
    return kept.where("train"), kept.where(~F.col("train")), list(labels.labels)


def _scored(predicted, classes):
    """Metrics and weighted area of a set of predictions, as one row."""
    scored, names = classify.evaluation_rows(predicted, classes)
    area = metrics.weighted_auc(metrics.auc_one_vs_rest(scored, names)).scalar()
    return _rounded(metrics.classification_metrics(scored).withColumn("weighted_auc", area))


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


@REGISTRY.add("lr_classify")
def lr_classify(spark, sf_dir):
    train, test, labels = _numbers(spark, sf_dir)
    return _scored(classify.logistic().fit(train).transform(test), len(labels))


@REGISTRY.add("rf_classify")
def rf_classify(spark, sf_dir):
    train, test, labels = _numbers(spark, sf_dir)
    return _scored(classify.forest().fit(train).transform(test), len(labels))


# An unpenalised intercept makes the mean probability of each class on the train rows its share.
SHARES_SQL = f"""with split as (select lang, {DRAW} < 80 as train from documents)
select lang, count(*) as n, round(count(*)::double / sum(count(*)) over (), 6) as share, true as met from split where train group by lang"""


def _mean_probabilities(model, train, labels):
    """Rows and share of each class, and whether the mean probability is within a thousandth of it."""
    spread, names = classify.with_class_scores(model.transform(train), len(labels))
    found = spread.agg(
        F.count("*").cast("double").alias("rows"),
        *[F.avg(name).alias(name) for name in names.values()],
        *[F.count_if(F.col("label") == i).alias(f"n_{i}") for i in names],
    )

    def row(i, label):
        share = F.col(f"n_{i}") / F.col("rows")
        met = F.abs(F.col(names[i]) - share) < 1e-3
        return F.struct(F.lit(label).alias("lang"), F.col(f"n_{i}").alias("n"), F.round(share, 6).alias("share"), met.alias("met"))

    return found.select(F.inline(F.array(*[row(i, label) for i, label in enumerate(labels)])))


@REGISTRY.add("lr_mean_probability", SHARES_SQL)
def lr_mean_probability(spark, sf_dir):
    train, _, labels = _numbers(spark, sf_dir)
    return _mean_probabilities(classify.logistic().setTol(1e-9).fit(train), train, labels)


@REGISTRY.add("lr_text_mean_probability", SHARES_SQL)
def lr_text_mean_probability(spark, sf_dir):
    model, _, kept, labels = _text_model(spark, sf_dir, tol=1e-9)
    return _mean_probabilities(model, kept.where("train"), labels)


@REGISTRY.add(
    "lr_text_coefficient_sums",
    f"""select lang, true as centered, true as ordered, count(*) as rows from (select lang, {DRAW} < 80 as train from documents)
where train group by lang""",
)
def lr_text_coefficient_sums(spark, sf_dir):
    """Weights of a penalised multinomial fit add up to 0 over the classes, and listed terms are in order."""
    model, vocabulary, _, labels = _text_model(spark, sf_dir)
    sums = model.coefficientMatrix.toArray().sum(axis=0)
    terms = classify.strongest_terms(model, vocabulary.terms, labels, 5, spark)
    by_class = terms.groupBy(F.col("class").alias("lang")).agg(
        (F.min(F.when(F.col("side") == "for", F.col("weight"))) >= F.max(F.when(F.col("side") == "against", F.col("weight")))).alias("ordered")
    )
    names = literal_table(spark, list(enumerate(labels)), "place int, lang string")
    fitted = _fitted_rows(model).join(names, F.col("label") == F.col("place")).select("lang", "rows")
    return by_class.join(fitted, "lang").select("lang", F.lit(bool(abs(sums).max() < 1e-6)).alias("centered"), "ordered", "rows")


def _fitted_rows(model):
    """(label, rows): what a model was really fitted on."""
    return model.summary.predictions.groupBy("label").agg(F.count("*").alias("rows"))


def _decided(spark, sf_dir):
    """Sales lines whose label is decided by one of two features."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber").alias("row_key"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        (F.col("l_quantity") > 25).cast("double").alias("label"),
    )
    return VectorAssembler(inputCols=["quantity", "discount"], outputCol="scaled").transform(lines)


def _small_forest():
    return classify.forest(trees=5, depth=6).setFeatureSubsetStrategy("all")


@REGISTRY.add(
    "rf_decided_label",
    "select (l_quantity > 25)::int as label, count(*) as n, count(*) as hits from lineitem group by 1",
)
def rf_decided_label(spark, sf_dir):
    """A forest on a feature that decides the label is right for every row."""
    rows = staged_for_rounds(_decided(spark, sf_dir), "decided")
    found = _small_forest().fit(rows).transform(rows)
    return found.groupBy(F.col("label").cast("int").alias("label")).agg(
        F.count("*").alias("n"), F.count_if(F.col("prediction") == F.col("label")).alias("hits")
    )


@REGISTRY.add(
    "rf_decided_importance",
    """select source, importance, count(*) filter (l_quantity <= 25) as low_rows, count(*) filter (l_quantity > 25) as high_rows
from lineitem, (values ('discount', 0.0::double), ('quantity', 1.0::double)) as f(source, importance) group by source, importance""",
)
def rf_decided_importance(spark, sf_dir):
    """All importance lies on the feature that decides the label; it adds up to 1."""
    rows = staged_for_rounds(_decided(spark, sf_dir), "decided")
    model = _small_forest().fit(rows)
    found = classify.importance_by_source(model, ["quantity", "discount"], ["quantity", "discount"], spark)
    rows = _fitted_rows(model).agg(
        F.sum(F.when(F.col("label") == 0, F.col("rows"))).alias("low_rows"), F.sum(F.when(F.col("label") == 1, F.col("rows"))).alias("high_rows")
    )
    counts = [rows.select(name).scalar().alias(name) for name in rows.columns]
    return found.select("source", F.round("importance", 6).alias("importance"), *counts)


@REGISTRY.add(
    "cv_decided_grid",
    """select depth as max_depth, trees as num_trees, 1.0::double as f1, depth = 3 and trees = 2 as best,
       (select count(*) from lineitem) as rows, (select count(*) from lineitem where l_quantity > 25) as high_rows
from (values (3), (4)) as d(depth), (values (2), (3)) as t(trees)""",
)
def cv_decided_grid(spark, sf_dir):
    """Every setting of the grid is right on a decided label, and the first of equals wins."""
    rows = staged_for_rounds(_decided(spark, sf_dir).drop("discount"), "decided")
    only = VectorAssembler(inputCols=["quantity"], outputCol="features").transform(rows)
    search = classify.cross_validate(only, "row_key", depths=(3, 4), trees=(2, 3), features="features")
    fitted = _fitted_rows(search.bestModel)
    counts = fitted.agg(F.sum("rows").alias("rows"), F.sum(F.col("rows") * F.col("label").cast("long")).alias("high_rows"))
    counts = [counts.select(name).scalar().alias(name) for name in counts.columns]
    return _rounded(classify.grid_results(search, spark)).select("*", *counts)


@REGISTRY.add(
    "model_comparison_decided",
    """select model, 1.0::double as accuracy, 1.0::double as f1, 1.0::double as weighted_precision,
       1.0::double as weighted_recall, 1.0::double as weighted_auc, count(*) as fitted_rows, count(*) as scored_rows,
       count(*) filter (l_quantity > 25) as high_hits
from lineitem, (values ('logistic regression'), ('random forest')) as m(model) group by model""",
)
def model_comparison_decided(spark, sf_dir):
    """Both kinds of model are right on a decided label."""
    rows = staged_for_rounds(_decided(spark, sf_dir), "decided")
    models = {"logistic regression": classify.logistic(reg=0.0).fit(rows), "random forest": _small_forest().fit(rows)}
    scored = {name: classify.evaluation_rows(model.transform(rows), 2) for name, model in models.items()}
    counted = None
    for name, model in models.items():
        hits = F.count_if((F.col("label") == 1) & (F.col("prediction") == 1)).alias("high_hits")
        found = model.transform(rows).agg(F.count("*").alias("scored_rows"), hits).withColumn("model", F.lit(name))
        found = found.withColumn("fitted_rows", _fitted_rows(model).agg(F.sum("rows")).scalar())
        counted = found if counted is None else counted.unionByName(found)
    return _rounded(classify.compare_models(scored)).join(counted, "model")


@REGISTRY.add("rf_importance")
def rf_importance(spark, sf_dir):
    train, _, _ = _numbers(spark, sf_dir)
    model = classify.forest().fit(train)
    found = classify.importance_by_source(model, features.slot_names(train), NUMBERS, spark)
    return _rounded(found).orderBy(F.desc("importance"))


@REGISTRY.add("cv_grid")
def cv_grid(spark, sf_dir):
    train, _, _ = _numbers(spark, sf_dir)
    return _rounded(classify.grid_results(classify.cross_validate(train, "doc_id"), spark))


@REGISTRY.add("model_comparison")
def model_comparison(spark, sf_dir):
    train, test, labels = _numbers(spark, sf_dir)
    models = {
        "logistic regression": classify.logistic().fit(train),
        "random forest": classify.forest().fit(train),
        "random forest, tuned": classify.cross_validate(train, "doc_id").bestModel,
    }
    scored = {name: classify.evaluation_rows(model.transform(test), len(labels)) for name, model in models.items()}
    return _rounded(classify.compare_models(scored))


@REGISTRY.add(
    "lr_single_binary",
    """with cells as (select (l_linenumber <= 3)::int as x, avg((l_returnflag = 'R')::int) as p from lineitem group by 1),
odds as (select max(ln(p / (1 - p))) filter (x = 0) as zero, max(ln(p / (1 - p))) filter (x = 1) as one from cells)
select round(one - zero, 4) as coefficient, round(zero, 4) as intercept from odds""",
)
def lr_single_binary(spark, sf_dir):
    """One yes/no feature: the fit must give the log-odds of the two cells."""
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_linenumber") <= 3).cast("double").alias("x"), (F.col("l_returnflag") == "R").cast("double").alias("label")
    )
    assembled = VectorAssembler(inputCols=["x"], outputCol="features").transform(lines)
    model = classify.logistic("features", reg=0.0).setTol(1e-12).fit(assembled)
    return spark.createDataFrame(
        [(round(float(model.coefficients[0]), 4), round(float(model.intercept), 4))],
        "coefficient double, intercept double",
    )


def _text_model(spark, sf_dir, tol=1e-6):
    """The model fitted on the train part, its vocabulary, all documents as weighted terms, and the languages.

    Vocabulary and weights come from the train rows only.
    """
    docs = bindings.documents(spark, sf_dir, heavy=True).select(
        "doc_id", "lang", tokens("text", stop_words=STOP_WORDS_ES).alias("tokens"), features.in_train("doc_id").alias("train")
    )
    docs = staged(docs, "tokens")
    labels = features.indexer("lang", "label").fit(docs.where("train"))
    vocabulary = tfidf.fit_vocabulary(docs.where("train"), size=TERMS)
    counted = tfidf.weighed(tfidf.term_vectors(labels.transform(docs), vocabulary), vocabulary)
    kept = staged_for_rounds(counted.select("doc_id", "lang", "label", "features", "train"), "term-vectors")
    model = classify.logistic("features", family="multinomial").setTol(tol).fit(kept.where("train"))
    return model, vocabulary, kept, list(labels.labels)


@REGISTRY.add("lr_text_classify")
def lr_text_classify(spark, sf_dir):
    model, _, kept, labels = _text_model(spark, sf_dir)
    return _scored(model.transform(kept.where(~F.col("train"))), len(labels))


@REGISTRY.add("lr_text_coefficients")
def lr_text_coefficients(spark, sf_dir):
    model, vocabulary, _, labels = _text_model(spark, sf_dir)
    return _rounded(classify.strongest_terms(model, vocabulary.terms, labels, 5, spark))
