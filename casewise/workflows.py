"""The three analyses end to end, over a user's own tables.

Each takes cleaned tables and gives the named result tables; ``write_tables`` saves them.
"""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from casewise.functions.domain import (
    CATEGORY_LABELS,
    DEFAULT_CATEGORY,
    RELIEF_WORDS,
    SEVERITY_WORDS,
    STOP_WORDS_ES,
    event_category_rows,
)
from casewise.functions.text import tokens
from casewise.operators import classify, cluster, corpus, features, metrics, profile, sentiment, series, tfidf, totals
from casewise.operators.lookup import attach_predictions, fold_rare, map_codes
from casewise.operators.ordered import exact_percentiles
from casewise.sources.readers import literal_table
from casewise.sources.storage import staged, staged_for_rounds, write_report


def explore_notifications(noti: DataFrame, focus_event: str, top: int = 15) -> dict[str, DataFrame]:
    """Totals, rates, profile and conclusions of cleaned notifications.

    The notifications are written once; every table below reads only the columns it needs.
    """
    noti = staged(noti, "notifications")
    focus = noti.where(F.col("event") == focus_event)
    by_event = totals.total_by(noti, ["event"], "cases")
    by_dept = totals.total_by(noti, ["dept"], "cases")
    focus_weekly = totals.total_by(focus, ["week"], "cases")
    largest_first = [F.desc("total"), F.asc("event")]
    return {
        "profile": profile.table_profile(noti),
        "focus_by_dept": totals.total_by(focus, ["dept"], "cases").orderBy(F.desc("total"), "dept"),
        "top_events": totals.top_k(by_event, largest_first, top),
        "focus_rate": totals.rate_per_group(noti, "dept", F.col("event") == focus_event, "cases"),
        "described": profile.describe_columns(noti, ["week", "dept", "cases"]),
        "cases_summary": profile.summary(noti, "cases"),
        "cases_percentiles": exact_percentiles(noti, "cases", profile.percentile_points([90, 95, 99])),
        "event_frequency": totals.top_k(
            noti.groupBy("event").agg(F.count("*").alias("n")), [F.desc("n"), F.asc("event")], 10
        ),
        "weekly_totals": totals.total_by(noti, ["week"], "cases").orderBy("week"),
        "nulls": profile.null_audit(noti),
        "duplicates": profile.exact_duplicates(noti),
        "duplicate_keys": profile.duplicate_keys(noti, ["event_code", "week", "town_code"]),
        "outliers": profile.iqr_outliers(noti, "cases"),
        "largest_values": totals.top_k(
            noti.select("event", "town", "week", "cases"),
            [F.desc("cases"), F.asc("event"), F.asc_nulls_first("town"), F.asc("week")],
            10,
        ),
        "unknown_dept": noti.where(F.col("dept") == 0).agg(F.count("*").alias("rows")),
        "focus_series": series.moving_average(focus_weekly, "week", "total"),
        "focus_peak": totals.peak(focus_weekly, "week", "total"),
        "event_concentration": totals.concentration(by_event, "event", "total", [3]),
        "dept_concentration": totals.concentration(by_dept, "dept", "total", [10]),
    }


def model_notifications(
    noti: DataFrame,
    key: str | None = None,
    codes: Sequence[tuple[int, str, int]] | None = None,
    ks: Sequence[int] = range(2, 11),
    trees: int = 50,
    depth: int = 10,
    grid_depths: Sequence[int] = (5, 10),
    grid_trees: Sequence[int] = (20, 50),
) -> dict[str, DataFrame]:
    """Components, clusters and classifiers of the event category from week, department and cases.

    ``key`` names a column that tells the rows apart; it alone decides the split. Without one, a
    hash of the whole row does, so equal rows fall on the same side. Scaling is fitted on the
    train rows. Rows of the unknown department are left out.
    """
    spark = noti.sparkSession
    codes = event_category_rows() if codes is None else codes
    outputs = [("category", "string", DEFAULT_CATEGORY), ("label", "int", CATEGORY_LABELS[DEFAULT_CATEGORY])]
    known = map_codes(noti.where(F.col("dept") != 0), "event_code", codes, outputs).select(
        (F.xxhash64(*noti.columns) if key is None else F.col(key)).alias("row_key"),
        "category",
        F.col("label").cast("double").alias("label"),
        "week",
        F.col("dept").cast("string").alias("dept"),
        "cases",
    )
    known = staged(known.withColumn("train", features.in_train("row_key")), "known")
    _, ready = features.prepared(known, features.feature_stages(["week"], "dept", ["cases"]), F.col("train"))
    slots = features.slot_names(ready)
    ready = staged_for_rounds(ready.select("row_key", "category", "label", "features", "scaled", "train"), "features")
    train, test = ready.where("train"), ready.where(~F.col("train"))

    components = cluster.fit_pca(ready, "scaled", len(slots))
    variance = cluster.explained_variance(components, spark)
    cumulative = series.cumulative_share(variance, "component", "variance")
    choice = cluster.choose_components(cumulative)
    kept = choice.first()["k_chosen"]
    reduced = cluster.first_components(ready, "scaled", components, min(kept, len(slots))).select("category", "components")
    reduced = staged_for_rounds(reduced, "components")
    elbow = cluster.elbow_choice(cluster.elbow_costs(reduced, "components", ks))
    grouping = cluster.fit_kmeans(reduced, "components", elbow.first()["chosen"])
    grouped = grouping.transform(reduced)

    logistic = classify.logistic().fit(train)
    forest = classify.forest(trees=trees, depth=depth).fit(train)
    search = classify.cross_validate(train, "row_key", grid_depths, grid_trees)
    models = {"logistic regression": logistic, "random forest": forest, "random forest, tuned": search.bestModel}
    evaluated = {name: classify.evaluation_rows(m.transform(test), logistic.numClasses) for name, m in models.items()}
    predicted = {name: rows for name, (rows, _) in evaluated.items()}
    classes = sorted({label for _, _, label in codes} | {CATEGORY_LABELS[DEFAULT_CATEGORY]})
    forest_rows, names = evaluated["random forest"]
    return {
        "class_distribution": known.groupBy("category", "label").agg(F.count("*").alias("n")),
        "slots": features.slot_summary(ready, "scaled", slots),
        "variance": cumulative,
        "component_choice": choice,
        "elbow": elbow,
        "cluster_sizes": cluster.group_sizes(grouped, "cluster"),
        "cluster_profile": cluster.group_profile(grouped, "cluster", "category"),
        "cluster_centers": cluster.kmeans_centroids(grouping, spark),
        "split": ready.groupBy("train").agg(F.count("*").alias("n")),
        "comparison": classify.compare_models(evaluated),
        "auc": metrics.auc_one_vs_rest(forest_rows, {c: names.get(c) for c in classes}),
        "confusion_logistic": metrics.confusion_matrix(predicted["logistic regression"], classes),
        "confusion_forest": metrics.confusion_matrix(predicted["random forest"], classes),
        "top_confusions": metrics.top_confusions(predicted["random forest"]),
        "importance": classify.importance_by_source(forest, slots, ["week", "dept", "cases"], spark),
        "grid": classify.grid_results(search, spark),
    }


def documents_of_notifications(noti: DataFrame, codes: Sequence[tuple[int, str, int]] | None = None) -> DataFrame:
    """One generated text per event and department, with its category: (doc_id, text, category)."""
    codes = event_category_rows() if codes is None else codes
    mapped = map_codes(noti, "event_code", codes, [("category", "string", DEFAULT_CATEGORY)])
    groups = mapped.groupBy("event", "dept", "category").agg(
        F.sum("cases").alias("total"), F.count("*").alias("rows")
    )
    text = totals.describe_group(
        [
            "Evento:", F.col("event"), "en el departamento", F.col("dept"),
            ". Total de casos:", F.col("total"), ". Registros:", F.col("rows"), ".",
        ]
    )
    named = F.concat_ws("|", "event", F.col("dept").cast("string"), "category")
    return groups.select(F.md5(named).alias("doc_id"), text.alias("text"), "category")


def analyse_texts(
    docs: DataFrame,
    stop_words: Sequence[str] = STOP_WORDS_ES,
    vocabulary_size: int = 3000,
    severity: Sequence[str] = SEVERITY_WORDS,
    relief: Sequence[str] = RELIEF_WORDS,
    sample_rows: int | None = None,
    phrases: Sequence[str] = (),
    load_scorer: Callable[[], sentiment.Scorer] | None = None,
    min_category_rows: int = 10,
) -> dict[str, DataFrame]:
    """Corpus statistics, TF-IDF, a category classifier and sentiment of (doc_id, text, category).

    Categories of fewer than ``min_category_rows`` rows are folded into one. Sentiment is that of all texts, or of
    ``sample_rows`` of them, by the word lists or by the scorer that ``load_scorer`` loads in every task.
    """
    spark = docs.sparkSession
    prepared = fold_rare(docs, "category", min_category_rows).select(
        "doc_id", "text", "category", tokens("text", stop_words=stop_words).alias("tokens"),
        features.in_train("doc_id").alias("train"),
    )
    prepared = staged(prepared, "texts")
    counts = staged(corpus.token_counts(prepared), "token-counts")
    vocabulary = tfidf.fit_vocabulary(prepared, size=vocabulary_size)

    learnt = tfidf.fit_vocabulary(prepared.where("train"), size=vocabulary_size)
    labels = features.indexer("category", "label").fit(prepared.where("train"))
    vectors = tfidf.weighed(tfidf.term_vectors(labels.transform(prepared), learnt), learnt)
    vectors = staged_for_rounds(vectors.select("doc_id", "category", "label", "features", "train"), "term-vectors")
    model = classify.logistic("features", family="multinomial").fit(vectors.where("train"))
    predicted = staged(model.transform(vectors).select("doc_id", "label", "prediction", "train"), "predicted")
    tested = predicted.where(~F.col("train"))

    texts = prepared.select("doc_id", "category", "text")
    if sample_rows is not None:
        texts = features.sample_n(texts, "doc_id", sample_rows)
    if load_scorer is None:
        scored = sentiment.score_by_rule(texts, "text", severity, relief).drop("text")
    else:
        by_scorer = staged(sentiment.score_batches(texts, "doc_id", "text", load_scorer), "sentiments")
        scored = texts.drop("text").join(by_scorer, "doc_id")
    attached = attach_predictions(scored, predicted.select("doc_id", "prediction"), "doc_id")
    found = {
        "corpus_stats": corpus.corpus_stats(prepared),
        "richness": corpus.type_token_ratio(counts),
        "top_tokens": corpus.top_tokens(counts, 25),
        "hapax": corpus.hapax_summary(counts),
        "hapax_examples": corpus.hapax_examples(counts),
        "lengths": profile.histogram(corpus.length_counts(prepared), "length", "rows", 30),
        "top_terms": tfidf.top_terms_by_category(prepared, "category", vocabulary),
        "tf_against_tfidf": tfidf.tf_against_tfidf(vocabulary, spark),
        "metrics": metrics.classification_metrics(tested),
        "confusion": metrics.confusion_matrix(tested, range(len(labels.labels))),
        "labels": literal_table(spark, list(enumerate(labels.labels)), "label int, category string"),
        "terms_by_class": classify.strongest_terms(model, learnt.terms, labels.labels, 5, spark),
        "sample": sentiment.with_sentiment_code(attached),
        "sentiments": sentiment.sentiment_distribution(scored),
        "category_by_sentiment": metrics.contingency(scored, "category", "sentiment", ["NEG", "NEU", "POS"]),
    }
    if phrases:
        typed = sentiment.phrase_table(spark, phrases)
        found["phrases"] = sentiment.score_phrases(typed, "phrase", severity, relief, load_scorer)
    return found


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Write every result table under ``folder`` and give them back as read from there."""
    return {name: write_report(df, f"{folder.rstrip('/')}/{name}") for name, df in tables.items()}
