"""Small inputs at the edges: nothing, nulls, blanks, ties, gaps, constants."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from casewise.functions import cleaning
from casewise.functions.domain import (
    CATEGORY_LABELS,
    EVENT_CATEGORIES,
    RELIEF_WORDS,
    SEVERITY_WORDS,
    STOP_WORDS_ES,
    event_category_rows,
)
from casewise.functions.text import tokens
from casewise.operators import cluster, corpus, features, metrics, profile, sentiment, series, tfidf, totals
from casewise.operators.lookup import attach_predictions, fold_rare, map_codes
from casewise.operators.ordered import exact_percentiles
from casewise.sources.readers import NOTIFICATION_COLUMNS, clean_notifications, read_text_columns

NOTI = "event_code int, event string, year int, week int, dept int, town_code int, town string, cases int"


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_fixed_values():
    assert len(EVENT_CATEGORIES) == 69
    assert len({code for code, _, _ in event_category_rows()}) == 69
    assert sorted(CATEGORY_LABELS.values()) == list(range(7))
    assert len(STOP_WORDS_ES) == len(set(STOP_WORDS_ES)) == 117
    assert (len(SEVERITY_WORDS), len(RELIEF_WORDS)) == (10, 9)


def test_casts_give_null_on_bad_input(spark):
    df = spark.createDataFrame([("2.019",), ("",), ("7.0",), (" ",), (None,), ("abc",), (" 5 ",)], "x string")
    found = rows(df.select(cleaning.dotted_year("x"), cleaning.to_int("x")))
    assert found == [(2019, None), (None, None), (70, None), (None, None), (None, None), (None, None), (5, 5)]


def test_blanks(spark):
    df = spark.createDataFrame([("A",), (" A ",), ("",), ("  ",), (None,)], "x string")
    found = rows(df.select(cleaning.blank_to_null("x"), cleaning.blank_to_default("x", "?")))
    assert found == [("A", "A"), ("A", "A"), (None, "?"), (None, "?"), (None, "?")]


def test_csv_keeps_blanks_quotes_and_any_column_order(spark, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text(
        'nom_mun,COD_EVE,Nombre,ANO,SEMANA,COD_DPTO_O,COD_MUN_O,conteo_casos\n'
        '"  ",210,"DENGUE ""G""",2.019,1,5,5001,7\n'
        ',,X,,,,,\n',
        encoding="utf-8",
    )
    raw = read_text_columns(spark, str(path), NOTIFICATION_COLUMNS)
    assert raw.columns == NOTIFICATION_COLUMNS
    assert [r["nom_mun"] for r in raw.collect()] == ["  ", ""]
    assert rows(clean_notifications(raw)) == [
        (210, 'DENGUE "G"', 2019, 1, 5, 5001, None, 7),
        (None, "X", None, None, None, None, None, None),
    ]


def test_operators_on_no_rows(spark):
    empty = spark.createDataFrame([], NOTI)
    totalled = totals.total_by(empty, ["event"], "cases")
    assert rows(totals.rate_per_group(empty, "dept", F.col("event") == "x", "cases")) == []
    assert rows(totals.concentration(totalled, "event", "total", [3]))[0][0] is None
    assert rows(series.moving_average(totals.total_by(empty, ["week"], "cases"), "week", "total")) == []
    assert rows(series.cumulative_share(totalled, "event", "total")) == []
    assert rows(profile.iqr_outliers(empty, "cases")) == [(None, None, None, None, 0, None)]
    assert rows(exact_percentiles(empty, "cases", {"p50": "0.5"})) == [(None,)]
    assert {r["nulls"] for r in profile.null_audit(empty).collect()} == {0}
    assert rows(profile.exact_duplicates(empty)) == [(0, 0, 0, None)]
    assert rows(metrics.classification_metrics(empty.select(F.col("week").alias("label"), F.col("dept").alias("prediction")))) == [
        (None, None, None, None)
    ]


def test_zero_total_gives_null_rate(spark):
    df = spark.createDataFrame([(1, 5, 0), (2, 3, 4)], "dept int, focus_total int, group_total int")
    found = totals.rate_by_join(df.select("dept", "focus_total"), df.select("dept", "group_total"), "dept")
    assert sorted(rows(found)) == [(1, 5, 0, None), (2, 3, 4, 750.0)]


def test_rate_in_one_pass_equals_rate_by_join(spark):
    data = [("a", 1, 4), ("b", 1, 6), ("a", 2, None), ("b", 3, 9), ("a", None, 2), ("a", 1, 1)]
    df = spark.createDataFrame(data, "event string, dept int, cases int")
    focus = F.col("event") == "a"
    joined = totals.rate_by_join(
        totals.total_by(df.where(focus), ["dept"], "cases", "focus_total"),
        totals.total_by(df, ["dept"], "cases", "group_total"),
        "dept",
    )
    assert sorted(rows(totals.rate_per_group(df, "dept", focus, "cases"))) == sorted(rows(joined))


def test_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, v double")
    assert rows(profile.null_audit(df)) == [("k", 0, 0.0), ("v", 2, 100.0)]
    assert rows(profile.describe_columns(df, ["v"])) == [("v", 0, None, None, None, None)]
    assert rows(profile.summary(df, "v")) == [(0,) + (None,) * 7]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "x")] * 3 + [(1, None), (1, None), (2, "")], "a int, b string")
    assert rows(profile.exact_duplicates(df))[0][:3] == (6, 3, 3)
    assert sorted(rows(profile.duplicate_keys(df, ["a"]))) == [(1, 5)]


def test_ties_go_by_name(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 7), ("d", 5)], "k string, v int")
    assert [r["k"] for r in totals.top_k(df, [F.desc("v"), F.asc("k")], 3).collect()] == ["c", "a", "b"]
    found = series.cumulative_share(df, "k", "v").orderBy("rank").collect()
    assert [r["k"] for r in found] == ["c", "a", "b", "d"]
    assert math.isclose(found[-1]["cum_share"], 1.0)


def test_moving_average_is_the_centred_pandas_one(spark):
    values = [1, 2, 3, 4, 5, 6, 10]
    weeks = [1, 2, 4, 5, 6, 9, 11]  # gaps do not matter
    df = spark.createDataFrame(list(zip(weeks, map(float, values))), "week int, total double")
    found = [r["moving_avg"] for r in series.moving_average(df, "week", "total").orderBy("week").collect()]
    expected = pd.Series(values).rolling(4, center=True).mean()
    assert found == [None if math.isnan(x) else x for x in expected]
    assert found == [None, None, 2.5, 3.5, 4.5, 6.25, None]


def costs(spark, values):
    return spark.createDataFrame(list(enumerate(map(float, values), 2)), "k int, wcss double")


@pytest.mark.parametrize(
    "values, reference, first_below",
    [
        ([100, 98, 96, 95], 3, 3),  # flat: the first step is the answer, then the largest gain, also the first
        ([100, 98, 90, 89], 4, 3),  # first step small: mistaken for the default, so the largest gain
        ([100, 60, 40, 35], 5, 5),  # a clear elbow
        ([100, 80, 60, 40], 3, 3),  # never below: the largest gain, first of equals
        ([100, 80, 50, 30], 4, 4),  # never below: the largest gain
    ],
)
def test_elbow_rules(spark, values, reference, first_below):
    df = costs(spark, values)
    assert {r["chosen"] for r in cluster.elbow_choice(df).collect()} == {reference}
    assert {r["chosen"] for r in cluster.elbow_choice(df, rule="first_below").collect()} == {first_below}
    with pytest.raises(ValueError):
        cluster.elbow_choice(df, rule="other")


def test_unseen_code_gets_the_default(spark):
    df = spark.createDataFrame([(210,), (999,), (None,)], "code int")
    outputs = [("category", "string", "OTROS"), ("label", "int", 6)]
    assert sorted(rows(map_codes(df, "code", event_category_rows(), outputs)), key=str) == [
        (210, "VECTORIAL", 0), (999, "OTROS", 6), (None, "OTROS", 6),
    ]


def test_fold_rare_keeps_every_row(spark):
    data = [("big",)] * 700 + [("mid",)] * 10 + [("small",)] * 9 + [(None,)] * 2 + [("",)] * 3
    folded = fold_rare(spark.createDataFrame(data, "c string"), "c", 10)
    assert sorted(rows(folded.groupBy("c").count())) == [("Otros", 14), ("big", 700), ("mid", 10)]


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    _, scaled = features.prepared(df, features.numeric_stages(["a", "b"]))
    found = rows(features.slot_summary(scaled, "scaled", ["a", "b"]))
    assert [r[6] for r in found] == [1.0, 0.0]
    assert [r[5] for r in found] == [0.0, 0.0]


def test_assembler_leaves_out_null_numbers(spark):
    df = spark.createDataFrame([(1, "x", 2), (None, "x", 2), (3, "y", 4)], "week int, dept string, cases int")
    _, ready = features.prepared(df, features.feature_stages(["week"], "dept", ["cases"]))
    assert features.slot_names(ready) == ["week", "dept_hot_x", "dept_hot_y", "dept_hot___unknown", "cases"]
    assert ready.count() == 2


def test_missing_class(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 2, 0.9), (2, 2, 0.5)], "label int, prediction int, score double")
    assert rows(metrics.confusion_matrix(df, [0, 1, 2])) == [(0, 1, 0, 1, 0), (1, 0, 0, 0, 0), (2, 0, 0, 1, 0), (None, 0, 0, 0, 0)]
    areas = metrics.auc_one_vs_rest(df, {0: "score", 1: "score", 2: "score"})
    assert {r["class"]: r["auc"] for r in areas.collect()} == {0: 0.5, 1: None, 2: 0.5}
    assert rows(metrics.weighted_auc(areas)) == [(0.5,)]


TEXTS = ["", None, "uno", "dos Dos DOS", "a b c", "tab\tnew\nline  end ", "Árbol, árbol ÁRBOL", "de la CASA de"]


def test_tokens(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id int, text string")
    found = rows(df.select(tokens("text", stop_words=["DE", "la"])).orderBy("doc_id"))
    assert [r[0] for r in found] == [
        [], [], ["uno"], ["dos", "dos", "dos"], [], ["tab", "new", "line", "end"], ["árbol,", "árbol", "árbol"], ["casa"],
    ]


def test_corpus_without_tokens(spark):
    df = spark.createDataFrame([([],)], "tokens array<string>")
    counts = corpus.token_counts(df)
    assert rows(corpus.type_token_ratio(counts)) == [(0, 0, 0.0, "baja")]
    assert rows(corpus.hapax_summary(counts)) == [(0, 0, None)]
    assert rows(profile.histogram(corpus.length_counts(df), "length", "rows", 30)) == [(0, 1, 0, 0)]


def test_idf_is_that_of_the_ml_stage(spark):
    from pyspark.ml.feature import IDF

    data = [(["a", "b", "b"],), (["a", "c"],), (["b", "c", "c"],), (["d"],)]
    df = spark.createDataFrame(data, "tokens array<string>")
    vocabulary = tfidf.fit_vocabulary(df, min_df=1, max_df=1.0)
    model = IDF(inputCol="tf", outputCol="w").fit(tfidf.term_vectors(df, vocabulary))
    assert vocabulary.terms == ["b", "c", "a", "d"]
    assert [round(x, 12) for x in vocabulary.weights] == [round(x, 12) for x in model.idf.toArray()]


def test_rule_scorers_agree(spark):
    texts = [
        "Brote grave", "control estable", "grave pero leve", "nada", "grave grave leve", "caso controlado", None, "",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    ruled = sentiment.score_by_rule(df, "text", SEVERITY_WORDS, RELIEF_WORDS)
    by_rule = {r["doc_id"]: r["sentiment"] for r in ruled.collect()}
    assert by_rule == {0: "NEG", 1: "POS", 2: "NEU", 3: "NEU", 4: "NEU", 5: "POS", 6: "NEU", 7: "NEU"}
    load = sentiment.rule_scorer(SEVERITY_WORDS, RELIEF_WORDS)
    batched = sentiment.score_batches(df, "doc_id", "text", load, batch_size=3)
    assert {r["doc_id"]: r["sentiment"] for r in batched.collect()} == by_rule


def test_phrases_and_codes(spark):
    typed = sentiment.phrase_table(spark, ["todo grave", "todo leve", "todo"])
    for load in (None, sentiment.rule_scorer(SEVERITY_WORDS, RELIEF_WORDS)):
        coded = sentiment.with_sentiment_code(sentiment.score_phrases(typed, "phrase", SEVERITY_WORDS, RELIEF_WORDS, load))
        assert sorted(r["sentiment_code"] for r in coded.collect()) == [0, 1, 2]


def test_attach_predictions_is_a_left_join(spark):
    sample = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    predicted = spark.createDataFrame([(2, 1.0), (3, 0.0)], "id int, prediction double")
    found = attach_predictions(sample, predicted, "id")
    assert sorted(rows(found)) == [(1, "a", None), (2, "b", 1.0)]


def test_tables_of_counts_hold_every_row(spark):
    data = [(0, 0), (0, 5), (5, 0), (None, 1), (1, None), (None, None), (7, 7)]
    df = spark.createDataFrame(data, "label int, prediction int")
    found = rows(metrics.confusion_matrix(df, [0, 1]))
    assert found == [(0, 1, 0, 1), (1, 0, 0, 1), (None, 1, 1, 2)]
    assert sum(x for r in found for x in r[1:]) == len(data)
    marks = spark.createDataFrame([("a", "NEG"), ("a", None), ("a", "odd"), (None, "POS")], "g string, s string")
    assert sorted(rows(metrics.contingency(marks, "g", "s", ["NEG", "POS"])), key=str) == [("a", 1, 0, 2), (None, 0, 1, 0)]


def test_a_class_the_model_has_not_seen_has_no_area(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.9), (2, 0.5)], "label int, s double")
    found = {r["class"]: (r["support"], r["auc"]) for r in metrics.auc_one_vs_rest(df, {1: "s", 2: None, 3: None}).collect()}
    assert found == {1: (1, 1.0), 2: (1, None), 3: (0, None)}


def test_group_rollup_gives_the_lists_back(spark):
    data = [("e", 1, 3, 1, "A"), ("e", 1, 4, 1, "B"), ("e", 1, 5, 2, None), (None, 2, 1, 7, "C")]
    df = spark.createDataFrame(data, "event string, dept int, cases int, week int, town string")
    found = rows(totals.group_rollup(df, ["event", "dept"], "cases", ["week", "town"]))
    assert sorted(found, key=str) == sorted(
        [
            ("e", 1, "all", None, 3, 12), ("e", 1, "week", "1", 2, 7), ("e", 1, "week", "2", 1, 5),
            ("e", 1, "town", "A", 1, 3), ("e", 1, "town", "B", 1, 4), ("e", 1, "town", None, 1, 5),
            (None, 2, "all", None, 1, 1), (None, 2, "week", "7", 1, 1), (None, 2, "town", "C", 1, 1),
        ],
        key=str,
    )
