"""What the physical plans must and must not hold."""

import re

import pytest

from __spark_entry__ import queries
from checking import plan

BUILD = queries()


def test_batch_score_is_arrow_batched(spark, sf_dir):
    assert "MapInPandas" in plan(BUILD["batch_score"](spark, sf_dir))


@pytest.mark.parametrize("name", ["total_by_event", "topk_values", "peak_week", "top_tokens", "sample_n", "head_n"])
def test_top_k_is_not_a_full_sort(name, spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(BUILD[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["topk_per_group", "cluster_profile"])
def test_groups_are_limited_before_the_shuffle(name, spark, sf_dir):
    assert plan(BUILD[name](spark, sf_dir)).count("WindowGroupLimit") >= 2


def test_focus_filter_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(BUILD["focus_by_dept"](spark, sf_dir))
    assert "EqualTo(p_brand,Brand#1)" in text
    assert "l_extendedprice" not in text


def test_totals_are_partial_before_the_shuffle(spark, sf_dir):
    assert "partial_sum" in plan(BUILD["weekly_totals"](spark, sf_dir))


def test_document_terms_are_not_shuffled(spark):
    from casewise.operators import tfidf

    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["a", "b"])], "doc_id int, tokens array<string>")
    vocabulary = tfidf.fit_vocabulary(docs, min_df=1, max_df=1.0)
    for df in (
        tfidf.tfidf(docs, ["doc_id"], vocabulary),
        tfidf.top_terms_per_document(docs, "doc_id", vocabulary, 2),
    ):
        assert not re.search(r"Exchange (hash|range|Single)", plan(df))


def test_term_statistics_are_compiled_and_exact(spark):
    from casewise.operators import tfidf

    docs = [["b", "a", "b", "ñ"], ["a", "a", "a"], [], None, ["B", None, "b", None]]
    found = tfidf.term_statistics(spark.createDataFrame([(tokens,) for tokens in docs], "tokens array<string>"))
    assert "lambda" not in plan(found)
    assert {tuple(r) for r in found.collect()} == {("a", 4, 2), ("b", 3, 2), ("B", 1, 1), ("ñ", 1, 1)}


def test_attached_predictions_read_each_side_once(spark, sf_dir):
    assert plan(BUILD["attach_predictions"](spark, sf_dir)).count("FileScan") == 2


def test_metrics_read_the_predictions_once(spark, sf_dir):
    assert plan(BUILD["classification_metrics"](spark, sf_dir)).count("FileScan") == 1


@pytest.mark.parametrize("name", ["auc_ovr", "percentiles"])
def test_one_scan_follows_the_sketch(name, spark, sf_dir):
    df = BUILD[name](spark, sf_dir)
    df.collect()
    assert plan(df).split("== Initial Plan ==")[0].count("FileScan") == 1


@pytest.mark.parametrize("name", ["weekly_moving_avg", "cumulative_share", "elbow_rule", "step_delta"])
def test_a_series_writes_nothing(name, spark, sf_dir, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def no_write(df):
        raise AssertionError("written")

    monkeypatch.setattr(DataFrame, "write", property(no_write))
    assert BUILD[name](spark, sf_dir).columns
