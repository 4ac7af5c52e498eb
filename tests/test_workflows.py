"""The end-to-end analyses on the smallest tables."""

from casewise import workflows
from casewise.sources import bindings

FOCUS = "Brand#1"


def test_exploration(spark, sf_dir, tmp_path):
    noti = bindings.notifications(spark, sf_dir)
    found = workflows.explore_notifications(noti, FOCUS)
    written = workflows.write_tables(found, str(tmp_path))
    assert set(written) == set(found)
    assert {name: df.count() for name, df in written.items()}["top_events"] == 15
    assert written["described"].count() == 3
    peak = written["focus_peak"].first()
    assert peak["total"] == max(r["total"] for r in written["focus_series"].collect())


def test_models(spark, sf_dir):
    noti = bindings.notifications(spark, sf_dir)
    codes = [(code, f"c{code % 3}", code % 3) for code in range(1, 26)]
    found = workflows.model_notifications(
        noti, codes=codes, ks=range(2, 5), trees=3, depth=3, grid_depths=(2, 3), grid_trees=(2, 3)
    )
    assert found["comparison"].count() == 3
    assert all(0 < r["weighted_auc"] <= 1 for r in found["comparison"].collect())
    tested = found["split"].where("not train").first()["n"]
    for name in ("confusion_logistic", "confusion_forest"):
        assert sum(x for r in found[name].collect() for x in r[1:]) == tested
    assert found["grid"].count() == 4
    assert {r["source"] for r in found["importance"].collect()} == {"week", "dept", "cases"}
    assert found["cluster_sizes"].agg({"n": "sum"}).first()[0] == noti.where("dept <> 0").count()
    assert found["split"].count() == 2
    assert all(df.columns for df in found.values())


def test_texts(spark, sf_dir):
    docs = bindings.documents(spark, sf_dir).selectExpr("doc_id", "text", "lang as category")
    found = workflows.analyse_texts(docs, vocabulary_size=300, phrases=["todo grave"])
    assert found["sample"].count() == docs.count()
    assert found["sentiments"].agg({"n": "sum"}).first()[0] == docs.count()
    cells = found["category_by_sentiment"].selectExpr("sum(NEG + NEU + POS + other)").first()[0]
    assert cells == docs.count()
    assert found["sample"].where("prediction is null").count() == 0
    assert found["metrics"].first()["accuracy"] > 0.6
    assert found["phrases"].first()["sentiment"] == "NEG"
    assert found["corpus_stats"].first()["documents"] == docs.count()


def test_texts_by_another_scorer_with_rare_categories(spark, sf_dir):
    def load():
        return lambda texts: [("LONG" if len(t) > 2000 else "SHORT", 0.5) for t in texts]

    docs = bindings.documents(spark, sf_dir).selectExpr("doc_id", "text", "if(doc_id < 3, concat('rare', doc_id), lang) as category")
    found = workflows.analyse_texts(docs, vocabulary_size=300, sample_rows=50, phrases=["todo grave"], load_scorer=load)
    assert found["sample"].count() == 50
    assert {r["sentiment"] for r in found["sentiments"].collect()} <= {"LONG", "SHORT"}
    assert found["phrases"].first()["sentiment"] == "SHORT"
    assert "Otros" in {r["category"] for r in found["labels"].collect()}


def test_generated_documents(spark, sf_dir):
    noti = bindings.notifications(spark, sf_dir)
    found = workflows.documents_of_notifications(noti)
    assert found.count() == found.select("doc_id").distinct().count() == noti.select("event", "dept").distinct().count()
