"""Batches by length give the scores of batches as they come, from a model that is loaded once a worker."""

import os

from casewise.operators.sentiment import rule_scorer, score_batches, score_by_length

LISTS = (["the", "der"], ["de", "la"])


def test_scores_are_those_of_plain_batches(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, "")], "doc_id long, text string"))
    found = score_by_length(docs, "doc_id", "text", rule_scorer(*LISTS)).collect()
    want = score_batches(docs, "doc_id", "text", rule_scorer(*LISTS)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, want)) and len(found) == docs.count()


def test_one_load_a_worker_and_sorted_batches(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        with open(f"{folder}/{os.getpid()}", "a") as file:
            file.write("load\n")

        def scorer(texts):
            lengths = [len(t) for t in texts]
            return [(str(max(lengths) - min(lengths)), float(len(texts))) for _ in texts]

        return scorer

    rows = [(i, "x " * (i * 7919 % 256 + 1)) for i in range(2048)]
    df = spark.createDataFrame(rows, "id int, text string").repartition(4)
    found = score_by_length(df, "id", "text", load, batch_size=32).collect()
    loads = [open(f"{folder}/{name}").read().count("load") for name in os.listdir(folder)]
    assert loads and set(loads) == {1} and len(found) == 2048
    assert max(r["score"] for r in found) == 32
    assert sorted(int(r["sentiment"]) for r in found)[len(found) // 2] < 100  # of 512 characters


def test_texts_are_cut_only_if_asked(spark):
    def load():
        return lambda texts: [(t, 1.0) for t in texts]

    df = spark.createDataFrame([(1, " a  b c\nd "), (2, "one"), (3, " ")], "id int, text string")
    assert {r["id"]: r["sentiment"] for r in score_by_length(df, "id", "text", load).collect()} == {1: " a  b c\nd ", 2: "one", 3: " "}
    assert {r["id"]: r["sentiment"] for r in score_by_length(df, "id", "text", load, max_tokens=2).collect()} == {1: " a  b", 2: "one", 3: ""}
