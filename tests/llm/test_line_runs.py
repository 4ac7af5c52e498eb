"""Repeated line runs against brute force over all earlier copies."""

import random

import pytest

from casewise.llm.line_runs import drop_repeated_runs

MIN = 6


def brute(docs, min_words):
    """Line numbers in a run that has enough words and an earlier copy; documents go by key."""
    sequences = []
    for key in sorted(docs, key=lambda k: (k is not None, k)):
        lines = [(i, line) for i, line in enumerate((docs[key] or "").split("\n")) if line.split()]
        sequences.append((key, [i for i, _ in lines], [line for _, line in lines]))
    gone = {key: set() for key, _, _ in sequences}
    for d, (key, numbers, lines) in enumerate(sequences):
        for s in range(len(lines)):
            for d2, (_, _, other) in enumerate(sequences[: d + 1]):
                for q in range(len(other)):
                    if d2 == d and q >= s:
                        break
                    n = 0
                    while s + n < len(lines) and q + n < len(other) and lines[s + n] == other[q + n]:
                        n += 1
                    if sum(len(line.split()) for line in lines[s : s + n]) >= min_words:
                        gone[key] |= set(numbers[s : s + n])
    return gone


def removed(row):
    return {i for run in row.runs for i in range(run["first"], run["last"] + 1) if row.row.text.split("\n")[i].split()}


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    words = ["a", "b b", "c c c", "d d d d d d", "", " ", "e e"]
    docs = {i: "\n".join(rng.choice(words) for _ in range(rng.randint(0, 14))) for i in range(25)}
    docs |= {25: docs[3], 26: docs[4] + "\nnew line\n" + docs[5], 27: None, 28: "", None: docs[6]}
    df = spark.createDataFrame(list(docs.items()), "k long, text string")
    want = brute(docs, MIN)
    for row in drop_repeated_runs(df.repartition(3), "k", "text", MIN).collect():
        assert removed(row) == want[row.row.k] and row.n_removed == len(want[row.row.k])
        kept = None if docs[row.row.k] is None else "\n".join(x for i, x in enumerate(docs[row.row.k].split("\n")) if i not in want[row.row.k])
        assert row.kept_text == kept


def test_passage_in_a_third_of_the_documents_and_clashing_columns(spark):
    passage = "\n".join(f"line {i} of a long passage" for i in range(10))
    rows = [(i, f"own {i} start\n{passage if i % 3 == 0 else 'other'}\nown {i} end", "x") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string").withColumnRenamed("spans", "kept_text")
    for row in drop_repeated_runs(df, "doc_id", "text").collect():
        assert row.row.kept_text == "x"
        cut = row.row.doc_id % 3 == 0 and row.row.doc_id > 0
        assert row.n_removed == (10 if cut else 0)
        assert [tuple(r) for r in row.runs] == ([(1, 10)] if cut else [])
        assert (passage in row.kept_text) == (row.row.doc_id == 0)


def test_one_line_again_and_again_in_one_document(spark):
    df = spark.createDataFrame([(1, "\n".join(["ten words are in this line and it comes again"] * 5000))], "doc_id long, text string")
    row = drop_repeated_runs(df, "doc_id", "text").collect()[0]
    assert row.kept_text.count("\n") == 0 and row.n_removed == 4999


def test_repeated_rows_are_one_document(spark):
    text = "\n".join(f"line {i} of some words that repeat" for i in range(10))
    df = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")
    rows = sorted((r.row.doc_id, r.n_removed) for r in drop_repeated_runs(df, "doc_id", "text").collect())
    assert rows == [(1, 0), (1, 0), (2, 10)]


def test_empty_table(spark):
    assert drop_repeated_runs(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text").collect() == []


def test_large_keys_beside_a_null_one(spark):
    text = "a line of ten words that comes again and again"
    rows = [(2**62 + 1, text), (2**62 + 2, text), (None, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {r.row.doc_id: r.n_removed for r in drop_repeated_runs(df, "doc_id", "text", 10).collect()}
    assert found == {2**62 + 1: 0, 2**62 + 2: 1, None: 0}
