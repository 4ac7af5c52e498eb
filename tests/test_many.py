"""Heavy hitters and long word lists against plain counting and searching."""

import random
import time
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from casewise.functions.automaton import Automaton
from casewise.functions.text import rule_sentiment
from casewise.operators import heavy, patterns
from casewise.operators.heavy import Summary, heavy_hitters
from casewise.operators.patterns import lexicon_sentiment, patterns_found
from checking import plan


def search(listed, texts):
    raw = [t.encode() for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
    return list(zip(*[x.tolist() for x in Automaton(listed).found(np.frombuffer(b"".join(raw), np.uint8), starts)]))


@given(st.lists(st.text(alphabet="abcé", max_size=4), max_size=8), st.lists(st.text(alphabet="abcé ", max_size=700), max_size=4))
@settings(max_examples=150, deadline=None)
def test_automaton_finds_what_a_text_contains(listed, texts):
    assert search(listed, texts) == [(t, p) for t, text in enumerate(texts) for p, pattern in enumerate(listed) if pattern in text]


def test_patterns_over_the_edges_of_pieces():
    rng = random.Random(1)
    text = "".join(rng.choices("ab", k=3000))
    listed = [text[i : i + n] for i in range(200, 600, 7) for n in (1, 40, 300)] + ["ba" * 200, "c"]
    assert search(listed, [text, "", text[:50]]) == [(t, p) for t, x in enumerate([text, "", text[:50]]) for p, q in enumerate(listed) if q in x]


def test_ten_thousand_words_cost_little_more_than_ten():
    rng = random.Random(2)
    words = list({"".join(rng.choices("abcdefghijklmnop", k=rng.randint(4, 9))) for _ in range(10_500)})[:10_000]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(300)]
    raw = "".join(texts).encode()
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    data, taken = np.frombuffer(raw, np.uint8), {}
    for n in (10, 10_000):
        automaton = Automaton(words[:n])
        runs = []
        for _ in range(5):
            begun = time.perf_counter()
            found = automaton.found(data, starts)
            runs.append(time.perf_counter() - begun)
        taken[n] = min(runs)
    assert len(found[0]) > 50_000
    assert taken[10_000] < 3 * taken[10] + 0.2


def test_patterns_of_a_table(spark, monkeypatch):
    rows = [(1, "Red Ring 11", 5), (2, None, 5), (3, "", 6), (4, "ring ring é", 7), (4, "ring ring é", 7)]
    df = spark.createDataFrame(rows, "row int, text string, found int")
    listed = ["ring", "ring 1", "é", "ri", "zz", "ring"]
    monkeypatch.setattr(patterns, "GROUP_BYTES", 6)  # several automata
    found = patterns_found(df, F.lower("text"), listed, "hits").orderBy("row").collect()
    assert [r["hits"] for r in found] == [[0, 1, 3, 5], [], [], [0, 2, 3, 5], [0, 2, 3, 5]] and found[0]["found"] == 5
    assert [r["hits"] for r in patterns_found(df, "text", [], "hits").collect()] == [[]] * 5
    assert patterns_found(df.where("row > 9"), "text", listed).collect() == []


def test_lexicon_sentiment_is_the_rule(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    severity, relief = ["the", "eder", "x"], ["und", "aulich", "er", "de la"]
    found = lexicon_sentiment(docs, "text", severity, relief)
    other = docs.withColumn("sentiment", rule_sentiment(F.col("text"), severity, relief))
    assert Counter((r["doc_id"], r["sentiment"]) for r in found.collect()) == Counter((r["doc_id"], r["sentiment"]) for r in other.collect())


@given(st.lists(st.integers(0, 30), max_size=200), st.integers(1, 6))
@settings(max_examples=150, deadline=None)
def test_summaries_bound_every_count(tokens, capacity):
    summary, want = Summary(capacity), Counter(map(str, tokens))
    for at in range(0, len(tokens), 17):
        part = Counter(map(str, tokens[at : at + 17]))
        summary.add(list(part), list(part.values()))
    assert len(summary.counts) <= capacity
    assert all(summary.counts.get(t, 0) <= n <= summary.counts.get(t, 0) + summary.missed for t, n in want.items())


def token_rows(seed=3, n=400):
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(40)]
    return [(i, [rng.choice(common) if rng.random() < 0.5 else f"rare{rng.randrange(20_000)}" for _ in range(40)]) for i in range(n)] + [(n, None), (n + 1, [])]


def test_heavy_hitters_are_exact_with_ties(spark):
    rows = token_rows()
    df = spark.createDataFrame(rows, "id int, tokens array<string>").repartition(6)
    want = Counter(t for _, tokens in rows for t in tokens or [])
    for k, capacity in ((1, 64), (10, 64), (45, 64), (45, 2048), (10, 1), (100_000, 64)):
        found = [(r["token"], r["n"]) for r in heavy_hitters(df, "tokens", k, capacity).collect()]
        assert found == sorted(want.items(), key=lambda x: (-x[1], x[0]))[:k]
    tied = spark.createDataFrame([(["b", "a", "c", "d"] * 50,), (["x"] * 3,)], "tokens array<string>")
    assert [r["token"] for r in heavy_hitters(tied, "tokens", 2, 3).collect()] == ["a", "b"]


def test_all_tokens_are_counted_where_summaries_say_nothing(spark, monkeypatch):
    monkeypatch.setattr(heavy, "MOST", 4)
    df = spark.createDataFrame([([f"t{i}" for i in range(1000)],)], "tokens array<string>")
    assert [r["token"] for r in heavy_hitters(df, "tokens", 3, 4).collect()] == ["t0", "t1", "t10"]


def test_shuffled_rows_do_not_depend_on_the_vocabulary(spark):
    df = spark.createDataFrame(token_rows(n=2000), "id int, tokens array<string>").repartition(4)
    rows = df.select("tokens").mapInArrow(heavy._summaries(128), "token string, n long")
    assert rows.count() <= 4 * 129
    result = heavy_hitters(df, "tokens", 10, 128)
    assert "LeftSemi" in plan(result)
    named = [line for line in plan(result).split("\n") if "BroadcastHashJoin" in line]
    assert named  # the second pass drops all other tokens before they are counted
