"""Base counts against plain Python; the divergence verdict on clear cases."""

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from casewise.llm.quality import Rules, quality_verdicts, with_features, with_shares, word_bins
from casewise.llm.sql import QUALITY
from checking import differences, plan

WORD = re.compile(r"[^\x20\x09-\x0d]+")
RNG = random.Random(5)
COMMON = ["the", "of", "and", "to", "a", "in", "is", "that"]


def prose(n):
    return " ".join(RNG.choice(COMMON) if RNG.random() < 0.4 else "".join(RNG.choices("abcdefghilmnoprstu", k=RNG.randint(2, 9))) for _ in range(n)) + "."


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, t in enumerate(triples) if triples.count(t) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


TEXTS = [None, "", " \n\t", "one", "a b a b a b a b", "x y z\nx y z\n\nq x y z", "é ñ # * $ 🙂\n\x0bü|<>", "a\u00a0b c", "aa " * 60, "l1\nl1\nl1 \n l1"]
TEXTS += [" ".join(RNG.choices("abc", k=n)) for n in (2, 3, 4, 30, 200)]


def test_base_counts(spark):
    rows = [(i, t, "en", 7) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int")  # a clashing column
    for r in quality_verdicts(df).collect():
        want = counts(r.row.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept) and r.row.n_words == 7


@pytest.mark.parametrize("keep", [["doc_id", "lang"], None])
def test_junk_goes_and_prose_stays(spark, keep):
    good = [prose(300) for _ in range(60)]
    shout = [prose(300).upper().replace(" ", "!! ") for _ in range(6)]
    signs = [prose(300).replace(" ", "### ") for _ in range(6)]
    lists = [" | ".join("".join(RNG.choices("bcdfgh", k=8)) for _ in range(200)) for _ in range(6)]
    rows = [(i, t, "en" if i % 9 else None) for i, t in enumerate(good + shout + signs + lists)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.row.doc_id for r in quality_verdicts(df, keep=keep).where("kept").collect()}
    assert kept == set(range(60))


def test_no_reference_leaves_the_base_rules(spark):
    df = spark.createDataFrame([(1, "### " * 10 + prose(60), "xx"), (2, "short", None)], "doc_id long, text string, lang string")
    found = {r.row.doc_id: (r.kept, r.class_distance) for r in quality_verdicts(df).collect()}
    assert found == {1: (True, None), 2: (False, None)}
    assert quality_verdicts(df.limit(0)).collect() == []


def spaced(letters, n=300):
    return " ".join("".join(RNG.choices(letters, k=RNG.randint(1, 4))) for _ in range(n)) + "\u3002"


@pytest.mark.parametrize("keep", [["doc_id", "lang"], None])
def test_languages_without_a_reference_are_judged_by_the_base_rules(spark, keep):
    scripts = {"zh": "\u7684\u4e00\u662f\u4e0d\u4e86\u4eba\u6211\u5728", "ko": "\uac00\ub098\ub2e4\ub77c\ub9c8", "ar": "\u0627\u0644\u0645\u0648\u064a", "hi": "\u0915\u0930\u0928\u0924\u0938"}
    rows = [(prose(300), "en") for _ in range(40)] + [(spaced(letters), lang) for lang, letters in scripts.items()]
    rows += [("a b c " * 100, "zh"), ("short", "ko")]
    rows += [(prose(300).replace(" ", "### "), "en"), (prose(300).replace(" ", "### "), None)]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "doc_id long, text string, lang string")
    found = {r.row.doc_id: r for r in quality_verdicts(df, keep=keep).collect()}
    assert {i for i, r in found.items() if r.kept} == set(range(44))
    assert all(found[i].class_distance is None for i in range(40, 46)) and found[46].class_distance is not None


def test_guard_for_short_texts(spark):
    rules = Rules(min_words=5, short_words=50, max_distance=0.0, max_short_distance=1.0)
    df = spark.createDataFrame([(1, prose(20), "en"), (2, prose(200), "en")], "doc_id long, text string, lang string")
    assert {r.row.doc_id: r.kept for r in quality_verdicts(df, rules=rules).collect()} == {1: True, 2: False}


def test_the_sql_twin_has_the_same_rule_for_other_languages(spark, tmp_path):
    rows = [(prose(300), "en") for _ in range(30)] + [(prose(200).replace(" ", "### "), lang) for lang in ("it", "en", None, "")]
    rows += [(spaced("的一是", 90), "zh"), (None, "it"), (prose(60), None)]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "doc_id long, text string, lang string")
    df.coalesce(1).write.parquet(str(tmp_path / "written"))
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{tmp_path}/written/*.parquet'")
    found = quality_verdicts(df, keep=["doc_id", "lang"]).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
    assert differences(found, connection, QUALITY) == []


def test_the_first_pass_has_histograms_alone(spark):
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*TEXTS, prose(80)])], "doc_id long, text string, lang string")
    bins = word_bins()
    whole = with_features(df, "text", bins, ["doc_id"]).select("row.doc_id", "n_words", "class_counts", "word_counts")
    assert sorted(with_shares(df, "text", bins, ["doc_id"]).select("row.doc_id", "n_words", "class_counts", "word_counts").collect()) == sorted(whole.collect())
    assert "xxhash64" not in plan(with_shares(df, "text", bins, ["doc_id"]))


def test_listed_words_are_counted_by_bytes(spark):
    """Characters of the text need not be counted again for every listed word; a listed word may have any letters."""
    df = spark.createDataFrame([("Für das, für ñandú für",), (None,)], "text string")
    found = with_shares(df, "text", ["das", "für", "é"], ["text"])
    assert [r["word_counts"] for r in found.collect()] == [[1, 3, 0, 1], [0, 0, 0, 0]]
    assert "octet_length(replace" in plan(found) and " length(replace" not in plan(found)
