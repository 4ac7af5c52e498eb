"""Phrases and their scores against plain counting, and the index itself."""

import random
import re
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
from hypothesis import given, settings, strategies as st

from casewise.llm import phrase_index
from casewise.llm.phrase_index import PhraseIndex, collocations, phrase_counts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RESULT = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain_counts(rows):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for length in range(1, 6):
                for i in range(len(words) - length + 1):
                    counts.setdefault(lang, Counter())[" ".join(words[i : i + length])] += 1
    return counts, totals


def plain(rows, least, top):
    counts, totals = plain_counts(rows)
    out = []
    for lang, found in counts.items():
        frequent = {p: a for p, a in found.items() if a >= least}
        scored = []
        for phrase, a in frequent.items():
            words = phrase.split(" ")
            if len(words) < 2:
                continue
            if any(len(b.split(" ")) > len(words) and f" {phrase} " in f" {b} " and f >= a for b, f in frequent.items()):
                continue
            cuts = []
            for k in range(1, len(words)):
                left, right = found[" ".join(words[:k])], found[" ".join(words[k:])]
                cuts.append((floor(Fraction(1000 * a * totals[lang], left * right)), k, left, right))
            score, _, left, right = min(cuts)
            scored.append((-score, -a, phrase.encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def corpus():
    rng = random.Random(3)
    words = ["the", "of", "And", "x-y", "straße", "é", "a b", "ÀB", "\x00", "q"]
    rows = []
    for i in range(300):
        lang = rng.choice(["en", "en", "en", None, "", "und", "fr"])
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ", ", ".", "\n", "  "]) for _ in range(rng.choice([0, 1, 4, 60])))
        rows.append((lang, text))
    rows += [("en", "fixed set phrase of words that recurs")] * 40 + [("en", None), (None, None), ("de", " . ,\n"), ("es", "one"), ("en", "go go go go go go go")]
    return rows


def test_collocations_equal_plain_counting(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*row, 1, 2) for row in rows], "lang string, text string, n long, phrase long").repartition(3)
    for least, top, shard in ((3, 1000, 1 << 21), (10, 7, 50)):
        found = collocations(docs, min_count=least, top=top, shard_words=shard)
        assert sorted(tuple(r) for r in found.select(*RESULT).collect()) == plain(rows, least, top)


def test_counts_of_all_lengths(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    counts, totals = phrase_counts(docs, min_count=5, shard_words=100)
    want, sizes = plain_counts(rows)
    assert {(r["lang"], r["phrase"]): r["n"] for r in counts.collect()} == {(g, p): n for g, c in want.items() for p, n in c.items() if n >= 5}
    assert {r["lang"]: r["total"] for r in totals.collect()} == {g: n for g, n in sizes.items() if n}


def test_empty_tables_and_texts_without_words(spark):
    for rows in ([], [("en", None), (None, " .. ")]):
        assert collocations(spark.createDataFrame(rows, "lang string, text string")).collect() == []


def test_a_very_long_text(spark):
    text = "alpha beta gamma " * 60_000
    found = collocations(spark.createDataFrame([("en", text), ("en", text)], "lang string, text string"), shard_words=1000)
    rows = {r["phrase"]: r["a"] for r in found.collect()}
    assert rows["beta gamma alpha beta gamma"] == 2 * 59_999 and rows["alpha beta gamma alpha beta"] == 2 * 59_999


def test_scores_pass_64_bits(spark):
    docs = spark.createDataFrame([("en", "p q. " * 300)], "lang string, text string")
    counts, totals = phrase_counts(docs)
    assert totals.first()["total"] == 600
    exact = spark.sql(
        "select cast(cast(1000 as decimal(4,0)) * cast(cast(a as decimal(19,0)) * cast(n as decimal(19,0)) as decimal(34,0)) div"
        " cast(cast(a as decimal(19,0)) * cast(a + 1 as decimal(19,0)) as decimal(38,0)) as bigint) as score"
        " from values (9000000000001L, 160000000000007L) as t(a, n)"
    ).first()[0]
    assert exact == 1000 * 9000000000001 * 160000000000007 // (9000000000001 * 9000000000002)


@given(st.lists(st.integers(0, 4), max_size=60), st.integers(2, 5))
@settings(max_examples=200, deadline=None)
def test_the_index_counts_every_phrase_once(ids, depth):
    index = PhraseIndex(np.array(ids, np.int64), depth)
    found = {}
    for phrases, counts in index.phrases(depth):
        for phrase, count in zip(phrases.tolist(), counts.tolist()):
            assert tuple(phrase) not in found
            found[tuple(phrase)] = count
    want = Counter(tuple(ids[i : i + d]) for d in range(2, depth + 1) for i in range(len(ids) - d + 1) if 0 not in ids[i : i + d])
    assert found == dict(want)


@given(st.lists(st.integers(0, 3), min_size=1, max_size=40))
@settings(max_examples=100, deadline=None)
def test_intervals_hold_the_suffixes_of_their_phrase(ids):
    index = PhraseIndex(np.array(ids, np.int64), 3)
    padded = [0, *ids, 0]
    order = sorted(range(len(padded)), key=lambda i: [padded[(i + k) % len(padded)] for k in range(4)])
    found = index.extended(index.extended(index.words(), True), False)
    for phrase, first, count in zip(found[0].tolist(), found[1].tolist(), found[3].tolist()):
        for i in order[first : first + count]:
            assert [padded[(i + k) % len(padded)] for k in range(3)] == phrase


def test_lone_words_are_passed_over():
    ids = np.array([0, 3, 0, 0, 1, 2, 0, 4])
    assert phrase_index._without_lone_words(ids).tolist() == [1, 2, 0]
