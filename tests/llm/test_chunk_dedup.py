"""Exact copies against plain grouping, and the chunks themselves."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from casewise.llm import frames
from casewise.llm.chunk_dedup import LEAST, MOST, chunk_store, chunks, drop_exact_duplicates, even_texts, exact_duplicates, text_chunks


def even(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def plain(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(even(text), []).append(key)
    smallest = {t: min(keys, key=lambda k: (k is None, k or 0)) for t, keys in groups.items()}
    return sorted(
        ((k, smallest[even(t)], len(groups[even(t)]), hashlib.sha256(even(t).encode()).hexdigest()) for k, t in rows), key=str
    ), len(groups)


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    texts = [" ".join(rng.choices(words, k=rng.choice([1, 5, 100, 900, 6000]))) for _ in range(40)]
    rows = [(i, rng.choice(texts).replace(" ", rng.choice([" ", "\n", "\t \x0b"]))) for i in range(200)]
    tail = texts[-1]
    rows += [(1000 + i, tail[:-1] + c) for i, c in enumerate("xyzx")]  # equal but for the last byte
    rows += [(2000, None), (2001, ""), (2002, " "), (2003, "\n\n"), (2004, " a"), (2005, "a"), (2006, "a "), (2007, "é b"), (2008, "é b")]
    rows += [(None, "only without a key"), (None, texts[0]), (None, "twice without"), (None, "twice without"), (7, "again"), (7, "again"), (6, "again")]
    return rows


def test_groups_equal_plain_ones(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, row string, key int").repartition(4)
    want, n_groups = plain(rows)
    for name_bytes in (16, 1, 0):  # short names stand for several contents, so recipes need variants
        found = exact_duplicates(docs, name_bytes=name_bytes).collect()
        assert sorted(((r["key"], r["keep_key"], r["group_size"], r["digest"]) for r in found), key=str) == want
        assert sum(r["kept"] for r in found) == n_groups
        assert all(r["key"] == r["keep_key"] for r in found if r["kept"])


def test_all_chunks_are_verified_where_hashes_are_too_many(spark, monkeypatch):
    monkeypatch.setattr(frames, "BROADCAST_HASHES", 1)
    rows = corpus()
    found = exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), name_bytes=1).collect()
    assert sorted(((r["key"], r["keep_key"], r["group_size"], r["digest"]) for r in found), key=str) == plain(rows)[0]


def test_rows_that_stay(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    kept = [tuple(r) for r in left.collect()]
    assert len(kept) == plain(rows)[1] == len({even(t) for _, t in kept})


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_duplicates(docs).collect() == [] and drop_exact_duplicates(docs).collect() == []


def test_a_very_long_text_and_texts_from_its_chunks(spark):
    rng = random.Random(2)
    long = " ".join(str(rng.random()) for _ in range(150_000))
    docs = spark.createDataFrame([(1, long), (2, long.replace(" ", "\n")), (3, long + "!")], "doc_id long, text string")
    assert {r["key"]: (r["keep_key"], r["group_size"]) for r in exact_duplicates(docs).collect()} == {1: (1, 2), 2: (1, 2), 3: (3, 1)}
    parts = text_chunks(docs).where("key = 3").orderBy("at").collect()
    assert b"".join(p["content"] for p in parts).decode() == long + "!"
    store = chunk_store(docs)
    assert store.count() <= len(parts) + 2  # three texts share all chunks but the last


@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té ")), max_size=8), st.integers(0, 3))
@settings(max_examples=200, deadline=None)
def test_even_texts(texts, skipped):
    array = pa.array(["  "] * skipped + texts, pa.string()).slice(skipped)
    assert [t.decode() for t in even_texts(array)] == [even(t) for t in texts]


@given(st.binary(max_size=400), st.integers(0, 200))
@settings(max_examples=50, deadline=None)
def test_chunks_are_bounded_and_follow_from_content(noise, repeats):
    rng = np.random.default_rng(len(noise))
    body = rng.integers(97, 120, 60_000).astype(np.uint8).tobytes()
    text = noise * repeats + body
    found = chunks(text)
    assert b"".join(found) == text
    assert all(len(c) <= MOST for c in found) and all(len(c) >= LEAST for c in found[:-1])
    assert set(found[-5:]) <= set(chunks(b"another head " + body))  # cuts come together again behind a change
