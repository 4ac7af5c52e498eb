"""The codec against the public library, on documents and on odd texts."""

import hashlib
import time

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

tokenizers = pytest.importorskip("tokenizers")

from casewise.llm.bpe import NO_PAIR, Codec, Vocabulary, code_texts
from casewise.llm.queries import QUERIES, vocabulary_file

FILE = vocabulary_file()
LIBRARY = tokenizers.Tokenizer.from_str(FILE)
VOCABULARY = Vocabulary(FILE)
ODD = "aAbB'sΣςİß \t\n\x1c\x85 \xa0　éé1²½٣!<|endoftext|>中文字🙂ﬁ’ll'd_\x00​̀"


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from([*ODD, "<|endoftext|>", "<|startoftext|>", "the", "'ll"]), max_size=60).map("".join)))
def test_any_text_as_the_library(text):
    codec = Codec(VOCABULARY)
    (ids,) = codec.encode([text])
    assert ids == library(text)
    assert codec.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 5000, "abc" * 3000, "aaa b" * 400, "  ", "\n", "x" * 63, "x" * 64, "x" * 65, "é" * 33])
def test_long_words(text):
    assert list(Codec(VOCABULARY).encode([text])) == [library(text)]


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "a", "the"])
def test_a_word_of_131072_letters_takes_seconds(letters):
    rng = np.random.default_rng(7)
    word = "".join(rng.choice(list(letters), 131_072)) if letters != "the" else letters * 43_690
    begun = time.perf_counter()
    found = VOCABULARY.encode_words([word])
    assert time.perf_counter() - begun < 30  # some 3 on an idle machine
    assert list(found[0]) == library(word)


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="abcthe", min_size=1, max_size=300))
def test_one_word_is_merged_as_many_are(word):
    raw = np.frombuffer(word.encode(), np.uint8)
    symbols = VOCABULARY.first[raw]
    symbols[-1] = VOCABULARY.last[raw[-1]]
    width = max(2, 1 << (len(word) - 1).bit_length())
    (many,) = VOCABULARY._merge(symbols, np.array([0]), np.array([len(word)]), width)
    assert VOCABULARY._merge_one(symbols.tolist(), width) == many


def test_cache_generations_do_not_change_results():
    texts = [f"word{i} and word{i % 7}, Word{i % 3}" for i in range(300)]
    codec = Codec(VOCABULARY, cached=5)
    assert list(codec.encode(texts)) == [library(t) for t in texts] == list(codec.encode(texts))


def test_root_is_the_leftmost_lowest_rank():
    symbols = VOCABULARY.first[np.frombuffer(b"thethethe", np.uint8)]
    ranks = VOCABULARY.ranks(symbols[:-1], symbols[1:])
    assert ranks.min() < NO_PAIR and VOCABULARY.encode_words(["thethethe"]) == [tuple(library("thethethe"))]


def test_all_documents_as_the_library(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op6_bpe_round_trip"].build(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for row in rows:
        ids = library(docs[row.doc_id])
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_null_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(None, 1), ("", 2), ("Hello  World", 3)], "text string, ids int")
    rows = {r.row.ids: r for r in code_texts(df, "text", FILE).collect()}
    assert [list(rows[i].ids) for i in (1, 2, 3)] == [[], [], library("hello world")]
    assert [rows[i].decoded for i in (1, 2)] == ["", ""] and rows[3].n_tokens == 2
    assert code_texts(df.limit(0), "text", FILE).collect() == []


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        Vocabulary(FILE.replace('"type": "Lowercase"', '"type": "Strip"').replace('"type":"Lowercase"', '"type":"Strip"'))
