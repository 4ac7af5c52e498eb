"""The pipeline: its stages against brute force, and odd inputs."""

from collections import Counter

import pytest

import corpus_pipeline
from casewise.llm.bpe import Codec, Vocabulary
from casewise.llm.queries import vocabulary_file
from test_line_runs import brute as brute_lines
from test_near_dup import brute as brute_groups, shingles

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def passed(spark, sf_dir):
    """What each stage gets and gives."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        out.append(docs.collect())
        docs = spark.createDataFrame(out[-1], docs.schema)
    return out


def test_stages_keep_the_columns(passed):
    assert all(list(row.asDict()) == COLUMNS for rows in passed[:5] for row in rows)


def test_quality_only_drops_rows(passed):
    assert set(passed[1]) <= set(passed[0]) and 0 < len(passed[1]) < len(passed[0])


def test_lines_as_by_brute_force(passed):
    docs = {r.doc_id: r.text for r in passed[1]}
    gone = brute_lines(docs, 50)
    want = {}
    for key, text in docs.items():
        left = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[key])
        if not gone[key] or left.split():
            want[key] = (left, len(left))
    assert {r.doc_id: (r.text, r.n_chars) for r in passed[2]} == want


def test_one_of_each_group_stays(passed):
    rows = [(r.doc_id, r.text) for r in passed[2]]
    want, _ = brute_groups(rows)
    assert sorted(r.doc_id for r in passed[3]) == sorted({want[i] if shingles(t) else k for i, (k, t) in enumerate(rows)})


def test_mix_repeats_whole_documents(passed):
    before, after = {r.doc_id: r for r in passed[3]}, Counter(r.doc_id for r in passed[4])
    assert set(passed[4]) <= set(passed[3]) and max(after.values()) <= 2
    words = {k: len(r.text.split()) for k, r in before.items()}
    budget = sum(words[k] * n for k, n in after.items())
    assert abs(budget - 1.5 * sum(words.values())) <= 20 * max(words.values())


def test_ids_decode_to_the_texts(passed):
    codec = Codec(Vocabulary(vocabulary_file()))
    texts = {r.doc_id: r.text for r in passed[4]}
    assert len(passed[5]) == len(passed[4])
    for row in passed[5]:
        (ids,) = codec.encode([texts[row.doc_id]])
        assert list(row.ids) == ids and row.n_tokens == len(ids)


def test_run_gives_the_rows_of_the_stages(spark, sf_dir, passed):
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in passed[5])


def test_odd_rows_pass_through_every_stage(spark, sf_dir):
    good = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(30).collect()
    rows = [(*r, "k", 1) for r in good] + [(None, None, None, None, None, None, None), (5, "", "en", "s", 0, "x", 2), (None, good[1].text, None, None, 3, "y", 3)]
    rows += [(*good[2], "k", 1)] * 3
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, size long"
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, docs.limit(0), sf_dir)
        assert empty.columns == docs.columns and empty.count() == 0
        docs = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(docs.collect(), schema)
        assert docs.count() > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count()
