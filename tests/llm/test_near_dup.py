"""Near-duplicate components against all pairs, and the parts of the method."""

import random
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from casewise.llm import near_dup
from casewise.llm.components import connected_components
from casewise.llm.near_dup import drop_near_duplicates, minhashes, near_duplicates, shingle_set, table_keys, word_hashes

WORDS = [f"w{i}" for i in range(3000)]


def words_of(text):
    lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x20\x09-\x0d]+", lowered)


def shingles(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """Smallest key reachable for each row number, null last."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    return {i: min((rows[j][0] for j in g), key=lambda k: (k is None, k or 0)) for g in groups.values() for i in g}, sets


def corpus(seed):
    rng = random.Random(seed)
    texts = [rng.choices(WORDS, k=rng.choice([3, 6, 30, 80, 200])) for _ in range(60)]
    passage = rng.choices(WORDS, k=60)
    texts += [rng.choices(WORDS, k=30) + passage + rng.choices(WORDS, k=10) for _ in range(60)]  # one passage in many
    base = rng.choices(WORDS, k=150)
    for _ in range(60):  # one large family
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = rng.choice(WORDS)
        texts.append(copy)
    for text in texts[:40]:
        for edits in (0, 1, 2, 5):
            copy = list(text)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            texts.append(copy)
    rng.shuffle(texts)
    rows = [(i, rng.choice([" ", "\n", "  "]).join(t).title() if rng.random() < 0.2 else " ".join(t)) for i, t in enumerate(texts)]
    return rows + [(1000, None), (1001, ""), (1002, " \n"), (None, rows[3][1]), (None, "only null has this text here"), (5, rows[5][1])]


@pytest.mark.parametrize("seed", range(2))
def test_equals_all_pairs(spark, seed):
    rows = corpus(seed)
    want, sets = brute(rows)
    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)], "doc_id long, text string, n long").repartition(4)
    found = near_duplicates(df).collect()
    got = sorted(((r.key, r.n_shingles, r.component_id) for r in found), key=str)
    assert got == sorted(((rows[i][0], len(sets[i]), want[i]) for i in range(len(rows))), key=str)
    left = drop_near_duplicates(df)
    assert left.columns == df.columns
    kept = left.collect()
    groups = {want[i] if sets[i] else ("empty", i) for i in range(len(rows))}
    assert len(kept) == len({(want[r.n]) if sets[r.n] else ("empty", r.n) for r in kept}) == len(groups)


def test_large_keys_beside_a_null_one(spark):
    rows = [(2**62 + 1, "one two three"), (2**62 + 2, "one two three"), (None, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {(r.key, r.component_id) for r in near_duplicates(df).collect()}
    assert found == {(2**62 + 1, 2**62 + 1), (2**62 + 2, 2**62 + 1), (None, None)}


def test_small_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(df).collect() == [] and drop_near_duplicates(df).collect() == []
    one = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted((r.key, r.n_shingles, r.component_id) for r in near_duplicates(one).collect()) == [(1, 0, 1), (2, 0, 2)]
    assert drop_near_duplicates(one).count() == 2


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("abAÀ \t\n\x0b\x1c\xa0é"), max_size=80))
def test_words_are_told_apart(text):
    words = words_of(text)
    hashes = word_hashes(text.encode())
    assert len(hashes) == len(words) and len(set(hashes.tolist())) == len(set(words))
    assert len(shingle_set(hashes)) == len(shingles(text))


def test_minhashes_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(1)
    agree = []
    for _ in range(60):
        both = rng.integers(0, 2**63, 800, dtype=np.int64).astype(np.uint64)
        a, b = np.unique(both[:700]), np.unique(both[100:])
        agree.append((minhashes(a) == minhashes(b)).mean())
    assert abs(np.mean(agree) - 600 / 800) < 0.02


def test_tables_meet_where_both_sketches_agree():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**31, 2 * near_dup.SKETCHES * near_dup.WIDTH, dtype=np.int32)
    b = a.copy().reshape(2, near_dup.SKETCHES, near_dup.WIDTH)
    b[0, 1:] += 1
    b[1, :-1] += 1
    met = (table_keys(np.stack([a])) == table_keys(np.stack([b.ravel()]))).ravel()
    assert np.flatnonzero(met).tolist() == [near_dup.SKETCHES - 1]  # sketch 0 of one, the last of the other
    assert len(np.unique(table_keys(np.stack([a])))) == near_dup.SKETCHES**2


def test_prefix_links_find_what_tables_do_not(spark):
    """The exact join alone gives all links between components."""
    text_sets = near_dup.text_sets

    def raw_sets(batches):
        for batch in batches:
            yield batch.assign(shingles=[s.view("int64") for s in text_sets(batch["text"])])[["node", "shingles"]]

    rows = corpus(7)[:200]
    named = spark.createDataFrame(rows, "node long, text string")
    sets = near_dup.staged(named.mapInPandas(raw_sets, "node long, shingles array<long>"), "sets")
    rest = named.selectExpr("node", "node as component")
    links = {(r.u, r.v) for r in near_dup._prefix_links(rest, sets).collect()}
    want = set()
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            x, y = shingles(a), shingles(b)
            if x and 100 * len(x & y) >= 75 * len(x | y):
                want.add((rows[j][0], rows[i][0]))
    assert links == want


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(7, 7), (40, 39)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(300)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_rows_of_one_key_meet_only_their_own_node(spark, monkeypatch):
    rng = random.Random(11)
    rows = []
    for i in range(60):  # one key, and no key, for many pairs of near copies
        text = rng.choices(WORDS, k=150)
        rows += [(key, " ".join(words)) for key, words in ((7, text), (None, [*text[:-1], "end"]))]
    read, whole = spark.sparkContext.accumulator(0), near_dup._checked_sets

    def counted(batches):
        def passed():
            for batch in batches:
                read.add(len(batch))
                yield batch

        return whole(passed())

    monkeypatch.setattr(near_dup, "_checked_sets", counted)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 120 and len({r.component for r in found}) == 60 and {r.component_id for r in found} == {7}
    assert 0 < read.value <= 2 * len(rows)  # once for each of the two rounds


def test_two_very_long_near_copies(spark):
    rng = random.Random(8)
    words = rng.choices(WORDS, k=300_000)
    near = words[:150_000] + ["other"] + words[150_000:]
    docs = spark.createDataFrame([(5, " ".join(words)), (3, " ".join(near)), (9, "short and alone here now")], "doc_id long, text string")
    assert {r["key"]: r["component_id"] for r in near_duplicates(docs).collect()} == {5: 3, 3: 3, 9: 9}


def test_no_frame_for_a_batch_without_sets_of_its_nodes():
    batch = pd.DataFrame({"node": [1, 2], "fp1": [0, 0], "fp2": [0, 0], "text": ["a b c d e f", None]})
    assert list(near_dup._checked_sets(iter([batch]))) == []
    assert list(near_dup.sketched(iter([batch.iloc[:0]]))) == []


def test_components_are_not_compared_through_all_their_nodes(spark, monkeypatch):
    """A family of 1000 in one component and 20 sets beside it, all linked: some pairs a set tell so, not 1000."""
    rest = spark.createDataFrame([(i, 0 if i < 1000 else i) for i in range(1020)], "node long, component long")
    core, own = F.sequence(F.lit(1), F.lit(100)), F.transform(F.sequence(F.lit(1), F.lit(3)), lambda k: F.col("node") * 10 + k + 1000)
    sets = rest.select("node", F.concat(core, own).cast("array<long>").alias("shingles"))
    counted, confirm = [], near_dup._confirm

    def counting(pairs, found):
        counted.append(pairs.count())
        return confirm(pairs, found)

    monkeypatch.setattr(near_dup, "_confirm", counting)
    links = near_dup._prefix_links(rest, sets)
    assert {r.component for r in near_dup._merged(rest, links).select("component").distinct().collect()} == {0}
    assert 20 <= sum(counted) < 5000  # 20,190 between all nodes of the components
