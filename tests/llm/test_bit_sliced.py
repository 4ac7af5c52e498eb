"""Top-k search against brute force."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from casewise.llm.bit_sliced import IndexBlock, quantised, top_k_search


def brute(ids, rows, query_ids, queries, k):
    out = set()
    for query_id, query in zip(query_ids, queries):
        scored = sorted((-int(np.dot(query.astype(object), row.astype(object))), int(i)) for i, row in zip(ids, rows) if i != query_id)
        out |= {(int(query_id), i, -s) for s, i in scored[:k]}
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 150), st.integers(1, 9), st.integers(1, 25), st.integers(0, 40))
def test_block_equals_brute_force(seed, n, dims, k, spread):
    rng = np.random.default_rng(seed)
    rows = rng.integers(-spread, spread + 1, (n, dims)).astype(np.int32)
    ids = rng.permutation(3 * n)[:n].astype(np.int64)
    queries, query_ids = rows[: min(n, 40)], ids[: min(n, 40)]
    got = IndexBlock(ids, rows).search(query_ids, queries, k)
    assert {(int(query_ids[q]), i, s) for q, i, s in zip(*[x.tolist() for x in got])} == brute(ids, rows, query_ids, queries, k)


def test_search_over_many_blocks(spark):
    rng = np.random.default_rng(3)
    rows = rng.integers(-20, 20, (300, 6)).astype(np.int32)
    rows[100:200] = rows[100]  # one vector fills a third of the table
    ids = np.arange(300)
    vectors = spark.createDataFrame([(int(i), r.tolist()) for i, r in zip(ids, rows)], "id long, vector array<int>").repartition(4)
    found = top_k_search(vectors, vectors.where("id % 7 = 0"), 5, index_block=40, query_block=9).collect()
    queries = ids[::7]
    assert {(r.query_id, r.vec_id, r.score) for r in found} == brute(ids, rows, queries, rows[queries], 5)
    for query in queries.tolist():
        mine = sorted((r.rank, -r.score, r.vec_id) for r in found if r.query_id == query)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5] and mine == sorted(mine, key=lambda m: m[1:])


def test_odd_vectors_take_no_part(spark):
    rows = [
        (1, [0.5, -0.5]), (2, None), (3, [0.1, None]), (4, [float("nan"), 0.0]), (5, [float("inf"), 0.0]), (6, [1.0, 1.0]), (None, [1.0, 1.0]), (8, [1.0]), (9, [])
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id long, e array<float>, vector string")
    vectors = df.select("id", quantised("e", 64).alias("vector"))
    found = {(r.query_id, r.vec_id): r.score for r in top_k_search(vectors, vectors, 20).collect()}
    assert {i for pair in found for i in pair} == {1, 6, 8, 9}
    assert found[1, 6] == 32 * 64 - 32 * 64 and found[6, 8] == 64 * 64 and found[6, 9] == 0


def test_oversized_vectors_are_an_error_and_not_left_out(spark):
    rows = [(1, [0.5]), (2, [2.0e17]), (3, [float("nan")]), (4, [float("-inf")]), (5, None)]
    vectors = spark.createDataFrame(rows, "id long, e array<double>").select("id", quantised("e", 64).alias("vector"))
    assert [r.vector for r in vectors.where("id <> 2").orderBy("id").collect()] == [[32], None, None, None]
    with pytest.raises(Exception, match="component above"):
        top_k_search(vectors, vectors, 3).collect()


@pytest.mark.parametrize("rows", [[], [(1, [1, 2])]])
def test_nothing_to_find(spark, rows):
    vectors = spark.createDataFrame(rows, "id long, vector array<int>")
    assert top_k_search(vectors, vectors, 3).collect() == []


def plain_lists(rows, queries, k):
    """The sorted lists of all query rows, from Python's whole numbers."""
    lists = []
    for query_id, query in queries:
        scored = sorted((-sum(a * b for a, b in zip(query, row)), i) for i, row in rows if i != query_id)
        lists.append((query_id, [(i, -s) for s, i in scored[:k]]))
    return sorted(lists)


@pytest.mark.parametrize("size", [3, 10**9 * 64, 1 << 59])
def test_repeated_ids_and_large_components(spark, size):
    rng = np.random.default_rng(9)
    rows = [(int(i), [int(x) for x in rng.integers(-1, 2, 5)]) for i in rng.integers(0, 30, 90)]
    rows += [(40, [size, -size + 1, 0, 1, 0]), (41, [-size, size, 2, 0, 0]), (1, [1, 0, 0, 0, 0]), (1, [1, 0, 0, 0, 0]), (3, [size])]
    queries = [r for r in rows if r[0] < 12 and max(map(abs, r[1])) < 2]
    vectors = spark.createDataFrame(rows, "id long, vector array<long>").repartition(3)
    asked = spark.createDataFrame(queries, "id long, vector array<long>").repartition(2)
    found = top_k_search(vectors, asked, 6, index_block=20, query_block=7).collect()
    lists, position = [], {}
    for row in sorted(found, key=lambda r: (r.query_id, r["rank"], r.vec_id)):
        position.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    want = {}
    for query_id, listed in plain_lists(rows, queries, 6):
        want.setdefault(query_id, []).extend((n, i, s) for n, (i, s) in enumerate(listed, 1))
    assert {q: sorted(v) for q, v in position.items()} == {q: sorted(v) for q, v in want.items()}


def test_two_rows_of_one_id_lose_no_other(spark):
    rows = [(1, [1]), (1, [1]), (3, [10]), (4, [5])]
    vectors = spark.createDataFrame(rows, "id long, vector array<int>")
    found = top_k_search(vectors, vectors.where("id = 1"), 2).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in found) == [(1, 3, 10)] * 2 + [(2, 4, 5)] * 2


def test_a_score_past_64_bits_is_an_error(spark):
    vectors = spark.createDataFrame([(1, [1 << 59]), (2, [1 << 59])], "id long, vector array<long>")
    with pytest.raises(Exception, match="64 bits"):
        top_k_search(vectors, vectors, 1).collect()


def test_blocks_go_through_bytes():
    rng = np.random.default_rng(1)
    block = IndexBlock(np.arange(70), rng.integers(-9, 9, (70, 3)))
    again = IndexBlock.unpacked(70, *[block.packed()[name][0] for name in ("ids", "low", "bits", "slices")])
    assert np.array_equal(block.slices, again.slices) and np.array_equal(block.valid, again.valid)
    wide = again.fitted(5)
    assert wide.search(np.array([-1]), np.array([[1, 2, 3, 4, 5]]), 4)[2].tolist() == block.search(np.array([-1]), np.array([[1, 2, 3]]), 4)[2].tolist()
