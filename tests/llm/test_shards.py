"""The Feistel shuffle: a permutation, its inverse, and even shards."""

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from casewise.llm.frames import counted_out
from casewise.llm.queries import QUERIES
from casewise.llm.shard_shuffle import Permutation, shuffle_into_shards


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**63 - 1))
def test_permutation_and_inverse(n, seed):
    numbers = np.arange(n)
    places = Permutation(n, seed).place(numbers)
    assert sorted(places.tolist()) == numbers.tolist()
    assert Permutation(n, seed).number(places).tolist() == numbers.tolist()


def test_shuffle_mixes():
    places = Permutation(10_000, 1).place(np.arange(10_000))
    assert abs(np.corrcoef(places, np.arange(10_000))[0, 1]) < 0.05
    assert (places != Permutation(10_000, 2).place(np.arange(10_000))).mean() > 0.99


def check_shards(rows, shards):
    by = {}
    for row in rows:
        by.setdefault(row.shard, []).append(row.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(by) <= set(range(shards))


def test_all_documents_in_even_shards(spark, sf_dir):
    rows = QUERIES["op2_shuffle_shards"].build(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    check_shards(rows, 24)
    assert sorted((r.doc_id, r.size) for r in rows) == sorted((d.doc_id, len(d.text.encode()) + 8) for d in docs)
    crc = {d.doc_id: zlib.crc32(d.text.encode()) for d in docs}
    assert all(r.text_crc32 == crc[r.doc_id] and r.law == "rows" and r.grown_shard is None for r in rows)


def test_same_places_under_any_partitioning_with_repeats_and_nulls(spark):
    rows = [(i % 50 if i % 3 else None, "x" * (i % 4), 7) for i in range(600)] + [(1, "hot", 0)] * 300
    schema = "k long, shard string, bucket int"
    found = [
        sorted(map(tuple, shuffle_into_shards(spark.createDataFrame(rows, schema).repartition(n), 7, seed=5).collect()), key=str)
        for n in (1, 5)
    ]
    assert found[0] == found[1]
    back = shuffle_into_shards(spark.createDataFrame(rows, schema), 7, seed=5).collect()
    check_shards(back, 7)
    assert sorted(r.row_number for r in back) == list(range(900))
    assert Counter(r.k for r in back) == Counter(r[0] for r in rows)


@pytest.mark.parametrize("rows", [0, 1, 2])
def test_tiny_tables(spark, rows):
    df = spark.createDataFrame([(i,) for i in range(rows)], "k long")
    assert len(shuffle_into_shards(df, 24).collect()) == rows


def plain_place(number, n, seed):
    """The network with Python's whole numbers, one number at a time."""
    mask64 = (1 << 64) - 1

    def mix(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask64
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask64
        return x ^ (x >> 31)

    half = max(1, ((n - 1).bit_length() + 1) // 2)
    keys = [mix((i * 0x9E3779B97F4A7C15 + seed) & mask64) for i in range(1, 7)]
    while True:
        left, right = number >> half, number & ((1 << half) - 1)
        for key in keys:
            left, right = right, left ^ (mix(right ^ key) & ((1 << half) - 1))
        number = left << half | right
        if number < n:
            return number


def test_places_of_all_documents_in_plain_python(spark, sf_dir):
    """Numbers by bucket and content, places by a network of its own; only the hash of a row is Spark's."""
    found = QUERIES["op2_shuffle_shards"].build(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = docs.count()
    buckets = 1
    while buckets * buckets < n:
        buckets *= 2
    utf8 = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    row = F.struct("doc_id", (F.octet_length(utf8) + 8).cast("long").alias("size"), F.crc32(utf8).alias("text_crc32"))
    rows = docs.select(row.alias("row"), F.pmod(F.xxhash64(row), F.lit(buckets)).alias("bucket")).collect()
    ordered = sorted((r["bucket"], tuple(r["row"])) for r in rows)
    want = {}
    for number, (_, key) in enumerate(ordered):
        place = plain_place(number, n, 20)
        want[key] = (place % 24, place // 24)
    assert {(r["doc_id"], r["size"], r["text_crc32"]): (r["shard"], r["slot"]) for r in found} == want


def test_a_hot_row_is_counted_out_by_many_tasks(spark):
    rows = spark.createDataFrame([("hot", 100, 400_000), ("cold", 0, 100), ("none", 7, 0)], "k string, first long, copies long")
    out = counted_out(rows.where("copies > 0"), F.col("first"), "copies", "number", block=10_000)
    facts = out.groupBy("k").agg(F.count("*"), F.min("number"), F.max("number"), F.countDistinct("number"))
    assert sorted(map(tuple, facts.collect())) == [("cold", 100, 0, 99, 100), ("hot", 400_000, 100, 400_099, 400_000)]
    sizes = [r["count"] for r in out.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 200_000
