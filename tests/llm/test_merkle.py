"""The manifest against a plain tree in one list."""

import hashlib
import random

from pyspark.sql import functions as F

from casewise.llm import merkle
from casewise.llm.merkle import Manifest, copied_path, levels, packed, unpacked, verified_rows, way_up


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([sha("".join(found[-1][i : i + 3])) for i in range(0, len(found[-1]), 3)])
    return found


def siblings(found, at):
    out = []
    for level in found[:-1]:
        first = at // 3 * 3
        out += [level[i] for i in range(first, min(first + 3, len(level))) if i != at]
        at //= 3
    return out


def plain(leaves):
    """Root and proof of every (tree, key, digest)."""
    trees = {}
    for tree, key, digest in leaves:
        trees.setdefault(tree, []).append((key is not None, key or 0, digest))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    found = {t: climb([d for *_, d in sorted(trees[t])]) for t in names}
    forest = climb([found[t][-1][0] for t in names])
    proofs = {}
    for i, t in enumerate(names):
        for at, leaf in enumerate(found[t][0]):
            proofs.setdefault((t, leaf), []).append(sha("".join(siblings(found[t], at) + siblings(forest, i))))
    return forest[-1][0], proofs, {t: found[t][-1][0] for t in names}


def leaf_of(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def corpus():
    rng = random.Random(4)
    sizes = {"a": 1, "b": 2, "é": 3, None: 10, "": 4, "z": 28, "big": 700}
    rows = [(rng.randrange(10_000), s, rng.choice(["one\ntwo", "x", None, "", "\n"])) for s, n in sizes.items() for _ in range(n)]
    rows += [(5, "z", "same"), (5, "z", "same"), (5, "z", "other"), (None, "z", "nameless"), (None, "z", None)]
    rows += [(i, f"s{i}", "t") for i in range(40)]  # more trees than a block of the forest
    rng.shuffle(rows)
    return rows


def check(spark, rows, height, monkeypatch):
    monkeypatch.setattr(merkle.Manifest.__init__, "__defaults__", (height,))
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, text string, tree int").repartition(3)
    changed = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    found = verified_rows(docs, "doc_id", "source", ["doc_id", "source", "text"], changed, F.col("doc_id") % 2 == 0).collect()
    leaves = [(s, k, leaf_of(k, s, t)) for k, s, t in rows]
    root, proofs, tops = plain(leaves)
    assert len(found) == len(rows)
    assert all(r["root"] == root and r["subroot"] == tops[r["tree"]] for r in found)
    got = {}
    for r in found:
        got.setdefault((r["tree"], r["leaf"]), []).append(r["proof"])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in proofs.items()}
    hit = {leaf_of(k, s, t) for k, s, t in rows if k is not None and k % 2 == 0 and t and "\n" in t}
    assert hit and all(r["verified"] == (r["leaf"] not in hit) for r in found)
    assert all((r["copied"] > 0) == (r["leaf"] in hit) for r in found)
    # the root of a version is that of the whole tree built anew with the changed leaf
    for r in [r for r in found if r["leaf"] in hit][:5]:
        k, s, t = next(x for x in rows if leaf_of(*x) == r["leaf"])
        again = list(leaves)
        again[leaves.index((s, k, r["leaf"]))] = (s, k, leaf_of(k, s, t.replace("\n", "")))
        if [x for x in leaves if x[:2] == (s, k)] == [(s, k, r["leaf"])]:
            assert r["version_root"] == plain(again)[0]


def test_rows_against_a_plain_tree(spark, monkeypatch):
    check(spark, corpus(), 7, monkeypatch)


def test_many_stages_of_small_blocks(spark, monkeypatch):
    check(spark, corpus(), 2, monkeypatch)


def test_one_row_one_tree_and_none(spark):
    schema = "doc_id long, source string, text string"
    one = spark.createDataFrame([(4, None, "a\nb")], schema)
    changed = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    row = verified_rows(one, "doc_id", "source", ["doc_id", "text"], changed, F.lit(True)).first()
    assert row["leaf"] == row["subroot"] == row["root"] == leaf_of(4, "a\nb") and row["proof"] == sha("")
    assert row["version_root"] == leaf_of(4, "ab") and not row["verified"] and row["copied"] == 1
    none = spark.createDataFrame([], schema)
    assert verified_rows(none, "doc_id", "source", ["doc_id", "text"], changed, F.lit(True)).collect() == []


def test_a_hot_row_is_cut_into_ranges(spark):
    """A third of the table being one row gives positions without gaps, from several ranges."""
    rows = [(1, "s", "same")] * 4000 + [(i, "s", f"t{i}") for i in range(2, 8002)]
    df = spark.createDataFrame(rows, "key long, tree string, digest string").repartition(4)
    found = merkle.placed(df, "tree", ["key", "digest"])
    assert sorted(r["position"] for r in found.collect()) == list(range(12_000))
    hot = [r["position"] for r in found.where("key = 1").collect()]
    assert sorted(hot) == list(range(4000))


def test_ways_go_through_bytes_and_versions_share_siblings():
    nodes = [sha(str(i)).encode() for i in range(11)]
    found = levels(nodes)
    for i, leaf in enumerate(nodes):
        way = way_up(found, i)
        assert unpacked(packed(way)) == way
        assert list(copied_path(leaf, way))[-1] == found[-1][0]
        assert all(s in found[k] for k, (some, _) in enumerate(way) for s in some)


def test_manifest_of_leaves(spark):
    leaves = spark.createDataFrame([("s", i, sha(str(i))) for i in range(5)], "tree string, key long, digest string")
    manifest = Manifest(leaves, ["key"])
    assert manifest.root.first()[0] == climb([sha(str(i)) for i in range(5)])[-1][0]
