"""Merkle manifest of a dataset: a persistent tree whose versions copy only the way to a changed leaf.

Leaves of a tree (the rows of a source) lie in the order of their key, and every ``FAN`` consecutive nodes become one, level
by level, until one is left: the subroot. Subroots are the leaves of a last tree, whose node is the root.

Positions are cut into aligned blocks of ``FAN`` ** ``HEIGHT`` nodes. A block is a subtree that one task
builds whole; its top is a node of the next stage, which is cut into blocks again, until every tree is one node.
So a stage leaves a ``BLOCK``-th of its nodes to the next, and no tree, however large, is in one task.

Then the stages are gone through from the top downward. A block gets the siblings on the way from its top to the root, and
hands on its own on the way to each of its nodes. A changed leaf makes a version of the tree: its ancestors within
the block are copied with the changed hash beside the nodes that are shared, and the copies go on along the
block's way to the version's root. Untouched nodes are never copied or hashed again.
"""

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from casewise.sources.storage import staged

FAN = 3
HEIGHT = 7
BLOCK = FAN**HEIGHT

Way = list[tuple[list[bytes], int]]  # siblings and the own place among them, level by level upward


def digest(parts: Sequence[bytes]) -> bytes:
    """SHA-256 of the hex texts of digests, one after the other, as hex text."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def levels(nodes: list[bytes], height: int = HEIGHT, whole: bool = True) -> list[list[bytes]]:
    """All levels above ``nodes``, these included: up to one node if they are a ``whole`` tree, else ``height`` more."""
    found = [nodes]
    while len(found[-1]) > 1 or (not whole and len(found) <= height):
        last = found[-1]
        found.append([digest(last[i : i + FAN]) for i in range(0, len(last), FAN)])
    return found


def way_up(found: list[list[bytes]], place: int) -> Way:
    """The siblings of a node and of its ancestors within the block."""
    way = []
    for level in found[:-1]:
        first = place - place % FAN
        run = level[first : first + FAN]
        way.append((run[: place - first] + run[place - first + 1 :], place - first))
        place //= FAN
    return way


def copied_path(leaf: bytes, way: Way) -> Iterator[bytes]:
    """The ancestors a version with another leaf copies, up to its root; siblings are shared."""
    for siblings, place in way:
        leaf = digest([*siblings[:place], leaf, *siblings[place:]])
        yield leaf


def packed(way: Way) -> bytes:
    """A way as bytes: per level the number of siblings, the place, and the digests."""
    return b"".join(bytes([len(siblings), place]) + bytes.fromhex(b"".join(siblings).decode()) for siblings, place in way)


def unpacked(data: bytes) -> Way:
    way, at = [], 0
    while at < len(data):
        n, place = data[at], data[at + 1]
        at += 2
        way.append(([data[at + 32 * i : at + 32 * i + 32].hex().encode() for i in range(n)], place))
        at += 32 * n
    return way


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 of a row's values: each ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def placed(leaves: DataFrame, tree: str, order_by: Sequence[str]) -> DataFrame:
    """``leaves`` with ``position``, the 0-based place of the row in its tree, null first.

    Rows are cut into ranges of tree and order, and counted on from the totals of the ranges before; a tree that holds much of the
    table is cut into many ranges. Rows equal in all of this go by a number of their own, so they are cut too.
    """
    numbered = staged(leaves.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    by = [F.col(f"`{c}`").asc_nulls_first() for c in (tree, *order_by)]
    ordered = staged(numbered.orderBy(*by, "_row").withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    ranges = ordered.groupBy(F.col(f"`{tree}`").alias("_tree"), part.alias("_part")).agg(F.min("_at").alias("_least"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("_tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    same = F.col(f"`{tree}`").eqNullSafe(F.col("_tree")) & (part == F.col("_part"))
    position = F.col("_before") + F.col("_at") - F.col("_least")
    return ordered.join(ranges, same).select(*leaves.columns, position.alias("position"))


def _next_stage(stage: DataFrame, height: int) -> DataFrame:
    """The tops of all blocks, as nodes of the next stage."""
    kind = stage.schema["tree"].dataType.simpleString()

    def top(nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("position")
        found = _block_levels(nodes, height)[-1][0]
        return nodes.slice(0, 1).select(["tree", "block"]).rename_columns(["tree", "position"]).append_column("digest", pa.array([found.decode()]))

    blocks = stage.select("tree", "block", "position", "n_nodes", "digest").groupBy("tree", "block")
    return blocks.applyInArrow(top, f"tree {kind}, position long, digest string")


def _as_stage(nodes: DataFrame, name: str, height: int) -> DataFrame:
    """Nodes (tree, position, digest, ...) with their block and the number of nodes in their tree, written."""
    sizes = nodes.groupBy("tree").agg(F.count("*").alias("n_nodes")).withColumnRenamed("tree", "_tree")
    counted = nodes.join(sizes, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
    return staged(counted.withColumn("block", F.floor(F.col("position") / FAN**height).cast("long")), name)


class Manifest:
    """The tree of a dataset: ``leaves`` with their positions, the subroots in ``roots``, and the ``root`` of all.

    ``leaves`` has ``tree``, ``digest`` (hex) and the columns of ``order_by``, which may be null or repeated; ``height`` is the height
    of a block. An empty table has no root. Other columns stay with the leaves.
    """

    def __init__(self, leaves: DataFrame, order_by: Sequence[str], height: int = HEIGHT):
        self.height = height
        at = placed(leaves, "tree", order_by)
        self.leaves = _as_stage(at, "stage", height)
        self.stages = self._up(self.leaves)
        tops = self.stages[-1].select("tree", "digest")
        forest = placed(tops.withColumnsRenamed({"tree": "name"}).withColumn("tree", F.lit(0)), "tree", ["name"])
        self.forest = self._up(_as_stage(forest, "stage", height))
        self.roots = tops.select(F.col("tree"), F.col("digest").alias("subroot"))
        self.root = self.forest[-1].select(F.col("digest").alias("root"))

    def _up(self, stage: DataFrame) -> list[DataFrame]:
        """All stages over the nodes of one, the last with one node per tree."""
        stages = [stage]
        while not stages[-1].where("n_nodes > 1").isEmpty():
            stages.append(_as_stage(_next_stage(stages[-1], self.height), "stage", self.height))
        return stages

    def _ways(self, stages: list[DataFrame], above: DataFrame) -> DataFrame:
        """(of, top, way) of the blocks of the lowest stage: their tree and number, and the way from the top to the root.

        ``above`` has the way of each tree's top (name, way). The last stage has one node per tree, its top.
        """
        tops = stages[-1].select("tree", "position").join(above, F.col("tree").eqNullSafe(F.col("name")))
        ways = tops.select(F.col("tree").alias("of"), F.col("position").alias("top"), "way")
        for stage in reversed(stages[1:-1]):
            ways = staged(self._down(stage, ways), "ways")
        return ways

    def _down(self, stage: DataFrame, ways: DataFrame) -> DataFrame:
        """The way of every node of a stage, from the ways of its blocks."""
        kind = stage.schema["tree"].dataType.simpleString()
        height = self.height

        def run(nodes: pa.Table, above: pa.Table) -> pa.Table:
            nodes, found, way = _block_of(nodes, above, height)
            own = [packed(way_up(found, i)) + way for i in range(nodes.num_rows)]
            return nodes.select(["tree", "position"]).rename_columns(["of", "top"]).append_column("way", pa.array(own, pa.binary()))

        blocks = stage.select("tree", "block", "position", "n_nodes", "digest").groupBy("tree", "block")
        return blocks.cogroup(ways.groupBy("of", "top")).applyInArrow(run, f"of {kind}, top long, way binary")

    def _forest_ways(self) -> DataFrame:
        """(name, way) of every subroot to the root."""
        last = self.forest[-1].select(F.col("tree").alias("name"), F.lit(b"").alias("way"))
        found = staged(self._down(self.forest[0], self._ways(self.forest, last)), "ways")
        named = self.forest[0].select("name", F.col("position").alias("_at"))
        return named.join(found, F.col("_at") == F.col("top")).select("name", "way")

    def versions(self, changed: str, keep: str) -> DataFrame:
        """``keep``, leaf, subroot, proof, version_root and copied for every leaf.

        ``proof`` is the SHA-256 of the siblings on the way to the root, level by level, left to right; ``version_root`` the
        root of the version in which the leaf is ``changed`` (null: as it is), and ``copied`` the number of
        nodes that this version copies, 0 for a leaf that has not changed.
        """
        ways = self._ways(self.stages, self._forest_ways())
        kinds = {f.name: f.dataType.simpleString() for f in self.leaves.schema}
        height = self.height

        def run(nodes: pa.Table, above: pa.Table) -> pa.Table:
            nodes, found, way = _block_of(nodes, above, height)
            upper = unpacked(way)
            proofs, roots, copied = [], [], []
            for i, (leaf, new) in enumerate(zip(found[0], nodes.column("changed").to_pylist(), strict=True)):
                path = way_up(found, i) + upper
                proofs.append(digest([sibling for siblings, _ in path for sibling in siblings]).decode())
                new = leaf if new is None else new.encode()
                copies = [new, *copied_path(new, path)]
                roots.append(copies[-1].decode())
                copied.append(0 if new == leaf else len(copies))
            columns = [nodes.column("kept"), nodes.column("tree"), nodes.column("digest"), pa.array(proofs, pa.string())]
            names = ["kept", "tree", "leaf", "proof", "version_root", "copied"]
            return pa.table([*columns, pa.array(roots, pa.string()), pa.array(copied, pa.int64())], names=names)

        wanted = self.leaves.select("tree", "block", "position", "n_nodes", "digest", F.col(changed).alias("changed"), F.col(keep).alias("kept"))
        schema = f"kept {kinds[keep]}, tree {kinds['tree']}, leaf string, proof string, version_root string, copied long"
        found = wanted.groupBy("tree", "block").cogroup(ways.groupBy("of", "top")).applyInArrow(run, schema)
        roots = self.roots.select(F.col("tree").alias("_tree"), "subroot")
        joined = found.join(roots, F.col("tree").eqNullSafe(F.col("_tree")))
        return joined.select(F.col("kept").alias(keep), "tree", "leaf", "subroot", "proof", "version_root", "copied")


def _block_of(nodes: pa.Table, above: pa.Table, height: int) -> tuple[pa.Table, list[list[bytes]], bytes]:
    """A block's rows in order, its levels, and the way from its top."""
    nodes = nodes.sort_by("position")
    return nodes, _block_levels(nodes, height), above.column("way")[0].as_py()


def _block_levels(nodes: pa.Table, height: int) -> list[list[bytes]]:
    whole = nodes.column("n_nodes")[0].as_py() <= FAN**height
    return levels([d.encode() for d in nodes.column("digest").to_pylist()], height, whole)


def verified_rows(df: DataFrame, key: str, tree: str, columns: Sequence[str], changed: Mapping[str, Column], if_changed: Column) -> DataFrame:
    """Every row's place in the manifest of ``df``, and whether the row as it is now still leads to the root.

    Trees are the values of ``tree``, null first; leaves lie in the order of ``key``, null first, and then of their digest.
    Where ``if_changed`` holds, ``changed`` replaces values of ``columns``. Gives (key, tree, leaf, subroot, root, proof,
    version_root, copied, verified). Repeated rows are leaves of their own; extra columns do not count; no rows give no rows.
    """
    now = [changed.get(c, F.col(f"`{c}`")) for c in columns]
    leaves = df.select(
        F.col(f"`{tree}`").alias("tree"),
        F.col(f"`{key}`").alias("key"),
        leaf_digest(*[F.col(f"`{c}`") for c in columns]).alias("digest"),
        F.when(if_changed, leaf_digest(*now)).alias("changed"),
    )
    manifest = Manifest(leaves, ["key", "digest"])
    found = manifest.versions("changed", "key")
    root = manifest.root.scalar()
    return found.withColumn("root", root).withColumn("verified", F.col("version_root") == root)
