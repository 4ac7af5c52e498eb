"""Near duplicates by MinHash with tensored banding, verified on full shingle sets.

A table of the usual banding needs K fresh minhashes, so L tables need L * K. Here two collections of
m small sketches (``WIDTH`` minhashes each) are made, and table (i, j) is keyed by sketch i of the
first and sketch j of the second: m * m tables from 2 * m sketches. Two sets meet in some table as
soon as they agree in one sketch of each collection. With m = 12 and two minhashes a sketch, sets of
similarity 0.75 are missed with probability 0.0001, of 0.8 with 0.00001.

1. Every text becomes its set of 5-word shingles, as 64-bit hashes; equal sets become one node.
2. Nodes that meet in a table of two or three nodes are all compared; in a larger one, each with its
   smallest node. That costs at most one pair per node and table, whatever the group. The m tables
   (i, i) go first, so that large families are already one component when all tables are gone through;
   a component then counts as one node of a large table.
3. Pairs whose sizes and sketches allow the similarity are confirmed on the full sets.
4. Links become components. Within a large table, a pair that was not compared matters only if it
   lies in two components. All nodes of such tables are joined again by prefix and position filtering on
   their full sets, which is exact, between components only; the components are then final.

Copies are never expanded into pairs, and no table, group or candidate list is cut.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from casewise.llm.components import connected_components
from casewise.llm.frames import only_hashes
from casewise.sources.storage import staged

SHINGLE = 5
SKETCHES = 12  # m, per collection
WIDTH = 2  # minhashes in a sketch
MIN_AGREEMENT = 0.4  # of the minhashes; a pair at 0.75 is below with probability 2e-7
PERCENT = 75
ROUNDS, DRAWS = 3, 4  # of comparing components through one node a shingle and draw, before all that is left is joined

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_MASK = (1 << 64) - 1
_BLOCK = 1 << 18  # bytes hashed at a time, in whole texts


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_KEYS = _mix(np.arange(1, 2 * SKETCHES * WIDTH + 1, dtype=np.uint64) * _ODD)
_TAPS = _mix(np.arange(101, 101 + SHINGLE, dtype=np.uint64) * _ODD) | np.uint64(1)


class _Powers:
    """Powers of the base of the rolling hash and of its inverse, as long as was needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (self._powers(base, size) for base in (_BASE, pow(_BASE, -1, 1 << 64)))
        return self.up, self.down

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        factors = np.full(size + 1, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)


_POWERS = _Powers()


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word, with A-Z as a-z; words part at the six ASCII white-space bytes."""
    data = np.frombuffer(text, np.uint8)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], white, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    upper = (data >= 65) & (data <= 90)
    up, down = _POWERS.upto(len(data) + 1)
    letters = (data + 1 + 32 * upper.astype(np.uint8)).astype(np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(letters * up[: len(data)], dtype=np.uint64, out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingles; fewer words than a shingle are one shingle, no words none."""
    if not len(words):
        return words
    if len(words) < SHINGLE:
        return _mix((words * _TAPS[: len(words)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(words)))
    n = len(words) - SHINGLE + 1
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        total += words[k : k + n] * _TAPS[k]
    return np.unique(_mix(total))


def text_sets(texts: pd.Series) -> Iterator[np.ndarray]:
    """The shingle set of every text, whole; null gives an empty one."""
    pending: list[bytes] = []
    size = 0
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        if pending and size + len(raw) > _BLOCK:
            yield from _block_sets(pending)
            pending, size = [], 0
        pending.append(raw)
        size += len(raw) + 1
    yield from _block_sets(pending)


def _block_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    if not texts:
        return
    words = word_hashes(b"\n".join(texts))
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    begins = np.flatnonzero(~white & np.concatenate([[True], white[:-1]]))
    lengths = np.array([len(t) + 1 for t in texts])
    cuts = np.searchsorted(begins, np.concatenate([[0], np.cumsum(lengths)]))
    for first, last in zip(cuts[:-1], cuts[1:], strict=True):
        yield shingle_set(words[first:last])


def minhashes(found: np.ndarray) -> np.ndarray:
    """32 bits of each minhash of a set; zeros for the empty set."""
    least = np.full(len(_KEYS), _MASK, np.uint64)
    for at in range(0, len(found), 8192):
        part = (found[at : at + 8192][None, :] ^ _KEYS[:, None]) * _ODD
        part ^= part >> np.uint64(29)
        part *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(least, part.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32) if len(found) else np.zeros(len(_KEYS), np.int32)


def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, text_hash, n, fp1, fp2, sketch) of (key, text, text_hash)."""
    for batch in batches:
        if batch.empty:
            continue
        n, fp, sketches = [], [], []
        for found in text_sets(batch["text"]):
            n.append(len(found))
            order = np.arange(len(found), dtype=np.uint64)
            fp.append((found.sum(dtype=np.uint64), (_mix(found + _ODD) ^ (order * _ODD)).sum(dtype=np.uint64)))
            sketches.append(minhashes(found))
        prints = np.array(fp, np.uint64).reshape(-1, 2).view(np.int64)
        yield pd.DataFrame({"key": batch["key"], "text_hash": batch["text_hash"], "n": n, "fp1": prints[:, 0], "fp2": prints[:, 1], "sketch": sketches})


def table_keys(sketches: np.ndarray) -> np.ndarray:
    """(set, table): 64-bit keys of all m * m tables from the two collections."""
    values = sketches.view(np.uint32).astype(np.uint64).reshape(len(sketches), 2, SKETCHES, WIDTH)
    short = np.zeros((len(sketches), 2, SKETCHES), np.uint64)
    for k in range(WIDTH):
        short = _mix(short * _ODD + values[:, :, :, k] + np.uint64(k + 1))
    pairs = short[:, 0, :, None] * _TAPS[0] + short[:, 1, None, :] * _TAPS[1]
    number = np.arange(SKETCHES * SKETCHES, dtype=np.uint64).reshape(SKETCHES, SKETCHES) * _TAPS[2]
    return _mix(pairs + number).reshape(len(sketches), -1)


_TABLE = "table long, node long, component long"


def _tables(scouts: bool):
    """Rows of all tables, or only of the m tables (i, i), which share no sketch."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.iloc[at : at + 2000]
                keys = table_keys(np.stack(part["sketch"].to_numpy()))
                keys = keys[:, :: SKETCHES + 1] if scouts else keys
                node, component = (np.repeat(part[c].to_numpy(), keys.shape[1]) for c in ("node", "component"))
                yield pd.DataFrame({"table": keys.ravel().view(np.int64), "node": node, "component": component})

    return rows


def _near_sizes(left: str, right: str):
    return F.least(left, right) * 100 >= F.greatest(left, right) * PERCENT


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_hash, n_shingles, component, component_id) with one row for every row of ``docs``.

    ``component_id`` is the smallest key that links reach, ``component`` a number of the group and
    ``text_hash`` Spark's xxhash64 of the text. Rows without words are linked with nothing: they have
    their own key and a null ``component``. Rows of equal sets are linked, so repeated rows and keys share a
    component. A null key is a ``component_id`` only where links reach no other.
    """
    spark = docs.sparkSession
    named = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`").alias("text_hash")
    )
    kind = named.schema["key"].dataType.simpleString()
    written = named.withColumn("key", F.col("key").cast("string"))  # pandas has no null in numbers
    sketches = written.mapInPandas(sketched, "key string, text_hash long, n long, fp1 long, fp2 long, sketch array<int>")
    rows = staged(sketches.withColumn("key", F.col("key").cast(kind)), "sketches")
    place = F.struct(F.col("key").isNull().alias("unnamed"), F.col("key"), F.col("text_hash"))
    same = rows.where("n > 0").groupBy("fp1", "fp2").agg(
        F.min(place).alias("first"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    same = same.select("fp1", "fp2", F.col("first.key").alias("first_key"), F.col("first.text_hash").alias("first_hash"), "n", "sketch")
    nodes = staged(same.withColumn("node", F.monotonically_increasing_id()), "nodes")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = nodes.select("node", "sketch").repartition(parts, "node")  # a node has a row per table from here on
    scouts = spread.withColumn("component", F.col("node")).mapInPandas(_tables(True), _TABLE)
    pairs, _ = _meetings(scouts)
    links = _links(pairs, named, nodes)
    component = staged(connected_components(links), "components")
    known = spread.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    pairs, large = _meetings(known.mapInPandas(_tables(False), _TABLE))
    links = staged(links.unionByName(_links(pairs, named, nodes)), "links")
    component = staged(connected_components(links), "components")

    labelled = large.select("table", "node").join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("table").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
    rest = staged(labelled.join(mixed.select("table"), "table", "left_semi").select("node", "component").distinct(), "rest")
    if not rest.isEmpty():
        more = _prefix_links(rest, _node_sets(named, nodes, rest.select("node")))
        if not more.isEmpty():
            component = staged(connected_components(links.unionByName(more)), "components")

    placed = nodes.select("fp1", "fp2", "node", "first_key").join(component, "node", "left")
    placed = staged(placed.withColumn("component", F.coalesce("component", "node")), "placed")
    smallest = placed.groupBy("component").agg(F.min("first_key").alias("component_id"))
    known = placed.join(smallest, "component").select("fp1", "fp2", "component", "component_id")
    return (
        rows.select("key", "text_hash", "n", "fp1", "fp2")
        .join(known, ["fp1", "fp2"], "left")
        .select(
            "key",
            "text_hash",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component")).alias("component"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"),
        )
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each group: that of the smallest key, then text hash, null keys last.

    Rows without words all stay. Of repeated rows of the document that stays, one stays.
    """
    found = staged(near_duplicates(docs, key, text).where("component is not null").select("component", "key", "text_hash"), "found")
    place = F.struct(F.col("key").isNull().alias("unnamed"), F.col("key"), F.col("text_hash"))
    heads = found.groupBy("component").agg(F.min(place).alias("head"))
    losing = ~place.eqNullSafe(F.col("head"))
    losers = found.join(heads, "component").where(losing).select(F.col("key").alias("lost"), F.col("text_hash").alias("lost_hash")).distinct()
    repeated = found.groupBy("key", "text_hash").agg(F.count("*").alias("n")).where("n > 1")
    repeated = repeated.select(F.col("key").alias("again"), F.col("text_hash").alias("again_hash"))
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{key}`").alias("key"), F.xxhash64(f"`{text}`").alias("text_hash"))
    left = rows.join(losers, F.col("key").eqNullSafe(F.col("lost")) & (F.col("text_hash") == F.col("lost_hash")), "left_anti")
    if not repeated.isEmpty():
        same = F.col("key").eqNullSafe(F.col("again")) & (F.col("text_hash") == F.col("again_hash"))
        once = left.join(repeated, same, "left_anti")
        left = once.unionByName(left.join(repeated, same, "left_semi").dropDuplicates(["key", "text_hash"]))
    return left.select("row.*")


def _meetings(tables: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(u, v) to compare of nodes that share a table but no component, and the rows of tables of over three nodes.

    In a large table every component is stood for by its smallest node, and compared with the first of these.
    """
    met = staged(
        tables.groupBy("table")
        .agg(
            F.count("*").alias("size"),
            F.min("node").alias("low"),
            F.max("node").alias("high"),
            F.bit_xor("node").alias("all"),
            F.min("component").alias("first"),
            F.max("component").alias("last"),
        )
        .where("size > 1 and first < last"),
        "met",
    )
    middle = F.col("all").bitwiseXOR(F.col("low")).bitwiseXOR(F.col("high"))

    def pair(u, v):
        return F.struct(u.alias("u"), v.alias("v"))

    two = F.array(pair(F.col("low"), F.col("high")))
    three = F.array(pair(F.col("low"), F.col("high")), pair(F.col("low"), middle), pair(middle, F.col("high")))
    few = met.where("size <= 3").select(F.explode(F.when(F.col("size") == 2, two).otherwise(three)).alias("pair"))
    large = staged(tables.join(met.where("size > 3").select("table", "low"), "table"), "large")
    heads = large.groupBy("table", "component").agg(F.min("node").alias("v"), F.min("low").alias("u"))
    star = heads.where("u <> v").select("u", "v")
    return few.select("pair.*").unionByName(star).distinct(), large


def _links(pairs: DataFrame, named: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs that are confirmed on their full sets, of those whose sizes and sketches allow it."""
    sketch = nodes.select("node", "n", "sketch")
    left = sketch.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("sketch").alias("su"))
    right = sketch.select(F.col("node").alias("v"), F.col("n").alias("nv"), F.col("sketch").alias("sv"))
    agreeing = F.aggregate(F.zip_with("su", "sv", lambda a, b: (a == b).cast("int")), F.lit(0), lambda a, b: a + b)
    likely = (
        pairs.join(left, "u").join(right, "v").where(_near_sizes("nu", "nv")).where(agreeing >= MIN_AGREEMENT * len(_KEYS))
    )
    likely = staged(likely.select("u", "v"), "pairs")
    needed = likely.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    return staged(_confirm(likely, _node_sets(named, nodes, needed)), "links")


def _node_sets(named: DataFrame, nodes: DataFrame, needed: DataFrame) -> DataFrame:
    """(node, shingles) of the needed nodes, from the text of one row of each."""
    wanted = nodes.join(needed, "node", "left_semi").select("node", "fp1", "fp2", "first_key", "first_hash")
    wanted = staged(wanted, "wanted")
    named = only_hashes(named, wanted.select(F.col("first_hash").alias("text_hash")), "text_hash")
    same = F.col("key").eqNullSafe(F.col("first_key")) & (F.col("text_hash") == F.col("first_hash"))
    texts = named.join(wanted, same)
    found = texts.select("node", "fp1", "fp2", "text").mapInPandas(_checked_sets, "node long, shingles array<long>")
    return staged(found.dropDuplicates(["node"]), "sets")


def _checked_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sets of rows that really are of the node: other texts may share the key and the hash."""
    for batch in batches:
        nodes, out, size = [], [], 0
        for node, fp1, found in zip(batch["node"], batch["fp1"], text_sets(batch["text"]), strict=True):
            if len(found) and int(found.sum(dtype=np.uint64).astype(np.int64)) == fp1:
                nodes.append(node)
                out.append(found.view(np.int64))
                size += len(found)
            if size > _BLOCK:
                yield pd.DataFrame({"node": nodes, "shingles": out})
                nodes, out, size = [], [], 0
        if nodes:  # an empty frame has no arrays to tell the type of its column by
            yield pd.DataFrame({"node": nodes, "shingles": out})


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("right"))
    both = pairs.join(left, "u").join(right, "v").select(
        "u", "v", (F.size("left") + F.size("right")).alias("sizes"), F.size(F.array_intersect("left", "right")).alias("shared")
    )
    return both.where(F.col("shared") * (100 + PERCENT) >= F.col("sizes") * PERCENT).select("u", "v")


def _prefix_links(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """All links between different components among the nodes of ``rest`` (node, component), exactly.

    Shingles are ordered by how many nodes have them. Two sets of the similarity share a shingle
    among their first n - ceil(0.75 n) + 1, so only these are joined, and only shingles that lie in
    more than one component. As long as these have many more pairs than rows, every component is first
    compared through one node a shingle and draw, which costs a pair a row and draw at most, and what is found to be linked is
    one component from then on. The join at the end is whole, between the components that are left.
    """
    rows = sets.select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    common = rows.groupBy("shingle").agg(F.count("*").alias("df"))
    ordered = rows.join(common, "shingle")
    place = F.row_number().over(Window.partitionBy("node").orderBy("df", "shingle"))
    prefix = ordered.withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1)
    prefix = staged(prefix.where("df > 1").select("shingle", "node", "n", "place"), "prefix")
    links = None
    for turn in range(ROUNDS):
        shared, excess = _shared(prefix, rest)
        if not excess:
            break
        found = staged(_confirm(_pivot_pairs(shared, turn), sets), "links")
        if found.isEmpty():
            break
        links = found if links is None else links.unionByName(found)
        rest = staged(_merged(rest, found), "rest")
    shared, _ = _shared(prefix, rest)
    left, right = _side(shared, "u"), _side(shared, "v")
    pairs = left.join(right, "shingle").where("component_u < component_v").where(_near_places())
    pairs = pairs.select(F.col("node_u").alias("u"), F.col("node_v").alias("v")).distinct()
    last = staged(_confirm(pairs, sets), "links")
    return last if links is None else links.unionByName(last)


def _shared(prefix: DataFrame, rest: DataFrame) -> tuple[DataFrame, bool]:
    """The rows of ``prefix``, with components, whose shingle lies in several, and whether their pairs outnumber them."""
    labelled = prefix.join(rest, "node")
    sizes = labelled.groupBy("shingle", "component").agg(F.count("*").cast("double").alias("k"))
    spread = sizes.groupBy("shingle").agg(F.sum("k").alias("rows"), F.sum(F.col("k") * F.col("k")).alias("squares"), F.count("*").alias("parts"))
    spread = staged(spread.where("parts > 1"), "spread")
    total = spread.agg(F.sum("rows").alias("rows"), F.sum((F.col("rows") * F.col("rows") - F.col("squares")) / 2).alias("pairs")).first()
    return labelled.join(spread.select("shingle"), "shingle", "left_semi"), (total["pairs"] or 0) > 2 * (total["rows"] or 0)


def _side(rows: DataFrame, side: str) -> DataFrame:
    return rows.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "component", "n", "place")])


def _near_places():
    # at the first shingle two sets share, no more than the rest of the shorter one can still be shared
    most = 1 + F.least(F.col("n_u") - F.col("place_u"), F.col("n_v") - F.col("place_v"))
    enough = most * (100 + PERCENT) >= PERCENT * (F.col("n_u") + F.col("n_v"))
    return _near_sizes("n_u", "n_v") & enough


def _pivot_pairs(shared: DataFrame, turn: int) -> DataFrame:
    """(u, v): under every shingle and draw, one node of each component and one node of all."""
    row = F.struct(F.xxhash64("node", "shingle", "draw").alias("drawn"), "component", "node", "n", "place")
    draws = shared.withColumn("draw", F.explode(F.sequence(F.lit(turn * DRAWS), F.lit(turn * DRAWS + DRAWS - 1))))
    heads = draws.groupBy("shingle", "draw", "component").agg(F.min(row).alias("row"))
    heads = staged(heads.select(F.xxhash64("shingle", "draw").alias("shingle"), "row.*"), "heads")
    pivots = heads.groupBy("shingle").agg(F.min(F.struct("drawn", "component", "node", "n", "place")).alias("row")).select("shingle", "row.*")
    met = _side(heads, "u").join(_side(pivots, "v"), "shingle").where("component_u <> component_v").where(_near_places())
    return met.select(F.least("node_u", "node_v").alias("u"), F.greatest("node_u", "node_v").alias("v")).distinct()


def _merged(rest: DataFrame, links: DataFrame) -> DataFrame:
    """``rest`` with one number for the components that ``links`` join."""
    u, v = (rest.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")) for side in "uv")
    joined = links.join(u, "u").join(v, "v").select(F.col("cu").alias("u"), F.col("cv").alias("v"))
    roots = connected_components(joined).select(F.col("node").alias("component"), F.col("component").alias("root"))
    return rest.join(roots, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
