"""Connected components of an undirected graph, by alternating stars."""

from pyspark.sql import DataFrame, functions as F

from casewise.sources.storage import drop_staged, staged


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (u, v); the component is its smallest node.

    A large star hangs every larger neighbour of a node on the node's smallest neighbour, a small star
    does so with the smaller neighbours. Only minima are gathered per node, so a hub is one row per
    task; the joins are equi-joins, which adaptive execution splits at a hub. Every round is written
    to the shared folder, and deleted there when the next one is. Links of a node to itself and repeated links do no harm.
    """
    edges = staged(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")
        )
        spent, edges = edges, staged(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
        drop_staged(links.sparkSession, spent)
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
