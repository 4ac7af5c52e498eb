"""The most frequent tokens of a corpus without counting its whole vocabulary."""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from casewise.operators.corpus import token_counts, top_tokens
from casewise.operators.totals import top_k
from casewise.sources.storage import staged

CAPACITY = 8192  # tokens that a task's first summary holds
MOST = 1 << 20  # beyond that all tokens are counted instead


class Summary:
    """Counts of at most ``capacity`` tokens, each too low by ``missed`` at most; so are those of all others, at 0."""

    def __init__(self, capacity: int):
        self.capacity, self.missed = capacity, 0
        self.counts: dict[str, int] = {}

    def add(self, tokens: list[str], counts: list[int]) -> None:
        mine = self.counts
        for token, n in zip(tokens, counts, strict=True):
            mine[token] = mine.get(token, 0) + n
        if len(mine) > self.capacity:
            cut = sorted(mine.values(), reverse=True)[self.capacity]
            self.counts = {token: n - cut for token, n in mine.items() if n > cut}
            self.missed += cut


def _summaries(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(capacity)
        for batch in batches:
            counted = pc.value_counts(batch.column(0).flatten().drop_null())
            summary.add(counted.field("values").to_pylist(), counted.field("counts").to_pylist())
        tokens, counts = list(summary.counts), list(summary.counts.values())
        columns = [pa.array([*tokens, None], pa.string()), pa.array([*counts, summary.missed], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["token", "n"])

    return run


def heavy_hitters(df: DataFrame, tokens: str, k: int, capacity: int = CAPACITY) -> DataFrame:
    """(token, n) of the ``k`` most frequent tokens, exactly, ties by token.

    Each task sums its tokens up in a summary of bounded size. Merged, they bound every token's count from both sides, and so
    name all tokens that can be among the first ``k``; a second pass counts only these. If the bounds leave tokens
    open that no summary has, they are drawn closer by larger summaries. What is shuffled depends on tasks
    and ``capacity``, not on the vocabulary. Null tokens do not count.
    """
    lists = df.select(F.coalesce(F.col(tokens), F.array().cast("array<string>")).alias("tokens"))
    while capacity <= MOST:
        rows = staged(lists.mapInArrow(_summaries(capacity), "token string, n long"), "summaries")
        merged = rows.where("token is not null").groupBy("token").agg(F.sum("n").alias("low"))
        missed = rows.where("token is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
        if not missed:
            return top_k(merged.select("token", F.col("low").alias("n")), [F.desc("n"), F.asc("token")], k)
        least = top_k(merged, [F.desc("low")], k).agg(F.min("low").alias("low"), F.count("*").alias("n")).first()
        if least["n"] == k and missed < least["low"]:
            named = staged(merged.where(F.col("low") + missed >= least["low"]).select("token"), "candidates")
            counted = lists.select(F.explode("tokens").alias("token")).join(named, "token", "left_semi")
            return top_tokens(counted.groupBy("token").agg(F.count("*").alias("n")), k)
        capacity *= 8
    return top_tokens(token_counts(lists.select(F.filter("tokens", lambda t: t.isNotNull()).alias("tokens"))), k)
