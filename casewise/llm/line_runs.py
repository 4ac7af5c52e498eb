"""Line dedup: runs of lines that repeat anywhere in the corpus, found by a suffix array over line ids.

Lines with a word become ids; blank lines are passed over. The suffixes of all documents, taken as
sequences of line ids, are ranked by distributed prefix doubling: the rank of 2^(k+1) lines is the rank
of the pair (rank of the first 2^k, rank of the next 2^k) in the order of all pairs. Lines and runs
that occur once drop out on the way, as nothing repeats there. A suffix array at depth L falls into
the intervals of suffixes whose common prefix is at least L lines long; the two overlapping ranks
that cover L lines name the interval. The first suffix of an interval is the first copy of its run,
all others are later copies.

A run counts if it has at least ``min_words`` words. A line lies in a later copy of such a run if and only if
a shortest such run from its first line on, or up to its last line, is one that contains it, so only
these runs, at most two per line, are looked up. They have at most ``min_words`` lines, which bounds the
depth of the doubling (six ranks for 50 words) however long the repeats are; overlapping ones
are joined to maximal runs at the end. Copies that overlap each other count as copies.

The order of documents is that of their keys, null first; rows of one key go by a hash of their text, and
rows equal in key and text are one document. Only ids and positions are shuffled, texts once at the end.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from casewise.sources.storage import staged

MIN_WORDS = 50
_ROWS = 50_000  # line rows handed on at a time
_DOC = ["key", "print"]


def split_lines(text: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Lines with a word, their line numbers and their word counts."""
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    counts = np.fromiter((len(line.split()) for line in lines), np.int64, len(lines))
    numbers = np.flatnonzero(counts)
    return [lines[i] for i in numbers.tolist()], numbers, counts[numbers]


def shortest_runs(counts: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Per line, the last line of the shortest run from it on with enough words, and the first of that up to it; -1 if none."""
    upto = np.cumsum(counts)
    before = upto - counts
    last = np.searchsorted(upto, before + min_words)
    first = np.searchsorted(before, upto - min_words, "right") - 1
    return np.where(last < len(counts), last, -1), first


def _lines(min_words: int):
    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            first_doc, digests, counts = 0, [], []
            last_doc = len(batch) - 1
            for doc, text in enumerate(batch["text"]):
                lines, _, words = split_lines(text) if text else ([], None, np.zeros(0, np.int64))
                digests.extend(map(xxhash.xxh3_128_digest, lines))
                counts.append(words)
                if digests and (len(digests) > _ROWS or doc == last_doc):
                    yield table(batch.iloc[first_doc : doc + 1], digests, counts)
                    first_doc, digests, counts = doc + 1, [], []

    def table(docs: pd.DataFrame, digests: list[bytes], counts: list[np.ndarray]) -> pd.DataFrame:
        ids = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        sizes = [len(c) for c in counts]
        runs = [shortest_runs(c, min_words) for c in counts]
        of = np.repeat(np.arange(len(docs)), sizes)
        return pd.DataFrame(
            {
                "id1": ids[:, 0],
                "id2": ids[:, 1],
                "at": np.concatenate([np.arange(size) for size in sizes]),
                "last": np.concatenate([last for last, _ in runs]),
                "first": np.concatenate([first for _, first in runs]),
                "key": docs["key"].take(of).to_numpy(),
                "print": docs["print"].to_numpy()[of],
            }
        )

    return explode


def _ranked(df: DataFrame, by: list[str], keep: list[str]) -> DataFrame:
    """``keep`` and ``rank``, the place of ``by`` in the order of all its values that occur more than once."""
    repeated = df.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1").select(*by)
    ranks = staged(repeated.orderBy(*by).withColumn("rank", F.monotonically_increasing_id()), "ranks")
    return staged(df.join(ranks, by).select(*keep, "rank").distinct(), "ranked")


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, print, spans): runs that are later copies, as (first, last) over the lines with a word.

    ``docs`` has ``key``, ``text`` and ``print``, a hash of the text. A document's spans are as many as its lines
    at most, and may overlap.
    """
    kind = docs.schema["key"].dataType.simpleString()
    schema = "id1 long, id2 long, at int, last int, first int, key string, print long"
    named = docs.select(F.col("key").cast("string").alias("key"), "text", "print")  # pandas has no null in numbers
    lines = staged(named.mapInPandas(_lines(min_words), schema).withColumn("key", F.col("key").cast(kind)), "lines")
    level = _ranked(lines, ["id1", "id2"], [*_DOC, "at", "last", "first"])
    runs = level.select(
        *_DOC,
        F.explode(
            F.array(
                F.struct(F.col("at").alias("start"), F.col("last").alias("end")),
                F.struct(F.col("first").alias("start"), F.col("at").alias("end")),
            )
        ).alias("run"),
    ).select(*_DOC, "run.*").where("start >= 0 and end >= 0").distinct()
    lines_in = F.col("end") - F.col("start") + 1
    runs = staged(runs.withColumn("size", lines_in).withColumn("level", F.floor(F.log2(lines_in + 0.5)).cast("int")), "runs")
    deepest = runs.agg(F.max("level")).first()[0]
    if deepest is None:
        return runs.select(*_DOC, F.array(F.struct(F.col("start").alias("first"), F.col("end").alias("last"))).alias("spans"))
    ranks = level.select(*_DOC, "at", "rank", F.lit(0).alias("level"))
    for k in range(deepest):
        step = 1 << k
        along = Window.partitionBy(*_DOC).orderBy("at")
        pairs = level.select(
            *_DOC,
            "at",
            F.col("rank").alias("head"),
            F.lead("rank", step).over(along).alias("tail"),
            F.lead("at", step).over(along).alias("next"),
        ).where(F.col("next") == F.col("at") + step)
        level = _ranked(pairs.drop("next"), ["head", "tail"], [*_DOC, "at"])
        ranks = ranks.unionByName(level.select(*_DOC, "at", "rank", F.lit(k + 1).alias("level")))

    def with_rank(df: DataFrame, place: str, name: str) -> DataFrame:
        """Add the rank of the suffix at ``place``, to the depth of the run's level."""
        found = ranks.select(*[F.col(c).alias(f"_{c}") for c in (*_DOC, "level", "at")], F.col("rank").alias(name))
        same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("print") == F.col("_print"))
        here = (F.col("level") == F.col("_level")) & (F.col(place) == F.col("_at"))
        return df.join(found, same & here).drop("_key", "_print", "_level", "_at")

    cover = F.col("end") + 1 - F.expr("shiftleft(1, level)")
    covered = with_rank(with_rank(runs, "start", "head").withColumn("cover", cover), "cover", "tail")
    named = staged(covered.select(*_DOC, "start", "end", "size", "head", "tail"), "named")
    place = F.struct(*_DOC, "start")
    firsts = named.groupBy("size", "head", "tail").agg(F.min(place).alias("copy"), F.count("*").alias("n")).where("n > 1")
    # written: a join of two tables lets Spark split the rows of a run that many documents share
    firsts = staged(firsts.drop("n"), "firsts")
    later = named.join(firsts, ["size", "head", "tail"]).where(~place.eqNullSafe(F.col("copy")))
    span = F.struct(F.col("start").alias("first"), F.col("end").alias("last"))
    return later.groupBy(*_DOC).agg(F.collect_list(span).alias("spans"))


def without_spans(text: str, spans: list) -> tuple[str, list[tuple[int, int]], int]:
    """The text without the lines of the spans, the maximal runs taken out as line numbers, and how many lines they have."""
    lines = text.split("\n")
    _, numbers, _ = split_lines(text)
    gone = np.zeros(len(numbers) + 1, np.int64)
    for span in spans:
        gone[span["first"]] += 1
        gone[span["last"] + 1] -= 1
    out = np.cumsum(gone)[:-1] > 0
    edges = np.diff(np.concatenate([[0], out.astype(np.int8), [0]]))
    bounds = zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True)
    runs = [(int(numbers[a]), int(numbers[b - 1])) for a, b in bounds]
    removed = set(numbers[out].tolist())
    return "\n".join([line for i, line in enumerate(lines) if i not in removed]), runs, len(removed)


def drop_repeated_runs(df: DataFrame, key: str, text: str, min_words: int = MIN_WORDS) -> DataFrame:
    """``df`` packed as ``row``, with its ``kept_text``, ``runs`` taken out and ``n_removed`` lines.

    ``runs`` are (first, last) line numbers. A null text stays null; a row without repeats keeps its
    text as it is. Blank lines are never taken out. Rows equal in key and text are one document and lose the same lines. An empty
    table gives no rows; a very long text is as many rows as it has lines until its spans come back as one.
    """
    packed = df.select(
        F.struct("*").alias("row"),
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{text}`").alias("text"),
        F.xxhash64(f"`{text}`").alias("print"),
    )
    spans = repeated_spans(packed.select("key", "text", "print"), min_words)
    spans = spans.withColumnsRenamed({"key": "of", "print": "of_print"})

    @F.pandas_udf("kept string, runs array<struct<first: int, last: int>>, n_removed long")
    def rewrite(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        rows = [(None, None, 0) if s is None else without_spans(t, s) for t, s in zip(texts, found, strict=True)]
        return pd.DataFrame(
            {
                "kept": [r[0] for r in rows],
                "runs": [r[1] and [{"first": a, "last": b} for a, b in r[1]] for r in rows],
                "n_removed": [r[2] for r in rows],
            }
        )

    joined = packed.join(spans, F.col("key").eqNullSafe(F.col("of")) & (F.col("print") == F.col("of_print")), "left")
    touched = F.when(F.col("spans").isNotNull(), F.col("text"))
    done = joined.select("row", "text", rewrite(touched, F.col("spans")).alias("new"))
    return done.select(
        "row",
        F.coalesce("new.kept", "text").alias("kept_text"),
        F.coalesce("new.runs", F.array().cast("array<struct<first: int, last: int>>")).alias("runs"),
        "new.n_removed",
    )
