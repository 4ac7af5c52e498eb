"""Word lists of any length against texts."""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casewise.functions.automaton import Automaton

GROUP_BYTES = 1 << 22  # bytes of patterns in one automaton; longer lists become several
MOST_PATTERNS = 1_000_000  # patterns of a list that is read from a table
_BLOCK = 1 << 20  # bytes of texts gone through at a time, in whole texts


def _groups(patterns: Sequence[str]) -> Iterator[list[int]]:
    group, size = [], 0
    for number, pattern in enumerate(patterns):
        group.append(number)
        size += len(pattern.encode("utf-8", "surrogatepass"))
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def _finder(patterns: Sequence[str], at: int):
    groups = [(np.array(group), Automaton([patterns[i] for i in group])) for group in _groups(patterns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.large_string()).fill_null("")
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            of, numbers = [], []
            first = 0
            while first < len(texts):
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _BLOCK, "right")) - 1)
                for group, automaton in groups:
                    text, number = automaton.found(data, offsets[first : last + 1])
                    of.append(text + first)
                    numbers.append(group[number])
                first = last
            of, numbers = (np.concatenate(part) if part else np.zeros(0, np.int64) for part in (of, numbers))
            order = np.lexsort((numbers, of))
            ends = np.searchsorted(of[order], np.arange(len(texts) + 1))
            found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(numbers[order], pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "found"])

    return run


def word_list(df: DataFrame, column: str, most: int = MOST_PATTERNS) -> list[str]:
    """The distinct values of a column in order, as a list of patterns; an error if they are more than ``most``."""
    found = df.select(F.col(column).alias("word")).where("word is not null").distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"a list of more than {most} patterns")
    return sorted(row["word"] for row in found)


def patterns_found(df: DataFrame, text: str | Column, patterns: Sequence[str], output: str = "found") -> DataFrame:
    """``df`` with the numbers of the patterns that its text contains, ascending, each once.

    The whole text is searched, as it is; a null text contains only what an empty one does. The cost of a text
    does not depend on the number of patterns, up to ``GROUP_BYTES`` of them at a time.
    """
    named = df.select(F.struct("*").alias("row"), (F.col(text) if isinstance(text, str) else text).alias("text"))
    kind = named.schema["row"].dataType.simpleString()
    found = named.mapInArrow(_finder(list(patterns), 1), f"row {kind}, text string, found array<int>")
    return found.select("row.*", F.col("found").alias(output))


def lexicon_sentiment(df: DataFrame, text: str, severity: Sequence[str], relief: Sequence[str]) -> DataFrame:
    """The word-list rule for lists of any length: ``NEG`` if more severity words occur than relief words, ``POS`` if fewer, else ``NEU``."""
    found = patterns_found(df, F.lower(F.coalesce(F.col(text), F.lit(""))), [*severity, *relief], "_found")
    severe = F.size(F.filter("_found", lambda i: i < len(severity)))
    mild = F.size("_found") - severe
    sentiment = F.when(severe > mild, "NEG").when(mild > severe, "POS").otherwise("NEU")
    return found.withColumn("sentiment", sentiment).drop("_found")
