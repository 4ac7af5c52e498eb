"""Url filter: all glob rules at once, as a bit-parallel wildcard automaton (Shift-And).

Every rule becomes a glob over the canonical url: ``*.example.com<edge>/en/*`` for the rule
``example.com/en/``. The canonical url is a dot, the lower-cased host, an edge symbol that no byte
equals, and the path. All globs lie one after another in a mask of several 64-bit words: one bit for
each position of each glob. A step shifts the whole mask by one and keeps the bits whose symbol
matches; a ``*`` keeps its bit as long as its symbols go on. Urls of one batch take each step together.

Nulls and urls without ``://`` have an empty host and path, which no rule fits. Long urls cost no
more than their host and the longest rule: a url leaves the batch when no bit can change any more.
"""

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

EDGE = 256  # the symbol between host and path
SYMBOLS = 257
_ONE = np.uint64(1)


class Rule(NamedTuple):
    """``host`` and all its subdomains, with paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


class GlobAutomaton:
    """Masks of many globs. A glob is a list of symbols; ``None`` in it is a host wildcard.

    Every glob also ends in an open wildcard: it has matched once its last symbol has.
    """

    def __init__(self, globs: Sequence[Sequence[int | None]]):
        bits = sum(len(glob) + 1 for glob in globs)
        self.words = max(1, -(-bits // 64))
        self.step = np.zeros((SYMBOLS, self.words), np.uint64)  # bits reached by a symbol from the bit before
        self.stay = np.zeros((SYMBOLS, self.words), np.uint64)  # wildcard bits kept by a symbol
        self.start = np.zeros(self.words, np.uint64)
        self.final = np.zeros(self.words, np.uint64)
        self.ends: list[tuple[int, np.uint64]] = []
        at, places = 0, []
        for glob in globs:
            self._set(self.start, at)  # the bit before the first symbol
            for symbol in glob:
                if symbol is None:  # any run of host symbols, also none, after the bit reached
                    for other in range(EDGE):
                        self._set(self.stay[other], at)
                else:
                    at += 1
                    self._set(self.step[symbol], at)
            for other in range(SYMBOLS):
                self._set(self.stay[other], at)
            self._set(self.final, at)
            places.append(at)
            self.ends.append((at // 64, _ONE << np.uint64(at % 64)))
            at += 1
        self.places = np.array(places, np.int64)

    @staticmethod
    def _set(mask: np.ndarray, bit: int) -> None:
        mask[bit // 64] |= _ONE << np.uint64(bit % 64)

    def run(self, texts: Sequence[Sequence[int]]) -> np.ndarray:
        """(text, glob) table of what matched."""
        state = self._states(texts)
        return np.stack([(state[:, word] & bit) != 0 for word, bit in self.ends], axis=1) if self.ends else np.zeros((len(texts), 0), bool)

    def first(self, texts: Sequence[Sequence[int]]) -> np.ndarray:
        """The first glob that matched each text, -1 if none did; no table of all globs is made."""
        hits = self._states(texts) & self.final
        word = (hits != 0).argmax(axis=1)
        bits = hits[np.arange(len(hits)), word]
        lowest = np.bitwise_count((bits & (~bits + _ONE)) - _ONE)
        glob = np.searchsorted(self.places, word * 64 + lowest)
        return np.where(bits != 0, glob, -1)

    def _states(self, texts: Sequence[Sequence[int]]) -> np.ndarray:
        """The masks after each whole text."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        lengths = np.array([len(texts[i]) for i in order], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        symbols = np.concatenate([np.asarray(texts[i], np.int16) for i in order]) if order else np.zeros(0, np.int16)
        state = np.tile(self.start, (len(order), 1))
        live = np.arange(len(order))
        at = 0
        while True:
            live = live[: np.searchsorted(-lengths[live], -at)]  # longest first: those with a symbol left
            if not len(live):
                break
            now = state[live]
            symbol = symbols[starts[live] + at]
            shifted = now << _ONE
            shifted[:, 1:] |= now[:, :-1] >> np.uint64(63)
            after = (shifted & self.step[symbol]) | (now & self.stay[symbol])
            state[live] = after
            live = live[(after & ~self.final).any(axis=1)]  # else only matches are left, and they stay
            at += 1
        found = np.empty_like(state)
        found[order] = state
        return found


def compile_rules(rules: Sequence[Rule]) -> GlobAutomaton:
    """The automaton of the rules, over the symbols of :func:`canonical`."""
    return GlobAutomaton([[None, *f".{r.host}".encode(), EDGE, *r.path.encode()] for r in rules])


def canonical(host: str, path: str) -> np.ndarray:
    text = b"." + host.encode("utf-8", "surrogatepass")
    rest = path.encode("utf-8", "surrogatepass")
    out = np.empty(len(text) + 1 + len(rest), np.int16)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    out[len(text)] = EDGE
    out[len(text) + 1 :] = np.frombuffer(rest, np.uint8)
    return out


def judge_urls(df: DataFrame, url: str, rules: Sequence[Rule], default: str = "allow") -> DataFrame:
    """All columns of ``df`` with ``host``, ``path``, ``rule`` and ``verdict`` of its url.

    The longest rule that fits decides, the first of equal ones; without any, ``rule`` is null and
    the verdict is ``default``. Columns of these four names in ``df`` are replaced. A repeated row
    is judged as often as it comes; an empty table gives an empty one.
    """
    ranked = sorted(rules, key=lambda r: -len(r.text))  # stable: the first of equal length stays first

    @F.pandas_udf("int")
    def fitting(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        automaton = compile_rules(ranked)
        for host, path in batches:
            yield pd.Series(automaton.first([canonical(h, p) for h, p in zip(host, path, strict=True)]).astype(np.int32))

    parts = "(?s)^.*?://([^/?#]*)([^?#]*)"
    kept = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    host = F.translate(F.regexp_extract(url, parts, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract(url, parts, 2), F.lit("")).alias("path"),
    )
    judged = split.withColumn("fit", fitting("host", "path"))
    texts = F.array(*[F.lit(r.text) for r in ranked]) if ranked else F.array().cast("array<string>")
    verdicts = F.array(*[F.lit(r.verdict) for r in ranked]) if ranked else F.array().cast("array<string>")
    return judged.select(
        *[F.col("row").getField(c).alias(c) for c in kept],
        "host",
        "path",
        F.when(F.col("fit") >= 0, F.get(texts, F.col("fit"))).alias("rule"),
        F.when(F.col("fit") >= 0, F.get(verdicts, F.col("fit"))).otherwise(F.lit(default)).alias("verdict"),
    )
