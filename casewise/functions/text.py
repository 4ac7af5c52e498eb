"""Expressions over whole texts. Nothing here leaves the JVM."""

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def tokens(text: str | Column, min_length: int = 2, stop_words: Sequence[str] = ()) -> Column:
    """Lower-case whitespace tokens of the whole text; punctuation stays attached.

    A null text has no tokens. ``stop_words`` are compared without regard to case.
    """
    column = F.col(text) if isinstance(text, str) else text
    words = F.split(F.lower(F.coalesce(column, F.lit(""))), "\\s+")
    stop = sorted({word.lower() for word in stop_words})
    if not stop:
        return F.filter(words, lambda word: F.length(word) >= min_length)
    return F.filter(words, lambda word: (F.length(word) >= min_length) & ~word.isin(stop))


def richness(ratio: Column, high: float = 0.5, moderate: float = 0.3) -> Column:
    """Name of the vocabulary richness a type-token ratio stands for."""
    return F.when(ratio > high, "alta").when(ratio > moderate, "moderada").otherwise("baja")


def words_present(text: Column, words: Sequence[str]) -> Column:
    """How many of ``words`` occur anywhere in the text, each counted once."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return sum((F.contains(lowered, F.lit(word)).cast("int") for word in words), F.lit(0))


def rule_sentiment(text: Column, severity: Sequence[str], relief: Sequence[str]) -> Column:
    """``NEG`` if more severity words occur than relief words, ``POS`` if fewer, else ``NEU``."""
    severe, mild = words_present(text, severity), words_present(text, relief)
    return F.when(severe > mild, "NEG").when(mild > severe, "POS").otherwise("NEU")
