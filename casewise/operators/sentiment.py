"""Sentiment by rules or by any batch scorer."""

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from casewise.functions.domain import NEUTRAL_CODE, SENTIMENT_CODES
from casewise.functions.text import rule_sentiment
from casewise.operators.lookup import map_codes
from casewise.operators.series import share_of_total
from casewise.operators.totals import top_k
from casewise.sources.readers import literal_table

Scorer = Callable[[list[str]], list[tuple[str, float]]]


def score_by_rule(df: DataFrame, text: str, severity: Sequence[str], relief: Sequence[str]) -> DataFrame:
    """Add ``sentiment`` and ``score`` from word lists; all in column expressions."""
    return df.withColumn("sentiment", rule_sentiment(F.col(text), severity, relief)).withColumn("score", F.lit(1.0))


def rule_scorer(severity: Sequence[str], relief: Sequence[str]) -> Callable[[], Scorer]:
    """The same rule in the form of a batch scorer."""

    def load() -> Scorer:
        def one(text: str) -> tuple[str, float]:
            lowered = text.lower()
            severe = sum(word in lowered for word in severity)
            mild = sum(word in lowered for word in relief)
            return ("NEG" if severe > mild else "POS" if mild > severe else "NEU"), 1.0

        return lambda texts: [one(text) for text in texts]

    return load


def score_batches(df: DataFrame, key: str, text: str, load: Callable[[], Scorer], batch_size: int = 32) -> DataFrame:
    """(key, sentiment, score) from a scorer that takes a list of texts.

    ``load`` runs once per task, so a model is loaded there and never shipped. Texts arrive in
    Arrow batches and go to the scorer whole, ``batch_size`` at a time; a null text is ``""``.
    """

    def run(batches):
        scorer = load()
        for batch in batches:
            texts = batch.iloc[:, 1].fillna("").tolist()
            scored = []
            for start in range(0, len(texts), batch_size):
                scored.extend(scorer(texts[start : start + batch_size]))
            yield pd.DataFrame(
                {key: batch.iloc[:, 0], "sentiment": [label for label, _ in scored], "score": [float(s) for _, s in scored]}
            )

    schema = f"`{key}` {dict(df.dtypes)[key]}, sentiment string, score double"
    return df.select(key, F.col(text).alias("_text")).mapInPandas(run, schema)


def score_by_length(
    df: DataFrame, key: str, text: str, load: Callable[[], Scorer], batch_size: int = 32, max_tokens: int | None = None
) -> DataFrame:
    """(key, sentiment, score) with batches of texts of like length, for models that pad a batch to its longest text.

    The rows of a task are sorted by length first; nothing is shuffled. ``load`` runs once per Python worker, which keeps the
    model from task to task. ``max_tokens`` cuts a text after so many whitespace tokens, as models with a limited
    input do by themselves; by default texts are scored whole. A null text is ``""``.
    """

    def make() -> Callable[[np.ndarray], dict[str, np.ndarray]]:
        scorer = load()

        def predict(texts: np.ndarray) -> dict[str, np.ndarray]:
            scored = scorer([str(t) for t in texts])
            return {"sentiment": np.array([label for label, _ in scored]), "score": np.array([float(s) for _, s in scored])}

        return predict

    kind = T.StructType([T.StructField("sentiment", T.StringType()), T.StructField("score", T.DoubleType())])
    score = predict_batch_udf(make, return_type=kind, batch_size=batch_size)
    whole = F.coalesce(F.col(text), F.lit(""))
    if max_tokens is not None:
        whole = F.regexp_extract(whole, f"^\\s*(?:\\S+\\s+){{0,{max_tokens - 1}}}\\S+", 0)
    sorted_rows = df.select(key, whole.alias("_text")).sortWithinPartitions(F.length("_text"))
    return sorted_rows.select(key, score("_text").alias("_found")).select(key, "_found.sentiment", "_found.score")


def phrase_table(spark: SparkSession, phrases: Sequence[str]) -> DataFrame:
    """A handful of phrases typed in by hand, as a table with one column ``phrase``."""
    return literal_table(spark, [(p,) for p in phrases], "phrase string")


def score_phrases(
    phrases: DataFrame, phrase: str, severity: Sequence[str], relief: Sequence[str], load: Callable[[], Scorer] | None = None
) -> DataFrame:
    """Score short phrases by the word lists, or by a batch scorer."""
    if load is None:
        return score_by_rule(phrases, phrase, severity, relief)
    return score_batches(phrases, phrase, phrase, load)


def sentiment_distribution(scored: DataFrame, sentiment: str = "sentiment") -> DataFrame:
    return share_of_total(scored.groupBy(sentiment).agg(F.count("*").alias("n")), "n")


def with_sentiment_code(scored: DataFrame, sentiment: str = "sentiment") -> DataFrame:
    """Add ``sentiment_code``; a missing or unknown sentiment is neutral."""
    return map_codes(scored, sentiment, list(SENTIMENT_CODES.items()), [("sentiment_code", "int", NEUTRAL_CODE)])


def urgent_first(scored: DataFrame, key: str, k: int, negative: str = "NEG") -> DataFrame:
    """The ``k`` negative texts to look at first: highest score, then key."""
    return top_k(scored.where(F.col("sentiment") == negative), [F.desc("score"), F.asc(key)], k)
