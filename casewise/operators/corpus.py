"""Statistics of a tokenised corpus. Tokens are counted on the executors and never collected."""

from pyspark.sql import DataFrame, functions as F

from casewise.functions.cleaning import percent
from casewise.functions.text import richness
from casewise.operators.totals import top_k


def token_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(token, n) over the corpus; each task counts before the shuffle, so no token is hot."""
    return df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def corpus_stats(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Documents, tokens, and mean, smallest and largest document length, as one row."""
    length = F.size(tokens)
    return df.select(length.alias("length")).agg(
        F.count("*").alias("documents"),
        F.sum("length").alias("tokens"),
        F.avg("length").alias("mean_tokens"),
        F.min("length").alias("min_tokens"),
        F.max("length").alias("max_tokens"),
    )


def type_token_ratio(counts: DataFrame) -> DataFrame:
    """Vocabulary size, token count, their ratio and what it says, from token counts."""
    found = counts.agg(F.count("*").alias("types"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"))
    ratio = F.coalesce(F.try_divide(F.col("types").cast("double"), F.col("tokens")), F.lit(0.0))
    return found.withColumn("ttr", ratio).withColumn("richness", richness(F.col("ttr")))


def top_tokens(counts: DataFrame, k: int) -> DataFrame:
    return top_k(counts, [F.desc("n"), F.asc("token")], k)


def hapax_summary(counts: DataFrame) -> DataFrame:
    """How many tokens occur once, and their percentage of the vocabulary."""
    return counts.agg(F.count("*").alias("types"), F.count_if(F.col("n") == 1).alias("hapax")).select(
        "types", "hapax", percent(F.col("hapax"), F.col("types")).alias("pct")
    )


def hapax_examples(counts: DataFrame, k: int = 15) -> DataFrame:
    """The alphabetically first tokens that occur once."""
    return top_k(counts.where(F.col("n") == 1).select("token"), [F.asc("token")], k)


def length_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(length, rows): how many documents have each number of tokens."""
    return df.groupBy(F.size(tokens).alias("length")).agg(F.count("*").alias("rows"))
