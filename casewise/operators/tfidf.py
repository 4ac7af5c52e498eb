"""Term vectors and TF-IDF.

A document's terms are counted inside its own row, so no (document, term) pair is shuffled. Only
the vocabulary, cut at its ``size`` parameter, is held on the driver and sent to the tasks.
"""

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casewise.operators.totals import top_k, top_k_per_group
from casewise.sources.readers import literal_table


@dataclass(frozen=True)
class Vocabulary:
    """Terms by falling count, ties alphabetical, with counts and document frequencies."""

    documents: int
    terms: list[str]
    counts: list[int]
    frequencies: list[int]

    @property
    def weights(self) -> list[float]:
        """Inverse document frequency of every term."""
        return [math.log((self.documents + 1) / (df + 1)) for df in self.frequencies]

    def table(self, spark: SparkSession) -> DataFrame:
        """(idx, term, n, df, idf): one row per term, at most ``size`` rows."""
        rows = list(zip(range(len(self.terms)), self.terms, self.counts, self.frequencies, self.weights))
        return literal_table(spark, rows, "idx int, term string, n long, df long, idf double")


def term_statistics(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(term, n, df): total count and document frequency of every term, from one pass.

    In a document's sorted tokens, one unlike the token before it is the first of its term. Rows of (token, token before)
    are compared as columns, as a function over the elements of an array is not compiled. A null is no token.
    """
    ordered = df.select(F.sort_array(tokens).alias("sorted"))
    before = F.concat(F.array(F.lit(None).cast("string")), "sorted")
    pairs = ordered.select(F.inline(F.arrays_zip(F.col("sorted").alias("term"), before.alias("before")))).where(F.col("term").isNotNull())
    first = ~F.col("term").eqNullSafe(F.col("before"))
    return pairs.groupBy("term").agg(F.count("*").alias("n"), F.count_if(first).alias("df"))


def eligible_terms(
    df: DataFrame, documents: int | Column, tokens: str = "tokens", min_df: int = 2, max_df: float = 0.9, size: int = 3000
) -> DataFrame:
    """The ``size`` most frequent terms in at least ``min_df`` documents and at most ``max_df`` of them."""
    usual = (F.col("df") >= min_df) & (F.col("df") <= max_df * documents)
    return top_k(term_statistics(df, tokens).where(usual), [F.desc("n"), F.asc("term")], size)


def fit_vocabulary(
    df: DataFrame, tokens: str = "tokens", min_df: int = 2, max_df: float = 0.9, size: int = 3000
) -> Vocabulary:
    documents = df.count()
    rows = eligible_terms(df, documents, tokens, min_df, max_df, size).collect()
    return Vocabulary(documents, [r["term"] for r in rows], [r["n"] for r in rows], [r["df"] for r in rows])


def weighed(df: DataFrame, vocabulary: Vocabulary, counts: str = "tf", output: str = "features") -> DataFrame:
    """Term counts times the vocabulary's weights."""
    scaling = Vectors.dense(vocabulary.weights)
    return ElementwiseProduct(scalingVec=scaling, inputCol=counts, outputCol=output).transform(df)


def term_vectors(df: DataFrame, vocabulary: Vocabulary, tokens: str = "tokens", output: str = "tf") -> DataFrame:
    """Sparse term counts of every document."""
    if not vocabulary.terms:
        raise ValueError("the vocabulary is empty")
    model = CountVectorizerModel.from_vocabulary(vocabulary.terms, inputCol=tokens, outputCol=output)
    return model.transform(df)


def document_terms(df: DataFrame, keys: Sequence[str], vocabulary: Vocabulary, tokens: str = "tokens") -> DataFrame:
    """(keys, idx, tf): one row per document and vocabulary term in it."""
    sparse = F.unwrap_udt("tf")
    pairs = F.arrays_zip(sparse["indices"].alias("idx"), sparse["values"].alias("tf"))
    return (
        term_vectors(df.select(*keys, tokens), vocabulary, tokens)
        .select(*keys, F.explode(pairs).alias("pair"))
        .select(*keys, "pair.idx", F.col("pair.tf").cast("long").alias("tf"))
    )


def tfidf(df: DataFrame, keys: Sequence[str], vocabulary: Vocabulary, tokens: str = "tokens") -> DataFrame:
    """(keys, term, tf, tfidf) for every document. The vocabulary's size is bounded, so it is broadcast."""
    weights = F.broadcast(vocabulary.table(df.sparkSession).select("idx", "term", "idf"))
    return document_terms(df, keys, vocabulary, tokens).join(weights, "idx").select(
        *keys, "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf")
    )


def top_terms_per_document(
    df: DataFrame, key: str, vocabulary: Vocabulary, k: int, tokens: str = "tokens"
) -> DataFrame:
    """The ``k`` heaviest terms of every document, ranked inside the document's own row.

    Terms of equal weight go in vocabulary order.
    """
    weights_of = weighed(term_vectors(df.select(key, tokens), vocabulary, tokens), vocabulary, output="tfidf")
    counts, weights = F.unwrap_udt("tf"), F.unwrap_udt("tfidf")
    terms = F.arrays_zip(
        (F.transform(weights["values"], lambda w: -w)).alias("order"),
        counts["indices"].alias("idx"),
        counts["values"].alias("tf"),
    )
    names = F.broadcast(vocabulary.table(df.sparkSession).select("idx", "term"))
    return (
        weights_of.select(key, F.posexplode(F.slice(F.array_sort(terms), 1, k)).alias("place", "item"))
        .select(key, "place", "item.*")
        .join(names, "idx")
        .select(
            key,
            (F.col("place") + 1).alias("rank"),
            "term",
            F.col("tf").cast("long").alias("tf"),
            (-F.col("order")).alias("tfidf"),
        )
    )


def mean_tfidf_by_category(
    df: DataFrame, category: str, vocabulary: Vocabulary, min_documents: int = 1, tokens: str = "tokens"
) -> DataFrame:
    """(category, documents, term, mean_tfidf) in each category of at least ``min_documents`` documents.

    The mean is over all documents of the category, with or without the term; a term that is in
    none of them is not listed. Term counts are whole numbers and the weight of a term is the same
    everywhere, so counts are summed and weighted once, and each task sums before the shuffle.
    """
    sizes = df.groupBy(category).agg(F.count("*").alias("documents")).where(F.col("documents") >= min_documents)
    counted = document_terms(df, [category], vocabulary, tokens).groupBy(category, "idx").agg(F.sum("tf").alias("tf"))
    weights = F.broadcast(vocabulary.table(df.sparkSession).select("idx", "term", "idf"))
    mean = F.col("tf") * F.col("idf") / F.col("documents")
    return counted.join(weights, "idx").join(sizes, category).select(
        category, "documents", "term", mean.alias("mean_tfidf")
    )


def top_terms_by_category(
    df: DataFrame, category: str, vocabulary: Vocabulary, k: int = 6, min_documents: int = 3, tokens: str = "tokens"
) -> DataFrame:
    """The ``k`` terms with the largest mean TF-IDF in each category that is large enough.

    Means that are equal to nine places go by term.
    """
    means = mean_tfidf_by_category(df, category, vocabulary, min_documents, tokens)
    return top_k_per_group(means, [category], [F.round("mean_tfidf", 9).desc(), F.asc("term")], k)


def tf_against_tfidf(vocabulary: Vocabulary, spark: SparkSession, k: int = 10) -> DataFrame:
    """The ``k`` terms with the largest mean count and the ``k`` with the largest mean TF-IDF."""
    per_document = F.col("n") / F.lit(float(max(vocabulary.documents, 1)))
    means = vocabulary.table(spark).select(
        "term",
        F.inline(
            F.array(
                F.struct(F.lit("tf").alias("measure"), per_document.alias("mean")),
                F.struct(F.lit("tfidf").alias("measure"), (per_document * F.col("idf")).alias("mean")),
            )
        ),
    )
    return top_k_per_group(means, ["measure"], [F.round("mean", 9).desc(), F.asc("term")], k)
