"""The shared test tables seen as notifications, corpora, vectors and predictions."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewise.functions.text import tokens
from casewise.sources.readers import clean_notifications, spread, table


def raw_notifications(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """Sales lines rendered as dirty notification text, spread out for ``heavy`` work per row.

    Text is rendered on the dimension side before the join, so it is done once per part and
    supplier. The join carries no hint: Spark broadcasts a dimension below its size threshold
    and otherwise sort-merges, where adaptive execution splits partitions of hot keys.
    """
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.regexp_extract("p_brand", "([0-9]+)", 1).alias("COD_EVE"),
        F.col("p_brand").alias("Nombre"),
    )
    nation = F.col("s_nationkey")
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"),
        nation.cast("string").alias("COD_DPTO_O"),
        F.when(nation == 0, "  ").otherwise(F.concat(F.lit(" "), "s_name", F.lit(" "))).alias("nom_mun"),
    )
    year = F.year("l_shipdate").cast("string")
    lines = table(spark, sf_dir, "lineitem")
    return (
        (spread(lines, "l_orderkey", "l_linenumber") if heavy else lines)
        .join(part, "l_partkey")
        .join(supplier, "l_suppkey")
        .select(
            "COD_EVE",
            "Nombre",
            F.concat(F.substring(year, 1, 1), F.lit("."), F.substring(year, 2, 3)).alias("ANO"),
            F.weekofyear("l_shipdate").cast("string").alias("SEMANA"),
            "COD_DPTO_O",
            F.col("l_suppkey").cast("string").alias("COD_MUN_O"),
            "nom_mun",
            F.col("l_quantity").cast("int").cast("string").alias("conteo_casos"),
        )
    )


def notifications(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    return clean_notifications(raw_notifications(spark, sf_dir, heavy))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def documents(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spread(docs, "doc_id") if heavy else docs


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def document_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric description of every document, with its language."""
    letters = F.length("text")
    non_ascii = F.regexp_count("text", F.lit("[^\\x00-\\x7F]"))
    return documents(spark, sf_dir, heavy=True).select(
        "doc_id",
        "lang",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(tokens("text", 1)).cast("double").alias("n_tokens"),
        F.coalesce(F.try_divide(non_ascii.cast("double"), letters), F.lit(0.0)).alias("non_ascii_share"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines as scored predictions: return flag against line number."""
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2).alias("label"),
        (F.col("l_linenumber") % 3).alias("prediction"),
        F.col("l_quantity").alias("score"),
    )
