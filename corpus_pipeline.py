"""A training corpus from raw documents: the dealt operators as stages over whole tables.

Each stage reads what its predecessor wrote and works on all of it. The stages keep the columns of
the documents, whatever they are, and the last one gives token ids. Null texts and rows are handled as the
operators say; an empty table passes through all stages.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewise.llm.bpe import code_texts
from casewise.llm.frames import n_words
from casewise.llm.line_runs import drop_repeated_runs
from casewise.llm.mixing import mix_sources
from casewise.llm.near_dup import drop_near_duplicates
from casewise.llm.quality import quality_verdicts
from casewise.llm.queries import QUERIES, WEIGHTS, vocabulary_file
from casewise.sources.storage import fresh_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_verdicts(docs).where("kept").select("row.*")


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; one that was nothing but copies goes.

    ``n_chars`` follows the new text.
    """
    found = drop_repeated_runs(docs, "doc_id", "text")
    left = found.where((F.col("n_removed") == 0) | (n_words("kept_text") > 0))
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return left.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs, "doc_id", "text")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that sources meet their target weights.

    A document is taken as a whole 0, 1 or 2 times. Rows equal in id, text and source share one decision.
    """
    rows = docs.select(
        F.struct("*").alias("row"),
        F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_hash")).alias("key"),
        "source",
        n_words("text").alias("size"),
    )
    taken = mix_sources(rows.select("key", "source", "size"), WEIGHTS, (3, 2), max_epochs=2, seed="pipeline", whole=True)
    copies = taken.groupBy("key", "source").agg(
        F.expr("sum(repeats + if(extra > 0, 1, 0)) div count(*)").cast("int").alias("copies")
    )
    decided = copies.select(
        F.col("key.doc_id").alias("id"), F.col("key.text_hash").alias("text_hash"), F.col("source").alias("of"), "copies"
    ).where("copies > 0")
    same = (
        F.col("key.doc_id").eqNullSafe(F.col("id"))
        & (F.col("key.text_hash") == F.col("text_hash"))
        & F.col("source").eqNullSafe(F.col("of"))
    )
    return rows.join(decided, same).select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the SHA-256 of what they decode to."""
    coded = code_texts(docs, "text", vocabulary_file(), ("ids", "n_tokens", "decoded_sha256"))
    kept = [F.col("row").getField(c).alias(c) for c in ("doc_id", "lang", "source")]
    return coded.select(*kept, "n_tokens", "ids", "decoded_sha256")


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_repeats),
    ("near duplicates", keep_one_of_each),
    ("mixing", mix),
    ("byte-pair codec", encode),
]
# Byte-pair merging is not for SQL; the tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


@QUERIES.add("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        path = fresh_path(spark, "corpus")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
