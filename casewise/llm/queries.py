"""The dealt operators bound to the shared tables, each with its SQL twin where SQL can say it."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from casewise.llm import sql
from casewise.llm.bit_sliced import quantised, top_k_search
from casewise.llm.bpe import code_texts
from casewise.llm.chunk_dedup import exact_duplicates
from casewise.llm.frames import n_words
from casewise.llm.html_text import extract_text
from casewise.llm.line_runs import drop_repeated_runs
from casewise.llm.merkle import verified_rows
from casewise.llm.mixing import mix_sources
from casewise.llm.near_dup import near_duplicates
from casewise.llm.phrase_index import collocations
from casewise.llm.quality import quality_verdicts
from casewise.llm.shard_shuffle import shuffle_into_shards
from casewise.llm.url_glob import Rule, judge_urls
from casewise.llm.warc import archive_and_read
from casewise.plans.registry import Registry
from casewise.sources.readers import table

QUERIES = Registry()

VOCABULARY = "word_bpe_49k.json"
SHARDS = 24
WEIGHTS = (3, 1, 2)
# The rules of the url query.
URL_RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


def vocabulary_file(path: str | None = None) -> str:
    """The content of the vocabulary, from ``path`` or where the package of public vocabularies keeps it."""
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        return file.read()


@QUERIES.add("op2_shuffle_shards")
def shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards by a Feistel shuffle of their global row numbers."""
    utf8 = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    named = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(utf8) + 8).cast("long").alias("size"), F.crc32(utf8).alias("text_crc32")
    )
    return shuffle_into_shards(named, SHARDS, seed=20).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@QUERIES.add("op3_mix_sources", sql.MIX)
def mix_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 3, 1, 2, ... and 150% of all words."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.col("doc_id").alias("key"), "source", n_words("text").alias("size"))
    mixed = mix_sources(rows, WEIGHTS, (3, 2), max_epochs=2, seed="mix")
    return mixed.select(
        F.col("key").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("repeats") * F.col("size") + F.col("extra")).alias("taken"),
    )


@QUERIES.add("op7_url_globs", sql.URLS)
def url_globs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url against the glob rules."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, "url", URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@QUERIES.add("op9_quality_divergence", sql.QUALITY)
def quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the divergence verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_verdicts(docs, keep=["doc_id", "lang"]).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@QUERIES.add("op10_near_duplicates", sql.NEAR_DUPLICATES)
def near_duplicate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("key").alias("doc_id"), "n_shingles", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept")
    )


@QUERIES.add("op1_top_k_search", sql.TOP_K)
def top_k_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors for every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), quantised("embedding", 64).alias("vector"))
    return top_k_search(vectors, vectors.where("id % 20 = 0"), 20)


@QUERIES.add("op5_line_runs", sql.LINE_RUNS)
def line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later copies of repeated line runs."""
    found = drop_repeated_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("kept_text").alias("text"),
        "n_removed",
        F.array_join(F.transform("runs", lambda r: F.concat(r["first"].cast("string"), F.lit("-"), r["last"].cast("string"))), ",").alias("runs"),
    )


@QUERIES.add("op6_bpe_round_trip")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    outputs = ("n_tokens", "ids_sha256", "decoded_sha256")
    return code_texts(docs, "text", vocabulary_file(), outputs).select(F.col("row.doc_id").alias("doc_id"), *outputs)


@QUERIES.add("op8_warc_round_trip", sql.ARCHIVES)
def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = archive_and_read(pages, "page_id", "url", "html")
    return found.select(
        F.col("page").try_cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").try_cast("long").alias("refers_to"),
    )


@QUERIES.add("op4_main_text")
def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract_text(pages, "html")
    return found.select(F.col("row.page_id").alias("page_id"), F.col("row.url").alias("url"), "text", "n_chars")


@QUERIES.add("op12_merkle_manifest", sql.MERKLE)
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, and the root it leads to with its line breaks deleted in about half of the documents."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    changed = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    found = verified_rows(docs, "doc_id", "source", ["doc_id", "source", "lang", "n_chars", "text"], changed, tampered)
    return found.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.col("proof").alias("proof_sha256"),
        F.col("version_root").alias("folded_root"),
        "verified",
    )


@QUERIES.add("op13_exact_copies", sql.COPIES)
def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of equal texts that stays."""
    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("key").alias("doc_id"), F.col("keep_key").alias("keep_id"), "group_size", "kept", F.col("digest").alias("text_sha256")
    )


@QUERIES.add("op11_phrase_collocations", sql.PHRASES)
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of two to five words of every language."""
    found = collocations(table(spark, sf_dir, "documents").select("text", "lang"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
