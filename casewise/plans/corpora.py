"""Tokens, vocabulary and TF-IDF of the documents."""

from pyspark.sql import functions as F

from casewise.functions.domain import STOP_WORDS_ES
from casewise.functions.text import tokens
from casewise.operators import corpus, heavy, profile, tfidf
from casewise.plans import views
from casewise.plans.registry import REGISTRY
from casewise.sources import bindings

VOCABULARY = 3000
TOKS = f"with {views.tokens(STOP_WORDS_ES)}"
COUNTS = f"""{TOKS}, counts as (
  select token, count(*) as n from (select unnest(tokens) as token from toks) group by token)"""
VOCAB = f"""{TOKS}, words as (select doc_id, lang, unnest(tokens) as term from toks),
docs as (select count(*) as total from documents),
tfs as (select doc_id, lang, term, count(*) as tf from words group by all),
vocab as (
  select term, sum(tf)::bigint as n, count(*) as df, ln((max(total) + 1)::double / (count(*) + 1)) as idf
  from tfs, docs group by term having count(*) >= 2 and count(*) <= 0.9::double * max(total)
  order by n desc, term limit {VOCABULARY}),
placed as (select *, row_number() over (order by n desc, term) as place from vocab)"""


def _tokenised(spark, sf_dir, stop_words=STOP_WORDS_ES):
    return bindings.documents(spark, sf_dir, heavy=True).select(
        "doc_id", "lang", tokens("text", stop_words=stop_words).alias("tokens")
    )


def _counts(spark, sf_dir):
    return corpus.token_counts(_tokenised(spark, sf_dir))


def _vocabulary(df):
    return tfidf.fit_vocabulary(df, size=VOCABULARY)


def _digested(df):
    return df.select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("digest")
    )


DIGEST_SQL = """select doc_id, len(tokens)::int as n_tokens, md5(array_to_string(tokens, ' ')) as digest from toks"""


@REGISTRY.add("tokenize", f"with {views.tokens()} {DIGEST_SQL}")
def tokenize(spark, sf_dir):
    return _digested(_tokenised(spark, sf_dir, stop_words=()))


@REGISTRY.add("remove_stopwords", f"{TOKS} {DIGEST_SQL}")
def remove_stopwords(spark, sf_dir):
    return _digested(_tokenised(spark, sf_dir))


@REGISTRY.add(
    "corpus_stats",
    f"""{TOKS} select count(*) as documents, sum(len(tokens))::bigint as tokens, round(avg(len(tokens)), 6) as mean_tokens,
       min(len(tokens))::int as min_tokens, max(len(tokens))::int as max_tokens from toks""",
)
def corpus_stats(spark, sf_dir):
    return corpus.corpus_stats(_tokenised(spark, sf_dir)).withColumn("mean_tokens", F.round("mean_tokens", 6))


@REGISTRY.add(
    "ttr",
    f"""{COUNTS}, found as (select count(*) as types, sum(n)::bigint as tokens, count(*)::double / sum(n) as ttr from counts)
select types, tokens, round(ttr, 9) as ttr,
       case when ttr > 0.5 then 'alta' when ttr > 0.3 then 'moderada' else 'baja' end as richness from found""",
)
def ttr(spark, sf_dir):
    return corpus.type_token_ratio(_counts(spark, sf_dir)).withColumn("ttr", F.round("ttr", 9))


@REGISTRY.add("heavy_hitters", f"{COUNTS} select token, n from counts order by n desc, token limit 25")
def heavy_hitters(spark, sf_dir):
    """The same tokens from summaries of bounded size."""
    return heavy.heavy_hitters(_tokenised(spark, sf_dir), "tokens", 25)


@REGISTRY.add("top_tokens", f"{COUNTS} select token, n from counts order by n desc, token limit 25")
def top_tokens(spark, sf_dir):
    return corpus.top_tokens(_counts(spark, sf_dir), 25)


@REGISTRY.add(
    "hapax",
    f"""{COUNTS} select count(*) as types, count(*) filter (n = 1) as hapax,
       round(count(*) filter (n = 1) * 100.0::double / count(*), 6) as pct from counts""",
)
def hapax(spark, sf_dir):
    return corpus.hapax_summary(_counts(spark, sf_dir)).withColumn("pct", F.round("pct", 6))


@REGISTRY.add("hapax_examples", f"{COUNTS} select token from counts where n = 1 order by token limit 15")
def hapax_examples(spark, sf_dir):
    return corpus.hapax_examples(_counts(spark, sf_dir))


@REGISTRY.add(
    "token_histogram",
    f"""{TOKS}, sizes as (select len(tokens) as length from toks),
edges as (select min(length) as low, max(length) as high from sizes),
placed as (select length, coalesce(least(floor((length - low) * 30.0::double / nullif(high - low, 0)), 29), 0)::int as bin
  from sizes, edges)
select bin, count(*) as rows, min(length)::int as smallest, max(length)::int as largest from placed group by bin""",
)
def token_histogram(spark, sf_dir):
    return profile.histogram(corpus.length_counts(_tokenised(spark, sf_dir)), "length", "rows", 30)


@REGISTRY.add("count_vectorize", f"{VOCAB} select term, n, df from vocab")
def count_vectorize(spark, sf_dir):
    docs = _tokenised(spark, sf_dir)
    return tfidf.eligible_terms(docs, docs.agg(F.count("*")).scalar(), size=VOCABULARY)


@REGISTRY.add("idf_weights", f"{VOCAB} select term, df, round(idf, 6) as idf from vocab")
def idf_weights(spark, sf_dir):
    weights = _vocabulary(_tokenised(spark, sf_dir)).table(spark)
    return weights.select("term", "df", F.round("idf", 6).alias("idf"))


@REGISTRY.add(
    "tfidf",
    f"""{VOCAB}, weighed as (select doc_id, term, tf, tf * idf as tfidf, place from tfs join placed using (term)),
ranked as (select *, row_number() over (partition by doc_id order by tfidf desc, place)::int as rank from weighed)
select doc_id, rank, term, tf, round(tfidf, 6) as tfidf from ranked where rank <= 3""",
)
def tfidf_top_per_document(spark, sf_dir):
    docs = _tokenised(spark, sf_dir)
    top = tfidf.top_terms_per_document(docs, "doc_id", _vocabulary(docs), 3)
    return top.withColumn("tfidf", F.round("tfidf", 6))


@REGISTRY.add(
    "tfidf_by_term",
    f"""{VOCAB} select term, count(*) as documents, sum(tf)::bigint as tf, round(max(tf * idf), 6) as largest
from tfs join vocab using (term) group by term""",
)
def tfidf_by_term(spark, sf_dir):
    docs = _tokenised(spark, sf_dir)
    weighed = tfidf.tfidf(docs, ["doc_id"], _vocabulary(docs))
    return weighed.groupBy("term").agg(
        F.count("*").alias("documents"), F.sum("tf").alias("tf"), F.round(F.max("tfidf"), 6).alias("largest")
    )


@REGISTRY.add(
    "tfidf_mean_by_category",
    f"""{VOCAB}, sizes as (select lang, count(*) as documents from documents group by lang)
select lang, documents, term, round(sum(tf) * max(idf) / documents, 6) as mean_tfidf
from tfs join vocab using (term) join sizes using (lang) group by lang, documents, term""",
)
def tfidf_mean_by_category(spark, sf_dir):
    docs = _tokenised(spark, sf_dir)
    means = tfidf.mean_tfidf_by_category(docs, "lang", _vocabulary(docs))
    return means.withColumn("mean_tfidf", F.round("mean_tfidf", 6))


@REGISTRY.add(
    "tfidf_top_by_category",
    f"""{VOCAB}, sizes as (select lang, count(*) as documents from documents group by lang having count(*) >= 3),
means as (select lang, documents, term, sum(tf) * max(idf) / documents as mean
  from tfs join vocab using (term) join sizes using (lang) group by lang, documents, term),
ranked as (select *, row_number() over (partition by lang order by round(mean, 9) desc, term)::int as rank from means)
select lang, documents, term, round(mean, 6) as mean_tfidf, rank from ranked where rank <= 6""",
)
def tfidf_top_by_category(spark, sf_dir):
    docs = _tokenised(spark, sf_dir)
    top = tfidf.top_terms_by_category(docs, "lang", _vocabulary(docs))
    return top.withColumn("mean_tfidf", F.round("mean_tfidf", 6))


@REGISTRY.add(
    "tf_vs_tfidf",
    f"""{VOCAB}, means as (
  select 'tf' as measure, term, n::double / total as mean from vocab, docs
  union all select 'tfidf', term, n::double / total * idf from vocab, docs),
ranked as (select *, row_number() over (partition by measure order by round(mean, 9) desc, term)::int as rank from means)
select measure, term, round(mean, 6) as mean, rank from ranked where rank <= 10""",
)
def tf_vs_tfidf(spark, sf_dir):
    ranked = tfidf.tf_against_tfidf(_vocabulary(_tokenised(spark, sf_dir)), spark)
    return ranked.withColumn("mean", F.round("mean", 6))
