"""Samples and sentiment of the documents."""

from pyspark.sql import functions as F

from casewise.operators import metrics, patterns, sentiment
from casewise.operators.features import in_train, sample_n
from casewise.operators.lookup import attach_predictions
from casewise.plans.registry import REGISTRY
from casewise.sources import bindings
from casewise.sources.readers import literal_table, table

# The test texts are invented words, so the lists are frequent words of two of their languages.
SEVERITY = ["der", "the", "ist", "ing"]
RELIEF = ["de", "la", "que", "eau"]
SAMPLE = 300


def _rule_sql(text: str) -> str:
    def present(words):
        return " + ".join(f"contains(lower({text}), '{w}')::int" for w in words)

    severe, mild = present(SEVERITY), present(RELIEF)
    return f"case when {severe} > {mild} then 'NEG' when {mild} > {severe} then 'POS' else 'NEU' end"


RULED = f"with ruled as (select doc_id, lang, {_rule_sql('text')} as sentiment, 1.0::double as score from documents)"
DRAW = "('0x' || substr(md5('42:' || doc_id), 1, 8))::bigint % 100"
SAMPLED = f"sampled as (select doc_id, lang from documents order by md5('42:' || doc_id), doc_id limit {SAMPLE})"


def _ruled(spark, sf_dir):
    docs = bindings.documents(spark, sf_dir).select("doc_id", "lang", "text")
    return sentiment.score_by_rule(docs, "text", SEVERITY, RELIEF).drop("text")


@REGISTRY.add("rule_sentiment", f"{RULED} select doc_id, sentiment, score from ruled")
def rule_sentiment_of_documents(spark, sf_dir):
    return _ruled(spark, sf_dir).drop("lang")


@REGISTRY.add("batch_score", f"{RULED} select doc_id, sentiment, score from ruled")
def batch_score(spark, sf_dir):
    load = sentiment.rule_scorer(SEVERITY, RELIEF)
    return sentiment.score_batches(bindings.documents(spark, sf_dir, heavy=True), "doc_id", "text", load)


@REGISTRY.add("lexicon_sentiment", f"{RULED} select doc_id, sentiment from ruled")
def lexicon_sentiment_of_documents(spark, sf_dir):
    """The rule by one pass over each text, whatever the lists."""
    docs = bindings.documents(spark, sf_dir).select("doc_id", "text")
    return patterns.lexicon_sentiment(docs, "text", SEVERITY, RELIEF).select("doc_id", "sentiment")


@REGISTRY.add(
    "many_patterns",
    """with named as (
  select p_partkey, p_name || ' of size ' || p_size as label, p_name || ' of size ' || p_size || p_size % 7 || ', ' || p_brand as line from part),
listed as (select distinct label from named),
hits as (select line, count(*)::int as n_found, min(listed.label) as first_found, max(listed.label) as last_found
  from (select distinct line from named) join listed on contains(line, listed.label) group by line)
select p_partkey, coalesce(n_found, 0) as n_found, first_found, last_found from named left join hits using (line)""",
)
def many_patterns(spark, sf_dir):
    """All labels of parts, some thousands, in every part's line."""
    part = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    label = F.concat("p_name", F.lit(" of size "), size)
    line = F.concat(label, (F.col("p_size") % 7).cast("string"), F.lit(", "), "p_brand")
    listed = patterns.word_list(part.select(label.alias("label")), "label")
    found = patterns.patterns_found(part.select("p_partkey", line.alias("line")), "line", listed)
    names = literal_table(spark, list(enumerate(listed)), "number int, label string")
    hits = found.select("p_partkey", F.explode_outer("found").alias("number")).join(names, "number", "left")
    return hits.groupBy("p_partkey").agg(
        F.count("label").cast("int").alias("n_found"), F.min("label").alias("first_found"), F.max("label").alias("last_found")
    )


@REGISTRY.add("sample_n", f"with {SAMPLED} select * from sampled")
def sample_of_documents(spark, sf_dir):
    return sample_n(bindings.documents(spark, sf_dir).select("doc_id", "lang"), "doc_id", SAMPLE)


@REGISTRY.add(
    "attach_predictions",
    f"{RULED}, {SAMPLED} select doc_id, s.lang, sentiment from sampled s left join ruled using (doc_id)",
)
def attach_predictions_to_sample(spark, sf_dir):
    scored = _ruled(spark, sf_dir).select("doc_id", "sentiment")
    return attach_predictions(sample_of_documents(spark, sf_dir), scored, "doc_id")


@REGISTRY.add(
    "contingency",
    f"""{RULED} select lang, count(*) filter (sentiment = 'NEG') as "NEG", count(*) filter (sentiment = 'NEU') as "NEU",
       count(*) filter (sentiment = 'POS') as "POS" from ruled group by lang""",
)
def contingency(spark, sf_dir):
    return metrics.contingency(_ruled(spark, sf_dir), "lang", "sentiment", ["NEG", "NEU", "POS"]).drop("other")


@REGISTRY.add(
    "contingency_unlisted",
    f"""{RULED} select lang, count(*) filter (sentiment = 'NEG') as "NEG", count(*) filter (sentiment <> 'NEG') as other
from ruled group by lang""",
)
def contingency_unlisted(spark, sf_dir):
    """Sentiments that are not listed are among the others."""
    return metrics.contingency(_ruled(spark, sf_dir), "lang", "sentiment", ["NEG"])


@REGISTRY.add(
    "sentiment_distribution",
    f"{RULED} select sentiment, count(*) as n, round(count(*) * 100.0::double / sum(count(*)) over (), 6) as pct from ruled group by sentiment",
)
def sentiment_distribution(spark, sf_dir):
    return sentiment.sentiment_distribution(_ruled(spark, sf_dir)).withColumn("pct", F.round("pct", 6))


@REGISTRY.add(
    "score_phrases",
    f"select item_id, {_rule_sql('text')} as sentiment, 1.0::double as score from benchmark",
)
def score_phrases(spark, sf_dir):
    phrases = table(spark, sf_dir, "benchmark")
    return sentiment.score_phrases(phrases, "text", SEVERITY, RELIEF).drop("text")


@REGISTRY.add(
    "priority_queue",
    f"{RULED} select doc_id, lang, sentiment, score from ruled where sentiment = 'NEG' order by score desc, doc_id limit 20",
)
def priority_queue(spark, sf_dir):
    return sentiment.urgent_first(_ruled(spark, sf_dir), "doc_id", 20)


@REGISTRY.add(
    "split_train_test",
    f"""select {DRAW} < 80 as train, count(*) as n, min(doc_id) as first_doc, max(doc_id) as last_doc,
       sum(n_chars)::bigint as chars from documents group by 1""",
)
def split_train_test(spark, sf_dir):
    split = bindings.documents(spark, sf_dir).withColumn("train", in_train("doc_id"))
    return split.groupBy("train").agg(
        F.count("*").alias("n"),
        F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("last_doc"),
        F.sum("n_chars").alias("chars"),
    )
