"""Quality rules: base counts, and divergence of a text's histograms from those of its language.

Two histograms describe a text: characters by class, and common function words against all others.
The references are the same histograms summed over all typical texts of each language. A text
whose Jensen-Shannon distances to the nearest references, of both histograms together, are too large
does not look like running text. A text of a named language without a reference is not compared with those of
others, whose words, letters and case it need not share; one of no named language is. Texts with fewer words than
the guard are not compared, as their histograms say nothing yet. Everything is DataFrame expressions; a text is never exploded or shuffled, and only the
sums per language, one short row each, leave a task.
"""

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from casewise.llm.frames import n_words
from casewise.sources.storage import staged

# Common function words of the languages that have a reference.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por"],
}
# Character classes in the order in which they are taken out of the words of a text.
CLASSES = [
    ("lower", "\\p{Ll}+"),
    ("upper", "\\p{Lu}+"),
    ("stops", "[.,;:]+"),
    ("symbols", "[#*$%&|<>]+"),
    ("digits", "\\p{Nd}+"),
    ("marks", "[!?]+"),
]
WHITE = "[\\x20\\x09-\\x0D]+"


class Rules(NamedTuple):
    """Limits of the verdict; the distance of a text is the sum of its two distances.

    The histograms of a text of fewer than ``short_words`` words are rough, so it may lie further off.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    max_distance: float = 0.40
    short_words: int = 100
    max_short_distance: float = 0.50


def word_bins(words: Mapping[str, Sequence[str]] = COMMON_WORDS) -> list[str]:
    return sorted({word for listed in words.values() for word in listed})


def with_histograms(df: DataFrame, text: str, words: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(row, t, word_chars, n_symbols, class_counts, found): what the histograms are made of, and the text itself."""
    longer = f"\\p{{L}}{{{max(map(len, words)) + 1},}}"
    kept = F.struct(*[F.col(f"`{c}`") for c in keep])
    step = df.select(kept.alias("row"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    step = step.withColumn("left0", F.regexp_replace("t", WHITE, ""))
    for number, (_, pattern) in enumerate(CLASSES):
        step = step.withColumn(f"left{number + 1}", F.regexp_replace(f"left{number}", pattern, ""))
    taken = [F.length(f"left{i}") - F.length(f"left{i + 1}") for i in range(len(CLASSES))]
    step = step.select(
        "row",
        "t",
        F.length("left0").cast("long").alias("word_chars"),
        taken[3].cast("long").alias("n_symbols"),
        F.array(*taken, F.length(f"left{len(CLASSES)}")).alias("class_counts"),
        # only words short enough to be listed, each between two spaces
        F.concat(
            F.lit(" "), F.regexp_replace(F.regexp_replace(F.lower("t"), longer, ""), "[^\\p{L}]+", "  "), F.lit(" ")
        ).alias("spaced"),
    )
    # in bytes, whose number a string knows: characters would be counted again for every word
    taken = {w: F.octet_length("spaced") - F.octet_length(F.replace("spaced", F.lit(f" {w} "), F.lit(""))) for w in words}
    found = [gone / (len(w.encode()) + 2) for w, gone in taken.items()]
    return step.select("row", "t", "word_chars", "n_symbols", "class_counts", F.array(*[f.cast("int") for f in found]).alias("found"))


def _word_counts() -> Column:
    """The listed words and all others, as one histogram."""
    listed = F.aggregate("found", F.lit(0), lambda a, b: a + b)
    return F.concat("found", F.array(F.greatest(F.lit(0), F.col("n_words").cast("int") - listed)))


def with_shares(df: DataFrame, text: str, words: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(row, n_words, class_counts, word_counts): all that references are made of."""
    step = with_histograms(df, text, words, keep).withColumn("n_words", n_words("t"))
    return step.select("row", "n_words", "class_counts", _word_counts().alias("word_counts"))


def with_features(df: DataFrame, text: str, words: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(row, counts...): the columns to ``keep`` packed as ``row``, the base counts and both histograms.

    Null and empty texts have zero counts. ``n_repeat_words`` counts the words that lie in a window
    of three words found at least twice; windows are compared by a 64-bit hash inside one text.
    """
    step = with_histograms(df, text, words, keep).select(
        "row",
        "word_chars",
        "n_symbols",
        "class_counts",
        "found",
        F.filter(F.split("t", WHITE), lambda w: w != "").alias("words"),
        F.filter(F.split("t", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
    )
    step = step.withColumn("n", F.size("words"))
    triples = F.when(
        F.col("n") >= 3,
        F.transform(
            F.slice("words", 3, F.col("n")), lambda third, i: F.xxhash64(F.get("words", i), F.get("words", i + 1), third)
        ),
    )
    step = step.select(
        "row",
        F.col("n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "class_counts",
        "found",
        triples.alias("triples"),
    )
    some_twice = F.size(F.array_distinct("triples")) < F.size("triples")
    step = step.withColumn(
        "sorted", F.when(some_twice, F.array_sort(F.transform("triples", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    ).drop("triples")
    twice = F.filter(
        "sorted",
        lambda p, j: (F.get("sorted", j - 1)["h"] == p["h"]) | (F.get("sorted", j + 1)["h"] == p["h"]),
    )
    step = step.withColumn("twice", F.array_sort(F.transform(twice, lambda p: p["i"]))).drop("sorted")
    reach = F.transform("twice", lambda i, j: F.least(F.lit(3), F.coalesce(F.get("twice", j + 1) - i, F.lit(3))))
    n_repeat = F.coalesce(F.aggregate(reach, F.lit(0).cast("long"), lambda total, r: total + r), F.lit(0))
    return step.select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        n_repeat.cast("long").alias("n_repeat_words"),
        "class_counts",
        _word_counts().alias("word_counts"),
    )


def base_failed(rules: Rules) -> Column:
    return (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )


def _sum_histograms(features: DataFrame, counted: Column, bins: int) -> list[tuple]:
    """(class shares, word shares) per value of ``counted``, without null."""
    sums = features.groupBy(counted.alias("language")).agg(
        *[F.sum(F.element_at("class_counts", i + 1)).alias(f"c{i}") for i in range(len(CLASSES) + 1)],
        *[F.sum(F.element_at("word_counts", i + 1)).alias(f"w{i}") for i in range(bins + 1)],
    )
    out = []
    for row in sorted(row for row in sums.collect() if row["language"] is not None):
        histograms = [row[f"c{i}"] for i in range(len(CLASSES) + 1)], [row[f"w{i}"] for i in range(bins + 1)]
        out.append(tuple([x / max(1, sum(counts)) for x in counts] for counts in histograms))
    return out


def fit_references(features: DataFrame, language: str, languages: Sequence[str], bins: int, rules: Rules) -> list[tuple]:
    """(class histogram, word histogram) of each listed language, over all long enough texts.

    The histograms are summed twice: over all texts, and then over those that lie near one of the first
    sums, so that junk does not shape what it is compared with. The lists are shares that sum to 1. Rows
    of other or null languages do not count towards any; at most one row per listed language comes back.
    """
    name = F.col("row").getField(language)
    listed = F.when(name.isin(list(languages)) & (F.col("n_words") >= rules.min_words), name)
    first = _sum_histograms(features, listed, bins)
    near = with_distances(features, first, rules, language, languages)
    return _sum_histograms(near, F.when(~_strange(rules), listed), bins) if first else first


def _strange(rules: Rules) -> Column:
    limit = F.when(F.col("n_words") < rules.short_words, rules.max_short_distance).otherwise(rules.max_distance)
    return F.coalesce(F.col("class_distance") + F.col("word_distance") > limit, F.lit(False))


def js_distance(counts: str, reference: Sequence[float]) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of counts, summing to ``_total``, to reference shares; 0 for none."""
    shares = F.array(*[F.lit(float(share)) for share in reference])

    def term(count: Column, share: Column) -> Column:
        p = count / F.col("_total")
        middle = (p + share) / 2
        return F.when(count > 0, p * F.log2(p / middle)).otherwise(0.0) + F.when(
            share > 0, share * F.log2(share / middle)
        ).otherwise(0.0)

    terms = F.aggregate(F.zip_with(counts, shares, term), F.lit(0.0), lambda a, b: a + b)
    return F.when(F.col("_total") > 0, F.sqrt(F.greatest(F.lit(0.0), terms / 2))).otherwise(0.0)


def with_distances(
    features: DataFrame, references: Sequence[tuple], rules: Rules, language: str, languages: Sequence[str]
) -> DataFrame:
    """``features`` with ``class_distance`` and ``word_distance``.

    The distances are those to the nearest reference, and null if there is none, the text is below the
    length guard, or its language is neither null nor listed.
    """
    named = F.col("row").getField(language)
    compared = (F.col("n_words") >= rules.min_words) & (named.isNull() | named.isin(list(languages)))
    for name, counts, which in (("class_distance", "class_counts", 0), ("word_distance", "word_counts", 1)):
        features = features.withColumn("_total", F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b))
        found = [js_distance(counts, reference[which]) for reference in references]
        nearest = F.array_min(F.array(*found)) if found else F.lit(None).cast("double")
        features = features.withColumn(name, F.when(compared, nearest))
    return features.drop("_total")


def judge(
    features: DataFrame, references: Sequence[tuple], rules: Rules, language: str, languages: Sequence[str]
) -> DataFrame:
    """``features`` with ``base_failed``, both distances, and ``kept``. A text without distances is judged by the base rules alone."""
    judged = with_distances(features, references, rules, language, languages).withColumn("base_failed", base_failed(rules))
    # always true, but opaque: else a filter on the verdict would drag copies of all expressions below it
    fence = F.monotonically_increasing_id() >= 0
    return judged.withColumn("kept", ~F.col("base_failed") & ~_strange(rules) & fence)


def quality_verdicts(
    df: DataFrame,
    text: str = "text",
    language: str = "lang",
    keep: Sequence[str] | None = None,
    words: Mapping[str, Sequence[str]] = COMMON_WORDS,
    rules: Rules = Rules(),
) -> DataFrame:
    """Counts, distances and verdict of every row of ``df``, whose columns are packed as ``row``.

    Columns of ``df`` cannot clash with the results. An empty table gives an empty one. ``keep`` names
    the columns of ``df`` that are wanted, with the language. The counts are written to the shared folder for
    the references. If the text is among the columns to keep, only the histograms are, and it is read again for the verdicts.
    """
    bins, keep = word_bins(words), list(df.columns if keep is None else keep)
    again = text in keep
    counted = staged(with_shares(df, text, bins, [language]) if again else with_features(df, text, bins, keep), "features")
    references = fit_references(counted, language, sorted(words), len(bins), rules)
    return judge(with_features(df, text, bins, keep) if again else counted, references, rules, language, sorted(words))
