"""Evaluation of predictions, all from one count of (label, prediction) pairs."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casewise.operators.ordered import range_edges, running_totals
from casewise.operators.totals import top_k


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n) over whole-number classes: the only pass over the predictions."""
    return df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count("*").alias("n"))


def confusion_matrix(
    df: DataFrame, classes: Sequence[int], label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Dense matrix: one row per class and one with a null ``label`` for all others, with zeros filled in.

    Columns are ``pred_<class>`` and ``pred_other``. Null and unlisted labels or predictions are
    among the others, so the cells add up to the number of rows.
    """
    counts = confusion_counts(df, label, prediction)
    listed = list(classes)

    def of(column: str) -> Column:
        return F.when(F.col(column).isin(listed), F.col(column))

    named = counts.select(of("label").alias("label"), of("prediction").alias("prediction"), "n")

    def cell(real: int | None, predicted: int | None) -> Column:
        here = F.col("label").eqNullSafe(F.lit(real)) & F.col("prediction").eqNullSafe(F.lit(predicted))
        return F.coalesce(F.sum(F.when(here, F.col("n"))), F.lit(0))

    sides = [*listed, None]
    cells = [cell(real, predicted).alias(f"{i}:{j}") for i, real in enumerate(sides) for j, predicted in enumerate(sides)]
    names = [f"pred_{c}" for c in listed] + ["pred_other"]
    rows = [
        F.struct(F.lit(real).cast("int").alias("label"), *[F.col(f"`{i}:{j}`").alias(n) for j, n in enumerate(names)])
        for i, real in enumerate(sides)
    ]
    return named.agg(*cells).select(F.inline(F.array(*rows)))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, as one row.

    A class that is never predicted has precision 0; a class without rows has no weight.
    """
    counts = confusion_counts(df, label, prediction)
    none = F.lit(0).cast("long")
    hits = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    of_label = F.struct(F.col("label").alias("class"), F.col("n").alias("support"), none.alias("called"), hits.alias("hits"))
    of_call = F.struct(F.col("prediction").alias("class"), none.alias("support"), F.col("n").alias("called"), none.alias("hits"))
    per_class = (
        counts.select(F.inline(F.array(of_label, of_call)))
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("hits").alias("hits"))
    )
    weight = F.col("support")
    precision = F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("called")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("hits").cast("double"), weight), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2.0 * precision * recall, precision + recall), F.lit(0.0))

    def weighted(measure: Column) -> Column:
        return F.try_divide(F.sum(measure * weight), F.sum(weight))

    return per_class.agg(
        F.try_divide(F.sum("hits").cast("double"), F.sum(weight)).alias("accuracy"),
        weighted(f1).alias("f1"),
        weighted(precision).alias("weighted_precision"),
        weighted(recall).alias("weighted_recall"),
    )


def top_confusions(df: DataFrame, k: int = 3, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The most frequent wrong (label, prediction) pairs; among equals the higher classes first."""
    wrong = confusion_counts(df, label, prediction).where(F.col("label") != F.col("prediction"))
    return top_k(wrong, [F.desc("n"), F.desc("label"), F.desc("prediction")], k)


def auc_one_vs_rest(df: DataFrame, scores: Mapping[int, str | None], label: str = "label") -> DataFrame:
    """Area under the ROC curve of each class against the rest, with its support.

    ``scores`` names the score column of every class. The area is the share of (member,
    non-member) pairs the score puts in the right order, ties counting half. Rows are first
    counted per label and distinct score, so neither many rows nor one hot score meet in one task.
    A class without members, or without non-members, has a null area, and so has one whose score
    column is ``None``, as of a class the model has never seen.
    """
    unseen = [c for c, name in scores.items() if name is None]
    scores = {c: name for c, name in scores.items() if name is not None}
    columns = list(dict.fromkeys(scores.values()))
    known = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("_label"), *[F.col(c).cast("double").alias(c) for c in columns]
    )
    used_by = F.create_map(
        *[item for c in columns for item in (F.lit(c), F.array(*[F.lit(k) for k, own in scores.items() if own == c]))]
    )
    counts = (
        known.groupingSets([["_label", c] for c in columns], "_label", *columns)
        .agg(F.count("*").alias("n"), *[F.grouping(c).alias(f"_without_{c}") for c in columns])
        .select(
            "_label",
            F.coalesce(*[F.when(F.col(f"_without_{c}") == 0, F.lit(c)) for c in columns]).alias("column"),
            F.coalesce(*[F.when(F.col(f"_without_{c}") == 0, F.col(c)) for c in columns]).alias("score"),
            "n",
        )
        .select("score", "n", "_label", F.explode(used_by[F.col("column")]).alias("class"))
        .select(
            "class",
            "score",
            F.when(F.col("_label") == F.col("class"), F.col("n")).otherwise(0).alias("members"),
            F.when(F.col("_label") == F.col("class"), 0).otherwise(F.col("n")).alias("others"),
        )
    )
    # cut from the counts, which are fewer than the rows: what is dealt into ranges are counts
    (edges,) = range_edges(counts, [F.col("score")])
    ranked = running_totals(counts, "score", ["members", "others"], by=["class"], edges=edges, with_ties=True)
    members, others = F.col("members").cast("double"), F.col("others").cast("double")
    summed = ranked.groupBy("class").agg(
        F.sum("members").alias("support"),
        F.sum(others).alias("rest"),
        F.sum(members * F.col("upto_others")).alias("not_below"),  # pairs with the member at or above
        F.sum(others * F.col("upto_members")).alias("not_above"),  # pairs with the member at or below
    )
    pairs = F.col("support") * F.col("rest")
    wins = (F.col("not_below") + pairs - F.col("not_above")) / 2
    areas = summed.select("class", "support", F.try_divide(wins, pairs).alias("auc"))
    if not unseen:
        return areas
    members = [F.count_if(F.col("_label") == c).alias(f"of_{c}") for c in unseen]
    rows = [F.struct(F.lit(c).alias("class"), F.col(f"of_{c}").alias("support"), F.lit(None).cast("double").alias("auc")) for c in unseen]
    return areas.unionByName(known.agg(*members).select(F.inline(F.array(*rows))))


def weighted_auc(per_class: DataFrame) -> DataFrame:
    """Support-weighted mean area over the classes that have one."""
    known = per_class.where(F.col("auc").isNotNull())
    return known.agg(F.try_divide(F.sum(F.col("auc") * F.col("support")), F.sum("support")).alias("weighted_auc"))


def contingency(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Row counts by ``row`` with one column per listed value and ``other`` for all others, zeros filled in."""
    listed = [F.count_if(F.col(column) == value).alias(value) for value in values]
    other = F.count_if(~F.coalesce(F.col(column).isin(list(values)), F.lit(False)))
    return df.groupBy(row).agg(*listed, other.alias("other"))
