"""Evaluation of predictions made elsewhere."""

from pyspark.sql import functions as F

from casewise.operators import metrics
from casewise.plans import views
from casewise.plans.registry import REGISTRY
from casewise.sources import bindings

CLASSES = [0, 1, 2]
SCORES = {c: "score" for c in CLASSES}
PRED = f"with {views.PREDICTIONS}"


@REGISTRY.add(
    "classification_metrics",
    f"""{PRED}, classes as (select distinct label as class from pred union select distinct prediction from pred),
per_class as (
  select class, (select count(*) from pred where label = class) as support,
         (select count(*) from pred where prediction = class) as called,
         (select count(*) from pred where label = class and prediction = class) as hits from classes),
scored as (
  select support, hits, coalesce(hits::double / nullif(called, 0), 0) as p, coalesce(hits::double / nullif(support, 0), 0) as r
  from per_class)
select round(sum(hits)::double / sum(support), 9) as accuracy,
       round(sum(support * coalesce(2 * p * r / nullif(p + r, 0), 0)) / sum(support), 9) as f1,
       round(sum(support * p) / sum(support), 9) as weighted_precision,
       round(sum(support * r) / sum(support), 9) as weighted_recall
from scored""",
)
def classification_metrics(spark, sf_dir):
    found = metrics.classification_metrics(bindings.predictions(spark, sf_dir))
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])


@REGISTRY.add(
    "confusion_matrix",
    f"""{PRED} select label, count(*) filter (prediction = 0) as pred_0, count(*) filter (prediction = 1) as pred_1,
       count(*) filter (prediction = 2) as pred_2 from pred group by label""",
)
def confusion_matrix(spark, sf_dir):
    found = metrics.confusion_matrix(bindings.predictions(spark, sf_dir), CLASSES)
    return found.where("label is not null").drop("pred_other")  # nothing is left over here


@REGISTRY.add(
    "confusion_unlisted",
    f"""{PRED}, sides as (select case when label in (0, 1) then label end as label,
         case when l.prediction in (0, 1) then l.prediction end as prediction from pred l),
listed as (select * from (values (0), (1), (null)) as c(label))
select c.label, count(*) filter (s.prediction = 0) as pred_0, count(*) filter (s.prediction = 1) as pred_1,
       count(*) filter (s.prediction is null) as pred_other
from listed c join sides s on s.label is not distinct from c.label group by c.label""",
)
def confusion_unlisted(spark, sf_dir):
    """One class is not listed: its rows are among the others."""
    return metrics.confusion_matrix(bindings.predictions(spark, sf_dir), [0, 1])


@REGISTRY.add(
    "top_confusions",
    f"""{PRED} select label, prediction, count(*) as n from pred where label <> prediction
group by label, prediction order by n desc, label desc, prediction desc limit 3""",
)
def top_confusions(spark, sf_dir):
    return metrics.top_confusions(bindings.predictions(spark, sf_dir))


AUC_SQL = f"""{PRED}, counts as (
  select c.class, score, sum(case when label = c.class then 1 else 0 end)::double as members,
         sum(case when label = c.class then 0 else 1 end)::double as others
  from pred, (values (0), (1), (2)) as c(class) group by c.class, score),
ranked as (select *, sum(others) over (partition by class order by score) - others / 2 as below from counts),
areas as (select class, sum(members)::bigint as support, sum(members * below) / (sum(members) * sum(others)) as auc
  from ranked group by class)"""


@REGISTRY.add("auc_ovr", f"{AUC_SQL} select class, support, round(auc, 9) as auc from areas")
def auc_ovr(spark, sf_dir):
    areas = metrics.auc_one_vs_rest(bindings.predictions(spark, sf_dir), SCORES)
    return areas.withColumn("auc", F.round("auc", 9))


@REGISTRY.add("auc_weighted", f"{AUC_SQL} select round(sum(auc * support) / sum(support), 9) as weighted_auc from areas")
def auc_weighted(spark, sf_dir):
    areas = metrics.auc_one_vs_rest(bindings.predictions(spark, sf_dir), SCORES)
    return metrics.weighted_auc(areas).select(F.round("weighted_auc", 9).alias("weighted_auc"))
