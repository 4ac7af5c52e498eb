"""Nulls, duplicates, percentiles and outliers."""

from pyspark.sql import functions as F

from casewise.operators import profile, sketches
from casewise.operators.ordered import exact_percentiles
from casewise.operators.totals import top_k
from casewise.plans import views
from casewise.plans.registry import REGISTRY
from casewise.sources import bindings
from casewise.sources.readers import table
from casewise.sources.storage import staged

DESCRIBED = ["week", "dept", "cases"]
NOTI_COLUMNS = ["event_code", "event", "year", "week", "dept", "town_code", "town", "cases"]


def _rounded(df, digits=6):
    return df.select(
        *[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]
    )


@REGISTRY.add(
    "describe_cols",
    f"with {views.NOTIFICATIONS}\n"
    + " union all ".join(
        f"""select '{c}' as "column", count({c}) as n, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as stddev,
min({c})::double as min, max({c})::double as max from noti"""
        for c in DESCRIBED
    ),
)
def describe_cols(spark, sf_dir):
    return _rounded(profile.describe_columns(bindings.notifications(spark, sf_dir), DESCRIBED))


@REGISTRY.add(
    "summary_col",
    """select count(value) as n, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as stddev,
       min(value) as min, max(value) as max, quantile_disc(value, 0.25) as p25, quantile_disc(value, 0.5) as p50,
       quantile_disc(value, 0.75) as p75 from events""",
)
def summary_col(spark, sf_dir):
    return _rounded(profile.summary(bindings.events(spark, sf_dir), "value"))


@REGISTRY.add(
    "percentiles",
    """select quantile_disc(value, 0.90) as p90, quantile_disc(value, 0.95) as p95,
       quantile_disc(value, 0.99) as p99 from events""",
)
def percentiles(spark, sf_dir):
    return exact_percentiles(bindings.events(spark, sf_dir), "value", profile.percentile_points([90, 95, 99]))


@REGISTRY.add(
    "percentiles_of_price",
    """select quantile_disc(l_extendedprice, 0.25) as p25, quantile_disc(l_extendedprice, 0.50) as p50,
       quantile_disc(l_extendedprice, 0.75) as p75, quantile_disc(l_extendedprice, 0.99) as p99 from lineitem""",
)
def percentiles_of_price(spark, sf_dir):
    points = profile.percentile_points([25, 50, 75, 99])
    return exact_percentiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", points)


@REGISTRY.add(
    "null_audit",
    f"with {views.NOTIFICATIONS}\n"
    + " union all ".join(
        f"""select '{c}' as "column", count(*) - count({c}) as nulls,
round((count(*) - count({c})) * 100.0::double / count(*), 6) as pct from noti"""
        for c in NOTI_COLUMNS
    ),
)
def null_audit(spark, sf_dir):
    return _rounded(profile.null_audit(bindings.notifications(spark, sf_dir)))


@REGISTRY.add(
    "exact_duplicates",
    """select count(*) as rows, count(distinct text) as distinct_rows, count(*) - count(distinct text) as duplicates,
       round((count(*) - count(distinct text)) * 100.0::double / count(*), 6) as pct from documents""",
)
def exact_duplicates(spark, sf_dir):
    return _rounded(profile.exact_duplicates(bindings.documents(spark, sf_dir).select("text")))


DUPLICATE_KEY_SQL = f"""with {views.NOTIFICATIONS}, keys as (
  select event_code, week, town_code, count(*) as n from noti group by all having count(*) > 1)"""


@REGISTRY.add("duplicate_keys", f"{DUPLICATE_KEY_SQL} select * from keys")
def duplicate_keys(spark, sf_dir):
    return profile.duplicate_keys(bindings.notifications(spark, sf_dir), ["event_code", "week", "town_code"])


@REGISTRY.add("duplicate_key_count", f'{DUPLICATE_KEY_SQL} select count(*) as "groups" from keys')
def duplicate_key_count(spark, sf_dir):
    return duplicate_keys(spark, sf_dir).agg(F.count("*").alias("groups"))


IQR_SQL = """with limits as (
  select quantile_disc(value, 0.25) as q1, quantile_disc(value, 0.75) as q3,
         quantile_disc(value, 0.75) + 1.5::double * (quantile_disc(value, 0.75) - quantile_disc(value, 0.25)) as upper
  from events)"""


@REGISTRY.add(
    "iqr_outliers",
    f"""{IQR_SQL}
select any_value(q1) as q1, any_value(q3) as q3, round(any_value(q3) - any_value(q1), 6) as iqr,
       round(any_value(upper), 6) as upper, count(*) filter (value > upper) as outliers,
       round(count(*) filter (value > upper) * 100.0::double / count(*), 6) as pct
from events, limits""",
)
def iqr_outliers(spark, sf_dir):
    return _rounded(profile.iqr_outliers(bindings.events(spark, sf_dir), "value"))


@REGISTRY.add("outlier_rows", f"{IQR_SQL} select event_id, value from events, limits where value > upper")
def outlier_rows(spark, sf_dir):
    return profile.rows_above_limit(bindings.events(spark, sf_dir).select("event_id", "value"), "value")


@REGISTRY.add(
    "distinct_counts",
    f"""with {views.NOTIFICATIONS}
select count(distinct event) as event, count(distinct dept) as dept, count(distinct week) as week from noti""",
)
def distinct_counts(spark, sf_dir):
    return profile.distinct_counts(bindings.notifications(spark, sf_dir), ["event", "dept", "week"])


@REGISTRY.add(
    "topk_values",
    f"""with {views.NOTIFICATIONS}
select event, town, week, cases from noti order by cases desc, event, town nulls first, week limit 10""",
)
def topk_values(spark, sf_dir):
    rows = bindings.notifications(spark, sf_dir).select("event", "town", "week", "cases")
    return top_k(rows, [F.desc("cases"), F.asc("event"), F.asc_nulls_first("town"), F.asc("week")], 10)


POINTS = {"p50": 0.5, "p95": 0.95}


@REGISTRY.add(
    "merged_sketches",
    """with sold as (select year(l_shipdate)::int as year, month(l_shipdate)::int as month, l_extendedprice, l_orderkey from lineitem)
select year, count(*) as rows, count(distinct month) as states, true as p50_holds, true as p95_holds, true as distinct_holds
from sold group by year""",
)
def merged_sketches(spark, sf_dir):
    """Monthly states, written and merged to years: their answers keep their bounds against the rows."""
    sold = table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), "l_extendedprice", "l_orderkey"
    )
    monthly = staged(sketches.group_states(sold, ["year", "month"], "l_extendedprice", "l_orderkey"), "states")
    yearly = staged(sketches.answers(sketches.merged_states(monthly, ["year"]), ["year"], POINTS), "answers")
    errors = sketches.rank_bounds(sold, ["year"], "l_extendedprice", yearly, POINTS)
    exact = sold.groupBy("year").agg(F.count_distinct("l_orderkey").alias("exact"))
    states = monthly.groupBy("year").agg(F.count("*").alias("states"))
    joined = yearly.select("year", "rows", "distinct").join(errors, "year").join(exact, "year").join(states, "year")
    return joined.select(
        "year",
        "rows",
        "states",
        (F.col("p50") <= 0.01).alias("p50_holds"),
        (F.col("p95") <= 0.01).alias("p95_holds"),
        (F.abs(F.col("distinct") - F.col("exact")) <= 0.05 * F.col("exact")).alias("distinct_holds"),
    )
