"""Totals, rates, series, concentration and rankings of notifications."""

from pyspark.sql import functions as F

from casewise.operators import series, totals
from casewise.plans import views
from casewise.plans.cleaning import FOCUS_EVENT
from casewise.plans.registry import REGISTRY
from casewise.sources import bindings
from casewise.streaming import kept

NOTI = f"with {views.NOTIFICATIONS}"


def _focus():
    return F.col("event") == FOCUS_EVENT


def _noti(spark, sf_dir):
    return bindings.notifications(spark, sf_dir)


RATE_SQL = f"""{NOTI}, focus as (select dept, sum(cases)::bigint as focus_total from noti where event = '{FOCUS_EVENT}' group by dept),
whole as (select dept, sum(cases)::bigint as group_total from noti group by dept)
select dept, focus_total, group_total, round(focus_total::double / group_total * 1000, 2) as rate
from focus join whole using (dept)"""


@REGISTRY.add("rate_per_group", RATE_SQL)
def rate_per_group(spark, sf_dir):
    return totals.rate_per_group(_noti(spark, sf_dir), "dept", _focus(), "cases").orderBy(F.desc("rate"), "dept")


@REGISTRY.add("rate_by_join", RATE_SQL)
def rate_by_join(spark, sf_dir):
    noti = _noti(spark, sf_dir)
    focus = totals.total_by(noti.where(_focus()), ["dept"], "cases", "focus_total")
    whole = totals.total_by(noti, ["dept"], "cases", "group_total")
    return totals.rate_by_join(focus, whole, "dept").orderBy(F.desc("rate"), "dept")


@REGISTRY.add(
    "focus_by_dept",
    f"{NOTI} select dept, sum(cases)::bigint as total from noti where event = '{FOCUS_EVENT}' group by dept",
)
def focus_by_dept(spark, sf_dir):
    return totals.total_by(_noti(spark, sf_dir).where(_focus()), ["dept"], "cases").orderBy(F.desc("total"), "dept")


@REGISTRY.add(
    "total_by_event",
    f"{NOTI} select event, sum(cases)::bigint as total from noti group by event order by total desc, event limit 15",
)
def total_by_event(spark, sf_dir):
    return totals.top_k(_event_totals(spark, sf_dir), [F.desc("total"), F.asc("event")], 15)


def _event_totals(spark, sf_dir):
    return totals.total_by(_noti(spark, sf_dir), ["event"], "cases")


def _dept_totals(spark, sf_dir):
    return totals.total_by(_noti(spark, sf_dir), ["dept"], "cases")


def _weekly(spark, sf_dir, focus_only=False):
    noti = _noti(spark, sf_dir)
    return totals.total_by(noti.where(_focus()) if focus_only else noti, ["week"], "cases")


@REGISTRY.add("weekly_totals", f"{NOTI} select week, sum(cases)::bigint as total from noti group by week")
def weekly_totals(spark, sf_dir):
    return _weekly(spark, sf_dir).orderBy("week")


@REGISTRY.add(
    "weekly_focus",
    f"{NOTI} select week, sum(cases)::bigint as total from noti where event = '{FOCUS_EVENT}' group by week",
)
def weekly_focus(spark, sf_dir):
    return _weekly(spark, sf_dir, focus_only=True).orderBy("week")


@REGISTRY.add(
    "weekly_moving_avg",
    f"""{NOTI}, weekly as (select week, sum(cases)::bigint as total from noti where event = '{FOCUS_EVENT}' group by week)
select week, total, case when count(*) over w = 4 then round(avg(total) over w, 6) end as moving_avg
from weekly window w as (order by week rows between 2 preceding and 1 following)""",
)
def weekly_moving_avg(spark, sf_dir):
    smoothed = series.moving_average(_weekly(spark, sf_dir, focus_only=True), "week", "total")
    return smoothed.withColumn("moving_avg", F.round("moving_avg", 6))


@REGISTRY.add(
    "step_delta",
    f"""{NOTI}, weekly as (select week, sum(cases)::bigint as total from noti group by week)
select week, total, round((lag(total) over w - total)::double / first(total) over w, 9) as delta
from weekly window w as (order by week)""",
)
def step_delta(spark, sf_dir):
    steps = series.step_delta(_weekly(spark, sf_dir), "week", "total")
    return steps.withColumn("delta", F.round("delta", 9))


@REGISTRY.add(
    "moving_avg_null_week",
    f"""{NOTI}, weekly as (select nullif(week, 7) as week, sum(cases)::bigint as total from noti group by all)
select week, total, case when count(*) over w = 4 then round(avg(total) over w, 6) end as moving_avg
from weekly window w as (order by week nulls first rows between 2 preceding and 1 following)""",
)
def moving_avg_null_week(spark, sf_dir):
    """A series with a null in its order, as from a week that does not parse."""
    noti = _noti(spark, sf_dir).withColumn("week", F.nullif("week", F.lit(7)))
    smoothed = series.moving_average(totals.total_by(noti, ["week"], "cases"), "week", "total")
    return smoothed.withColumn("moving_avg", F.round("moving_avg", 6))


@REGISTRY.add(
    "cumulative_towns",
    f"""{NOTI}, totals as (select town, (sum(cases) // 1000)::bigint as total from noti group by town)
select town, total, row_number() over w as rank, round(total::double / sum(total) over (), 9) as share,
       round((sum(total) over w)::double / sum(total) over (), 9) as cum_share
from totals window w as (order by total desc, town nulls first rows between unbounded preceding and current row)""",
)
def cumulative_towns(spark, sf_dir):
    """Many equal totals, and a group without a name."""
    found = totals.total_by(_noti(spark, sf_dir), ["town"], "cases").withColumn("total", F.expr("total div 1000"))
    return series.cumulative_share(found, "town", "total").withColumns(
        {"share": F.round("share", 9), "cum_share": F.round("cum_share", 9)}
    )


CUMULATIVE_SQL = f"""{NOTI}, totals as (select event, sum(cases)::bigint as total from noti group by event),
ranked as (select event, total, row_number() over w as rank, sum(total) over w as upto, sum(total) over () as whole
  from totals window w as (order by total desc, event rows between unbounded preceding and current row))"""


def _cumulative(spark, sf_dir):
    return series.cumulative_share(_event_totals(spark, sf_dir), "event", "total")


@REGISTRY.add(
    "cumulative_share",
    f"""{CUMULATIVE_SQL} select event, total, rank::bigint as rank, round(total::double / whole, 9) as share,
       round(upto::double / whole, 9) as cum_share from ranked""",
)
def cumulative_share(spark, sf_dir):
    return _cumulative(spark, sf_dir).withColumns(
        {"share": F.round("share", 9), "cum_share": F.round("cum_share", 9)}
    )


@REGISTRY.add(
    "share_of_total",
    f"""{NOTI}, totals as (select event, sum(cases)::bigint as total from noti group by event)
select event, total, round(total * 100.0::double / sum(total) over (), 6) as pct from totals""",
)
def share_of_total(spark, sf_dir):
    shared = series.share_of_total(_event_totals(spark, sf_dir), "total")
    return shared.withColumn("pct", F.round("pct", 6))


@REGISTRY.add(
    "event_frequency",
    f"{NOTI} select event, count(*) as n from noti group by event order by n desc, event limit 10",
)
def event_frequency(spark, sf_dir):
    counted = _noti(spark, sf_dir).groupBy("event").agg(F.count("*").alias("n"))
    return totals.top_k(counted, [F.desc("n"), F.asc("event")], 10)


@REGISTRY.add(
    "group_rollup_lists",
    f"""{NOTI}, items as (
  select event, dept, 'week' as list, cast(week as varchar) as value, cases from noti
  union all select event, dept, 'town', town, cases from noti
  union all select event, dept, 'all', null, cases from noti)
select event, dept, list, value, count(*) as copies, sum(cases)::bigint as amount from items group by all""",
)
def group_rollup_lists(spark, sf_dir):
    return totals.group_rollup(_noti(spark, sf_dir), ["event", "dept"], "cases", ["week", "town"])


@REGISTRY.add(
    "topk_sum",
    f"""{NOTI}, totals as (select dept, sum(cases)::bigint as total from noti group by dept)
select sum(total)::bigint as top_total from (select total from totals order by total desc, dept limit 10)""",
)
def topk_sum(spark, sf_dir):
    return totals.top_sum(_dept_totals(spark, sf_dir), "dept", "total", 10)


@REGISTRY.add(
    "concentration",
    f"""{NOTI}, totals as (select event, sum(cases)::bigint as total from noti group by event),
ranked as (select *, row_number() over (order by total desc, event) as rank, sum(total) over () as whole from totals)
select max(event) filter (rank = 1) as leader, max(total) filter (rank = 1) as leader_total,
       round(max(total) filter (rank = 1) * 100.0::double / max(whole), 6) as leader_pct,
       (sum(total) filter (rank <= 3))::bigint as top3_total,
       round(sum(total) filter (rank <= 3) * 100.0::double / max(whole), 6) as top3_pct,
       (sum(total) filter (rank <= 10))::bigint as top10_total,
       round(sum(total) filter (rank <= 10) * 100.0::double / max(whole), 6) as top10_pct,
       max(whole)::bigint as grand_total
from ranked""",
)
def concentration(spark, sf_dir):
    found = totals.concentration(_event_totals(spark, sf_dir), "event", "total", [3, 10])
    return found.withColumns({c: F.round(c, 6) for c in found.columns if c.endswith("_pct")})


@REGISTRY.add(
    "peak_week",
    f"""{NOTI} select week, sum(cases)::bigint as total from noti where event = '{FOCUS_EVENT}'
group by week order by total desc, week limit 1""",
)
def peak_week(spark, sf_dir):
    return totals.peak(_weekly(spark, sf_dir, focus_only=True), "week", "total")


@REGISTRY.add(
    "leader_dept",
    f"{NOTI} select dept, sum(cases)::bigint as total from noti group by dept order by total desc, dept limit 1",
)
def leader_dept(spark, sf_dir):
    return totals.peak(_dept_totals(spark, sf_dir), "dept", "total")


@REGISTRY.add(
    "topk_per_group",
    f"""{NOTI}, totals as (select dept, event, sum(cases)::bigint as total from noti group by dept, event)
select dept, event, total, rank from (
  select *, row_number() over (partition by dept order by total desc, event)::int as rank from totals) where rank <= 3""",
)
def topk_per_group(spark, sf_dir):
    grouped = totals.total_by(_noti(spark, sf_dir), ["dept", "event"], "cases")
    return totals.top_k_per_group(grouped, ["dept"], [F.desc("total"), F.asc("event")], 3)


@REGISTRY.add(
    "topk_resorted",
    f"{NOTI} select event, sum(cases)::bigint as total from noti group by event order by total desc, event limit 15",
)
def topk_resorted(spark, sf_dir):
    return total_by_event(spark, sf_dir).orderBy("total", "event")


@REGISTRY.add(
    "streamed_weekly_totals",
    """select date_trunc('week', ts)::timestamp as week, event_type, count(*) as n, sum(round(value * 100)::bigint)::bigint as cents
from events group by 1, 2""",
)
def streamed_weekly_totals(spark, sf_dir):
    """Weekly totals of files that arrive in any order, over two runs of the stream."""
    path = kept.scratch(spark)
    cents = F.round(F.col("value") * 100).cast("long").alias("cents")
    rows = bindings.events(spark, sf_dir).select(F.date_trunc("week", "ts").alias("week"), "event_type", cents, "event_id")
    totals_now = None
    for half in (0, 1):
        arrived = rows.where(F.col("event_id") % 2 == half).repartition(3, "event_id").drop("event_id")
        arrived.write.mode("append").parquet(f"{path}/in")
        stream = kept.arriving(spark, f"{path}/in", arrived.schema, files_at_once=2)
        totals_now = kept.keep_totals(stream, ["week", "event_type"], "cents", path)
    return totals_now.withColumnRenamed("total", "cents")
