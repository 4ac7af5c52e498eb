"""Feature preparation of notifications."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from casewise.operators import encode, features
from casewise.plans import views
from casewise.plans.registry import REGISTRY
from casewise.sources import bindings
from casewise.sources.readers import table
from casewise.sources.storage import staged

NOTI = f"with {views.NOTIFICATIONS}"


@REGISTRY.add(
    "string_index",
    """with sizes as (select p_brand as brand, count(*) as n from part group by 1)
select brand, n, (row_number() over (order by n desc, brand) - 1)::double as brand_idx from sizes""",
)
def string_index(spark, sf_dir):
    codes = encode.dictionary(table(spark, sf_dir, "part"), "p_brand")
    return codes.select(F.col("value").alias("brand"), "n", F.col("code").cast("double").alias("brand_idx"))


@REGISTRY.add(
    "one_hot",
    """with named as (select p_partkey, p_brand as brand from part),
sizes as (select brand, count(*) as n from named group by 1),
slots as (select brand, (row_number() over (order by n desc, brand) - 1)::int as slot, count(*) over () + 1 as width from sizes)
select p_partkey, slot, width::int as width from named join slots using (brand)""",
)
def one_hot(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"))
    codes = encode.dictionary(parts, "brand")
    hot = encode.encoded(parts, "brand", codes, "code").withColumn("hot", encode.one_hot("code", codes))
    return hot.select(
        "p_partkey", F.explode(F.col("hot.indices").cast("array<int>")).alias("slot"), F.col("hot.size").cast("int").alias("width")
    )


CLIENTS = """with orders_of as (
  select o_orderkey, 'client ' || o_custkey as client, month(o_orderdate) as month, length(o_orderpriority) as letters from orders),
sizes as (select client, count(*) as n from orders_of group by 1),
codes as (select client, n, row_number() over (order by n desc, client) - 1 as code from sizes)"""


def _orders_of(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("client "), F.col("o_custkey").cast("string")).alias("client"),
        F.month("o_orderdate").alias("month"),
        F.length("o_orderpriority").alias("letters"),
    )


@REGISTRY.add("dictionary_codes", f"{CLIENTS} select o_orderkey, code from orders_of join codes using (client)")
def dictionary_codes(spark, sf_dir):
    orders = _orders_of(spark, sf_dir)
    return encode.encoded(orders, "client", encode.dictionary(orders, "client"), "code").select("o_orderkey", "code")


@REGISTRY.add(
    "sparse_features",
    f"""{CLIENTS} select 0::bigint as position, count(*) as nonzero, sum(month)::double as total from orders_of
union all select code + 1, n, n::double from codes
union all select (select count(*) + 2 from codes), count(*), sum(letters)::double from orders_of""",
)
def sparse_features(spark, sf_dir):
    orders = _orders_of(spark, sf_dir)
    codes = encode.dictionary(orders, "client")
    hot = encode.encoded(orders, "client", codes, "code").withColumn("hot", encode.one_hot("code", codes))
    return encode.sparse_slots(hot.select(encode.assembled(["month"], "hot", ["letters"]).alias("features")), "features")


def _known(spark, sf_dir):
    known = bindings.notifications(spark, sf_dir, heavy=True).where(F.col("dept") != 0)
    return known.select("week", F.col("dept").cast("string").alias("dept"), "cases")


def _assembled(spark, sf_dir):
    known = staged(_known(spark, sf_dir), "known")  # each stage below is fitted on it
    return features.prepared(known, features.feature_stages(["week"], "dept", ["cases"]))[1]


SLOTS_SQL = f"""{NOTI}, known as (select week, cast(dept as varchar) as dept, cases from noti where dept <> 0),
sizes as (select dept, count(*) as n from known group by dept),
hot as (select row_number() over (order by n desc, dept) as position, 'dept_hot_' || dept as slot, n from sizes),
slots as (
  select 0 as position, 'week' as slot, count(*) filter (week <> 0) as nonzero, sum(week)::double as total from known
  union all select position, slot, n, n::double from hot
  union all select count(*) + 1, 'dept_hot___unknown', 0, 0 from hot
  union all select (select count(*) + 2 from hot), 'cases', count(*) filter (cases <> 0), sum(cases)::double from known)"""


@REGISTRY.add(
    "assemble_features",
    f"""{SLOTS_SQL} select position::int as position, slot, (select count(*) from known) as rows, nonzero, total from slots""",
)
def assemble_features(spark, sf_dir):
    assembled = _assembled(spark, sf_dir)
    found = features.slot_summary(assembled, "features", features.slot_names(assembled))
    return found.drop("mean", "stddev").withColumn("total", F.round("total", 3))


@REGISTRY.add(
    "scaled_features",
    f"""{SLOTS_SQL} select position::int as position, slot, (select count(*) from known) as rows, 0.0::double as mean,
       case when nonzero = 0 then 0.0 else 1.0 end::double as stddev from slots""",
)
def scaled_features(spark, sf_dir):
    assembled = _assembled(spark, sf_dir)
    found = features.slot_summary(assembled, "scaled", features.slot_names(assembled))
    return found.select(
        "position", "slot", "rows", F.abs(F.round("mean", 6)).alias("mean"), F.round("stddev", 6).alias("stddev")
    )


@REGISTRY.add(
    "standard_scale",
    f"""{NOTI}, fitted as (select avg(week) as wm, stddev_samp(week) as ws, avg(cases) as cm, stddev_samp(cases) as cs from noti)
select week, cases, count(*) as n, round((week - any_value(wm)) / any_value(ws), 6) as week_scaled,
       round((cases - any_value(cm)) / any_value(cs), 6) as cases_scaled from noti, fitted group by week, cases""",
)
def standard_scale(spark, sf_dir):
    noti = bindings.notifications(spark, sf_dir, heavy=True).select("week", "cases")
    scaled = features.prepared(noti, features.numeric_stages(["week", "cases"]))[1]
    counted = scaled.groupBy("week", "cases", vector_to_array("scaled").alias("scaled")).agg(F.count("*").alias("n"))
    return counted.select(
        "week",
        "cases",
        "n",
        F.round(F.col("scaled")[0], 6).alias("week_scaled"),
        F.round(F.col("scaled")[1], 6).alias("cases_scaled"),
    )
