"""Loading, cleaning and mapping of messy text columns."""

from pyspark.sql import functions as F

from casewise.functions.cleaning import blank_to_default, blank_to_null, dotted_year, short_label, to_int
from casewise.functions.domain import CATEGORY_LABELS, DEFAULT_CATEGORY, UNKNOWN_TOWN, event_category_rows
from casewise.operators.lookup import fold_rare, map_codes
from casewise.operators.profile import table_profile
from casewise.operators.sentiment import with_sentiment_code
from casewise.operators.totals import describe_group, top_k, total_by
from casewise.plans import views
from casewise.plans.registry import REGISTRY
from casewise.sources import bindings
from casewise.sources.readers import NOTIFICATION_COLUMNS, literal_table, read_text_columns, table
from casewise.sources.storage import fresh_path, write_report

FOCUS_EVENT = "Brand#1"
RARE_USER_ROWS = 60
CODES = event_category_rows()
CODE_VALUES = views.values(CODES, "code, category, label")


@REGISTRY.add(
    "scan_csv",
    f"""with {views.RAW}
select "Nombre" as event, count(*) as n, sum(cast(conteo_casos as bigint))::bigint as cases,
       sum(length(nom_mun))::bigint as town_chars, count(nom_mun) as towns
from raw group by "Nombre" """,
)
def scan_csv(spark, sf_dir):
    path = fresh_path(spark, "notifications-csv")
    written = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    bindings.raw_notifications(spark, sf_dir).write.options(**written).csv(path)
    read = read_text_columns(spark, path, NOTIFICATION_COLUMNS)
    return read.groupBy(F.col("Nombre").alias("event")).agg(
        F.count("*").alias("n"),
        F.sum(to_int("conteo_casos")).alias("cases"),
        F.sum(F.length("nom_mun")).alias("town_chars"),
        F.count("nom_mun").alias("towns"),
    )


@REGISTRY.add(
    "scan_csv_texts",
    """select doc_id, length(text)::int + 6 as letters, md5('so "' || text || '",') as digest from documents""",
)
def scan_csv_texts(spark, sf_dir):
    """Texts with line breaks, commas and quotes come back from a CSV file as they were."""
    path = fresh_path(spark, "texts-csv")
    quoted = F.concat(F.lit('so "'), F.col("text"), F.lit('",'))
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string"), quoted.alias("text"))
    written = {"header": True, "escape": '"', "quoteAll": True}
    texts.write.options(**written, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    read = read_text_columns(spark, path, ["doc_id", "text"])
    return read.select(F.col("doc_id").cast("long"), F.length("text").alias("letters"), F.md5("text").alias("digest"))


# Test data has no event codes of the domain, so a part number is folded into their range.
def _part_code():
    return (F.col("p_partkey") % 800 + 100).cast("int")


@REGISTRY.add(
    "literal_lookup",
    f"""select code, category, label, count(p_partkey) as parts
from {CODE_VALUES} left join part on p_partkey % 800 + 100 = code group by code, category, label""",
)
def literal_lookup(spark, sf_dir):
    codes = literal_table(spark, CODES, "code int, category string, label int")
    parts = table(spark, sf_dir, "part").groupBy(_part_code().alias("code")).agg(F.count("*").alias("found"))
    return codes.join(parts, "code", "left").select(
        "code", "category", "label", F.coalesce("found", F.lit(0)).alias("parts")
    )


def _mapped_sales(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") % 800 + 100).cast("int").alias("code"), F.col("l_quantity").cast("int").alias("cases")
    )
    outputs = [("category", "string", DEFAULT_CATEGORY), ("label", "int", CATEGORY_LABELS[DEFAULT_CATEGORY])]
    return map_codes(lines, "code", CODES, outputs)


MAPPED_SQL = f"""from lineitem left join {CODE_VALUES} on l_partkey % 800 + 100 = code"""


@REGISTRY.add(
    "map_category",
    f"""select coalesce(category, 'OTROS') as category, count(*) as n,
       sum(cast(l_quantity as integer))::bigint as cases {MAPPED_SQL} group by 1""",
)
def map_category(spark, sf_dir):
    return _mapped_sales(spark, sf_dir).groupBy("category").agg(F.count("*").alias("n"), F.sum("cases").alias("cases"))


@REGISTRY.add(
    "map_label",
    f"select coalesce(label, 6) as label, count(*) as n {MAPPED_SQL} group by 1",
)
def map_label(spark, sf_dir):
    return _mapped_sales(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"))


@REGISTRY.add(
    "class_distribution",
    f"""select coalesce(category, 'OTROS') as category, coalesce(label, 6) as label, count(*) as n
{MAPPED_SQL} group by 1, 2""",
)
def class_distribution(spark, sf_dir):
    return _mapped_sales(spark, sf_dir).groupBy("category", "label").agg(F.count("*").alias("n")).orderBy("label")


LINEITEM_TYPES = [
    (1, "l_orderkey", "bigint"), (2, "l_partkey", "bigint"), (3, "l_suppkey", "bigint"), (4, "l_linenumber", "int"),
    (5, "l_quantity", "double"), (6, "l_extendedprice", "double"), (7, "l_discount", "double"),
    (8, "l_tax", "double"), (9, "l_returnflag", "string"), (10, "l_linestatus", "string"),
    (11, "l_shipdate", "timestamp_ntz"),
]


@REGISTRY.add(
    "table_profile",
    f"""select *, (select count(*) from lineitem) as rows, 11 as columns
from {views.values(LINEITEM_TYPES, 'position, "column", type')}""",
)
def profile_of_lineitem(spark, sf_dir):
    return table_profile(table(spark, sf_dir, "lineitem"))


@REGISTRY.add(
    "head_n",
    """select o_orderkey, o_custkey, o_orderstatus, o_orderpriority from orders order by o_orderkey limit 10""",
)
def head_n(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return top_k(orders, [F.asc("o_orderkey")], 10)


@REGISTRY.add(
    "report_roundtrip",
    f"""with {views.NOTIFICATIONS}
select event, sum(cases)::bigint as total from noti group by event order by total desc, event limit 15""",
)
def report_roundtrip(spark, sf_dir):
    totals = total_by(bindings.notifications(spark, sf_dir), ["event"], "cases")
    return write_report(top_k(totals, [F.desc("total"), F.asc("event")], 15), fresh_path(spark, "report"))


@REGISTRY.add(
    "clean_cast",
    f"""with {views.RAW}
select "SEMANA" as week_text, try_cast("SEMANA" as integer) as week,
       "COD_DPTO_O" as dept_text, try_cast("COD_DPTO_O" as integer) as dept,
       count(*) as n, sum(try_cast(conteo_casos as integer))::bigint as cases,
       sum(try_cast("COD_MUN_O" as integer))::bigint as towns, sum(try_cast("COD_EVE" as integer))::bigint as codes
from raw group by "SEMANA", "COD_DPTO_O" """,
)
def clean_cast(spark, sf_dir):
    return (
        bindings.raw_notifications(spark, sf_dir)
        .groupBy(F.col("SEMANA").alias("week_text"), F.col("COD_DPTO_O").alias("dept_text"))
        .agg(
            F.count("*").alias("n"),
            F.sum(to_int("conteo_casos")).alias("cases"),
            F.sum(to_int("COD_MUN_O")).alias("towns"),
            F.sum(to_int("COD_EVE")).alias("codes"),
        )
        .withColumns({"week": to_int("week_text"), "dept": to_int("dept_text")})
    )


@REGISTRY.add(
    "clean_year",
    f"""with {views.RAW}
select "ANO" as year_text, try_cast(regexp_replace("ANO", '[.]', '', 'g') as integer) as year, count(*) as n
from raw group by "ANO" """,
)
def clean_year(spark, sf_dir):
    years = bindings.raw_notifications(spark, sf_dir).groupBy(F.col("ANO").alias("year_text")).agg(F.count("*").alias("n"))
    return years.withColumn("year", dotted_year("year_text"))


def _towns(spark, sf_dir):
    raw = bindings.raw_notifications(spark, sf_dir)
    return raw.groupBy(F.col("nom_mun").alias("town_text")).agg(F.count("*").alias("n"))


@REGISTRY.add(
    "clean_blank_to_null",
    f"""with {views.RAW}
select nom_mun as town_text, nullif(trim(nom_mun), '') as town, count(*) as n from raw group by nom_mun""",
)
def clean_blank_to_null(spark, sf_dir):
    return _towns(spark, sf_dir).withColumn("town", blank_to_null("town_text"))


@REGISTRY.add(
    "clean_blank_to_default",
    f"""with {views.RAW}
select nom_mun as town_text, coalesce(nullif(trim(nom_mun), ''), {views.quoted(UNKNOWN_TOWN)}) as town, count(*) as n
from raw group by nom_mun""",
)
def clean_blank_to_default(spark, sf_dir):
    return _towns(spark, sf_dir).withColumn("town", blank_to_default("town_text", UNKNOWN_TOWN))


@REGISTRY.add(
    "project_rename_drop",
    "select c_custkey as customer, c_name as name, c_nationkey as nation, c_mktsegment as segment from customer",
)
def project_rename_drop(spark, sf_dir):
    renamed = {"c_custkey": "customer", "c_name": "name", "c_nationkey": "nation", "c_mktsegment": "segment"}
    return table(spark, sf_dir, "customer").withColumnsRenamed(renamed).drop("c_acctbal")


@REGISTRY.add(
    "cast_to_string",
    f"""with {views.NOTIFICATIONS}
select cast(dept as varchar) as dept_text, count(*) as n from noti group by dept""",
)
def cast_to_string(spark, sf_dir):
    depts = bindings.notifications(spark, sf_dir).groupBy("dept").agg(F.count("*").alias("n"))
    return depts.select(F.col("dept").cast("string").alias("dept_text"), "n")


@REGISTRY.add(
    "fold_rare",
    f"""with sizes as (select user_id, count(*) as rows from events group by user_id)
select case when rows >= {RARE_USER_ROWS} then cast(user_id as varchar) else 'Otros' end as user_name,
       count(*) as n, min(event_id) as first_event
from events join sizes using (user_id) group by 1""",
)
def fold_rare_users(spark, sf_dir):
    users = bindings.events(spark, sf_dir).select("event_id", F.col("user_id").alias("user_name"))
    folded = fold_rare(users, "user_name", RARE_USER_ROWS)
    return folded.groupBy("user_name").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@REGISTRY.add(
    "filter_focus_event",
    f"""with {views.NOTIFICATIONS}
select event_code, year, week, dept, town_code, town, cases from noti where event = '{FOCUS_EVENT}'""",
)
def filter_focus_event(spark, sf_dir):
    return bindings.notifications(spark, sf_dir).where(F.col("event") == FOCUS_EVENT).drop("event")


@REGISTRY.add(
    "unknown_code_audit",
    f"""with {views.NOTIFICATIONS}, unknown as (select event_code, year, week, town_code, cases from noti where dept = 0)
select *, (select count(*) from unknown) as unknown_rows from unknown
order by event_code, year, week, town_code, cases limit 5""",
)
def unknown_code_audit(spark, sf_dir):
    columns = ["event_code", "year", "week", "town_code", "cases"]
    unknown = bindings.notifications(spark, sf_dir).where(F.col("dept") == 0).select(*columns)
    found = unknown.agg(F.count("*")).scalar()
    return top_k(unknown, [F.asc(c) for c in columns], 5).withColumn("unknown_rows", found)


@REGISTRY.add(
    "filter_known",
    f"""with {views.NOTIFICATIONS}
select dept, count(*) as n, sum(cases)::bigint as cases from noti where dept <> 0 group by dept""",
)
def filter_known(spark, sf_dir):
    known = bindings.notifications(spark, sf_dir).where(F.col("dept") != 0)
    return known.groupBy("dept").agg(F.count("*").alias("n"), F.sum("cases").alias("cases"))


@REGISTRY.add(
    "generate_documents",
    f"""with {views.NOTIFICATIONS}, grouped as (
  select event, dept, sum(cases)::bigint as total, count(*) as rows from noti group by event, dept)
select event, dept, total, rows,
       concat_ws(' ', 'Evento:', event, 'en el departamento', cast(dept as varchar), '. Total de casos:',
                 cast(total as varchar), '. Registros:', cast(rows as varchar), '.') as document
from grouped""",
)
def generate_documents(spark, sf_dir):
    groups = (
        bindings.notifications(spark, sf_dir)
        .groupBy("event", "dept")
        .agg(F.sum("cases").alias("total"), F.count("*").alias("rows"))
    )
    parts = [
        "Evento:", F.col("event"), "en el departamento", F.col("dept"),
        ". Total de casos:", F.col("total"), ". Registros:", F.col("rows"), ".",
    ]
    return groups.withColumn("document", describe_group(parts))


@REGISTRY.add(
    "truncate_label",
    "select substr(p_name, 1, 6) as short_name, count(*) as n, count(distinct p_name) as names from part group by 1",
)
def truncate_label(spark, sf_dir):
    short = short_label("p_name", 6).alias("short_name")
    return table(spark, sf_dir, "part").groupBy(short).agg(
        F.count("*").alias("n"), F.count_distinct("p_name").alias("names")
    )


@REGISTRY.add(
    "map_sentiment_code",
    """select case event_type when 'purchase' then 'POS' when 'view' then 'NEU' when 'error' then 'NEG' end as sentiment,
       case event_type when 'purchase' then 0 when 'error' then 2 else 1 end as sentiment_code, count(*) as n
from events group by 1, 2""",
)
def map_sentiment_code(spark, sf_dir):
    kind = F.col("event_type")
    felt = F.when(kind == "purchase", "POS").when(kind == "view", "NEU").when(kind == "error", "NEG")
    coded = with_sentiment_code(bindings.events(spark, sf_dir).select(felt.alias("sentiment")))
    return coded.groupBy("sentiment", "sentiment_code").agg(F.count("*").alias("n"))
