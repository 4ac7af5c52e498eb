"""The table bindings as SQL, for the queries that check the Spark results."""

RAW = """
raw as (
  select regexp_extract(p_brand, '([0-9]+)', 1) as "COD_EVE",
         p_brand as "Nombre",
         substr(cast(year(l_shipdate) as varchar), 1, 1) || '.' || substr(cast(year(l_shipdate) as varchar), 2, 3) as "ANO",
         cast(weekofyear(l_shipdate) as varchar) as "SEMANA",
         cast(s_nationkey as varchar) as "COD_DPTO_O",
         cast(l_suppkey as varchar) as "COD_MUN_O",
         case when s_nationkey = 0 then '  ' else ' ' || s_name || ' ' end as nom_mun,
         cast(cast(l_quantity as integer) as varchar) as conteo_casos
  from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
)"""

NOTIFICATIONS = f"""{RAW},
noti as (
  select try_cast("COD_EVE" as integer) as event_code,
         "Nombre" as event,
         try_cast(regexp_replace("ANO", '[.]', '', 'g') as integer) as year,
         try_cast("SEMANA" as integer) as week,
         try_cast("COD_DPTO_O" as integer) as dept,
         try_cast("COD_MUN_O" as integer) as town_code,
         nullif(trim(nom_mun), '') as town,
         try_cast(conteo_casos as integer) as cases
  from raw
)"""

PREDICTIONS = """
pred as (
  select case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as label,
         l_linenumber % 3 as prediction, l_quantity as score
  from lineitem
)"""


def tokens(stop_words: list[str] | None = None, name: str = "toks") -> str:
    """Tokenised documents, without the given stop words."""
    stop = ""
    if stop_words:
        stop = f" and not list_contains([{', '.join(quoted(w) for w in sorted(set(stop_words)))}], t)"
    return f"""
{name} as (
  select doc_id, lang,
         list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\\s+'), lambda t: length(t) >= 2{stop}) as tokens
  from documents
)"""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(rows: list[tuple], columns: str) -> str:
    """A literal table as a sub-select."""
    body = ", ".join("(" + ", ".join(quoted(v) if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)
    return f"(values {body}) as t({columns})"
