"""DuckDB SQL that gives the rows of the queries."""

from casewise.llm.quality import CLASSES, COMMON_WORDS, Rules, word_bins

WORD = "[^\\x20\\x09-\\x0D]+"

MIX = f"""
with docs as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::bigint as size,
         md5('mix:' || coalesce(doc_id::varchar, 'null')) as ord
  from documents
), sources as (
  select source, sum(size)::bigint as source_size from docs group by source
), ranked as (
  select source, source_size, 2 * source_size as cap,
         [3, 1, 2][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::bigint as weight,
         row_number() over (order by source nulls last) as rank
  from sources
), filled as (
  select *, (3 * sum(source_size) over () - 2 * coalesce(sum(cap) over (order by cap::double / weight, rank
              rows between unbounded preceding and 1 preceding), 0))::bigint as left_over,
         (sum(weight) over (order by cap::double / weight, rank rows between current row and unbounded following))::bigint as sharing
  from ranked
), level as (
  select left_over, sharing from filled where not (cap::double * sharing * 2 <= weight::double * left_over)
  order by cap::double / weight, rank limit 1
), targets as (
  select source, source_size, least(cap::double,
           coalesce((weight * (select left_over from level))::double / (2 * (select sharing from level))::double, cap::double)) as target
  from filled
), plan as (
  select *, coalesce(floor(target / nullif(source_size, 0)), 0)::bigint as repeats from targets
), cut as (
  select *, round(target - repeats * source_size)::bigint as fraction from plan
), placed as (
  select d.doc_id, d.size, c.source_size, c.target, c.repeats, c.fraction,
         coalesce(sum(d.size) over (partition by d.source order by d.ord, d.doc_id nulls first, d.size
           rows between unbounded preceding and 1 preceding), 0) as before
  from docs d join cut c on d.source is not distinct from c.source
)
select doc_id, size, source_size, target,
       (repeats * size + greatest(0, least(size, fraction - before)))::bigint as taken
from placed
"""

URLS = """
with parts as (
  select page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages
), rules(verdict, rhost, rpath) as (
  values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), hits as (
  select page_id, host, path, verdict, rhost || rpath as rule,
         row_number() over (partition by page_id order by length(rhost || rpath) desc) as place
  from parts join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
)
select p.page_id, p.host, p.path, h.rule, coalesce(h.verdict, 'allow') as verdict
from parts p left join hits h on p.page_id = h.page_id and h.place = 1
"""


def _quality() -> str:
    rules, words = Rules(), word_bins()
    chain = ["regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g') as left0"]
    chain += [f"regexp_replace(left{i}, '{pattern}', '', 'g') as left{i + 1}" for i, (_, pattern) in enumerate(CLASSES)]
    n = len(CLASSES)
    classes = [f"length(left{i}) - length(left{i + 1})" for i in range(n)] + [f"length(left{n})"]
    found = [f"((length(spaced) - length(replace(spaced, ' {w} ', ''))) // {len(w) + 2})" for w in words]
    class_sums = ", ".join(f"sum(class_counts[{i + 1}])::double" for i in range(n + 1))
    compared = f"lang is null or lang in ({', '.join(repr(name) for name in sorted(COMMON_WORDS))})"
    limit = f"case when n_words < {rules.short_words} then {rules.max_short_distance} else {rules.max_distance} end"
    word_sums = ", ".join(f"sum(word_counts[{i + 1}])::double" for i in range(len(words) + 1))

    def distance(counts: str, reference: str, references: str) -> str:
        term = (
            "(case when x[1] > 0 then (x[1] / t) * log2((x[1] / t) / (((x[1] / t) + x[2]) / 2)) else 0 end"
            " + case when x[2] > 0 then x[2] * log2(x[2] / (((x[1] / t) + x[2]) / 2)) else 0 end)"
        ).replace("t)", f"list_sum(f.{counts}))")
        return (
            f"(select min(sqrt(greatest(0, list_sum(list_transform(list_zip(f.{counts}::double[], r.{reference}),"
            f" lambda x: {term})) / 2))) from {references} r)"
        )

    return f"""
with base as (
  select doc_id, lang, coalesce(text, '') as t,
         coalesce(regexp_extract_all(text, '{WORD}'), []::varchar[]) as words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from documents
), chained as (
  select *, {", ".join(chain)},
         ' ' || regexp_replace(regexp_replace(lower(t), '\\p{{L}}{{{max(map(len, words)) + 1},}}', '', 'g'), '[^\\p{{L}}]+', '  ', 'g') || ' ' as spaced, row_number() over () as id
  from base
), triples as (
  select id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as w
  from (select id, words, unnest(range(1, len(words) - 1)) as i from chained)
), twice as (
  select id, i from triples qualify count(*) over (partition by id, w) > 1
), covered as (
  select id, count(distinct i + k) as n from twice, (values (0), (1), (2)) as o(k) group by id
), counted as (
  select doc_id, lang, len(words)::bigint as n_words, length(left0)::bigint as word_chars,
         (length(left3) - length(left4))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         coalesce(c.n, 0)::bigint as n_repeat_words,
         [{", ".join(classes)}] as class_counts,
         [{", ".join(found)}] as found
  from chained left join covered c using (id)
), features as (
  select *, n_words < {rules.min_words} or 100 * n_repeat_words > {rules.max_repeat_percent} * n_words as base_failed,
         list_concat(found, [greatest(0, n_words - list_sum(found))]) as word_counts
  from counted
), refs0 as (
  select list_transform(c, lambda x: x / list_sum(c)) as c, list_transform(w, lambda x: x / list_sum(w)) as w
  from (select [{class_sums}] as c, [{word_sums}] as w from features
        where lang in ('de', 'en', 'es', 'fr') and n_words >= {rules.min_words} group by lang)
), near as (
  select *, case when {compared} then {distance("class_counts", "c", "refs0")} + {distance("word_counts", "w", "refs0")} end as distance
  from features f
), refs as (
  select list_transform(c, lambda x: x / list_sum(c)) as c, list_transform(w, lambda x: x / list_sum(w)) as w
  from (select [{class_sums}] as c, [{word_sums}] as w from near
        where lang in ('de', 'en', 'es', 'fr') and n_words >= {rules.min_words}
          and not coalesce(distance > {limit}, false) group by lang)
), judged as (
  select *, case when {compared} then {distance("class_counts", "c", "refs")} + {distance("word_counts", "w", "refs")} end as distance
  from features f
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not (n_words >= {rules.min_words} and coalesce(distance > {limit}, false)) as kept
from judged
"""


QUALITY = _quality()

NEAR_DUPLICATES = f"""
with recursive docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as words
  from documents
), sets as (
  select doc_id, case when len(words) = 0 then []::varchar[]
           when len(words) < 5 then [array_to_string(words, ' ')]
           else list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) end as s
  from docs
), items as (select doc_id, unnest(s) as x from sets),
rare as (
  select doc_id, x, row_number() over (partition by doc_id order by df, x) as place, n
  from (select doc_id, x, count(*) over (partition by x) as df, count(*) over (partition by doc_id) as n from items)
), prefix as (select doc_id, x, n from rare where place <= n - ceil(n * 0.75) + 1),
pairs as (
  select distinct a.doc_id as u, b.doc_id as v from prefix a join prefix b on a.x = b.x and a.doc_id < b.doc_id
  where 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
), links as (
  select u, v from (
    select p.u, p.v, len(a.s) as na, len(b.s) as nb, len(list_intersect(a.s, b.s)) as shared
    from pairs p join sets a on a.doc_id = p.u join sets b on b.doc_id = p.v)
  where 100 * shared >= 75 * (na + nb - shared)
), both_ways as (select u, v from links union all select v, u from links),
reach as (
  select doc_id as node, doc_id as root from sets
  union
  select e.v, r.root from reach r join both_ways e on e.u = r.node
), component as (select node, min(root) as component_id from reach group by node)
select s.doc_id, len(s.s)::bigint as n_shingles, c.component_id, s.doc_id = c.component_id as kept
from sets s join component c on c.node = s.doc_id
"""

TOP_K = """
with quantised as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v
  from embeddings
  where embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
), scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from quantised q join quantised c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id
), ranked as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

LINE_RUNS = f"""
with split as (
  select doc_id, text, string_split(text, chr(10)) as lines from documents
), numbered as (
  select doc_id, n - 1 as n, lines[n] as line, len(regexp_extract_all(lines[n], '{WORD}')) as words
  from (select doc_id, lines, unnest(range(1, len(lines) + 1)) as n from split)
), placed as (
  select doc_id, n, line, words, (row_number() over w - 1)::int as pos, sum(words) over w as upto
  from numbered where words > 0 window w as (partition by doc_id order by n)
), spans as (
  select a.doc_id, a.pos as first, min(b.pos) as last from placed a join placed b
    on a.doc_id = b.doc_id and b.pos >= a.pos and b.upto - a.upto + a.words >= 50 group by all
  union
  select b.doc_id, max(a.pos) as first, b.pos as last from placed a join placed b
    on a.doc_id = b.doc_id and b.pos >= a.pos and b.upto - a.upto + a.words >= 50 group by all
), contents as (
  select s.doc_id, s.first, s.last, string_agg(p.line, chr(10) order by p.pos) as content
  from spans s join placed p on p.doc_id = s.doc_id and p.pos between s.first and s.last group by all
), later as (
  select doc_id, first, last from contents qualify row_number() over (partition by content order by doc_id, first) > 1
), gone as (
  select distinct p.doc_id, p.n, p.pos from later l join placed p on p.doc_id = l.doc_id and p.pos between l.first and l.last
), grouped as (
  select doc_id, n, pos - row_number() over (partition by doc_id order by pos) as island from gone
), islands as (
  select doc_id, min(n) as a, max(n) as b from grouped group by doc_id, island
), runs as (
  select doc_id, string_agg(a || '-' || b, ',' order by a) as runs from islands group by doc_id
), left_over as (
  select k.doc_id, string_agg(k.line, chr(10) order by k.n) as text, count(*) as n
  from numbered k anti join gone g on g.doc_id = k.doc_id and g.n = k.n group by k.doc_id
)
select d.doc_id, case when d.text is null then null else coalesce(o.text, '') end as text,
       (select count(*) from gone g where g.doc_id = d.doc_id)::bigint as n_removed, coalesce(r.runs, '') as runs
from documents d left join left_over o on o.doc_id = d.doc_id left join runs r on r.doc_id = d.doc_id
"""

ARCHIVES = """
with pages_sha as (
  select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as h from pages
), coded as (
  select page_id, payload_bytes, h, array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0],
           lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (5 * g + 1)::int, 5))::int >> s) & 31) + 1, 1)), '')), '') as payload_digest,
         min(page_id) over (partition by h) as first
  from pages_sha
)
select page_id, payload_bytes, payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from coded
"""

COPIES = """
with even as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') as t, row_number() over () as n from documents
)
select doc_id, first_value(doc_id) over same as keep_id, count(*) over (partition by t) as group_size,
       row_number() over same = 1 as kept, sha256(t) as text_sha256
from even window same as (partition by t order by doc_id nulls last, n)
"""


def _merkle(depth: int = 20, forest_depth: int = 12) -> str:
    """The tree level by level: a tree of one node stays as it is on all further levels."""

    def climb(name: str, depth: int) -> str:
        steps = []
        for k in range(depth):
            steps.append(f"""
{name}{k + 1} as materialized (
  select tree, case when max(nodes) = 1 then 0 else pos // 3 end as pos,
         case when max(nodes) = 1 then min(h) else sha256(string_agg(h, '' order by pos)) end as h,
         ((max(nodes) + 2) // 3)::bigint as nodes
  from {name}{k} group by tree, pos // 3
)""")
        return ",".join(steps)

    def path(leaves: str, name: str, depth: int, start: str) -> str:
        steps = [start]
        for k in range(depth):
            steps.append(f"""
{leaves}{k + 1} as materialized (
  select p.row, p.tree, p.pos // 3 as pos,
         p.proof || coalesce(string_agg(n.h, '' order by n.pos) filter (n.pos <> p.pos), '') as proof,
         case when max(n.nodes) = 1 then p.h else sha256(string_agg(case when n.pos = p.pos then p.h else n.h end, '' order by n.pos)) end as h
  from {leaves}{k} p join {name}{k} n on p.tree is not distinct from n.tree and p.pos // 3 = n.pos // 3
  group by p.row, p.tree, p.pos, p.proof, p.h
)""")
        return ",".join(steps)

    def value(column: str) -> str:
        return f"coalesce(octet_length(encode({column}::varchar))::varchar || ':' || {column}::varchar, '-')"

    fields = " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    changed = " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", "replace(text, chr(10), '')"))
    steps = "flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))"
    crc = (
        f"xor(list_reduce(list_concat([4294967295::bigint], {steps}), lambda s, e: "
        "xor(xor(s, e) >> 1, case when xor(s, e) & 1 = 1 then 3988292384::bigint else 0 end)), 4294967295)"
    )
    return f"""
with leaves as materialized (
  select row_number() over () as row, doc_id, source, sha256({fields}) as leaf,
         case when {crc} % 2 = 0 then sha256({changed}) end as tampered
  from documents
), t0 as materialized (
  select source as tree, row, leaf as h, count(*) over (partition by source) as nodes, tampered,
         row_number() over (partition by source order by doc_id nulls first, leaf, row) - 1 as pos
  from leaves
), {climb("t", depth)},
f0 as materialized (
  select 0 as tree, tree as name, h, row_number() over (order by tree nulls first) - 1 as pos, count(*) over () as nodes from t{depth}
), {climb("f", forest_depth)},
{path("p", "t", depth, "p0 as materialized (select row, tree, pos, '' as proof, coalesce(tampered, h) as h from t0)")},
{path("q", "f", forest_depth, f"q0 as materialized (select p.row, 0 as tree, f.pos, p.proof, p.h from p{depth} p join f0 f on p.tree is not distinct from f.name)")}
select l.doc_id, l.leaf, s.h as subroot, r.h as root, sha256(q.proof) as proof_sha256, q.h as folded_root, q.h = r.h as verified
from leaves l join q{forest_depth} q on l.row = q.row join t{depth} s on l.source is not distinct from s.tree cross join f{forest_depth} r
"""


MERKLE = _merkle()

PHRASES = """
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents
), worded as (
  select lang, w, len(w) as size from (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces)
), totals as (
  select lang, sum(size)::bigint as n from worded group by lang
), starts as (
  select lang, w, size, unnest(range(1, size + 1)) as i from worded
), counts as (
  select lang, length, array_to_string(w[i : i + length - 1], ' ') as phrase, count(*) as f
  from starts, (values (1), (2), (3), (4), (5)) as lengths(length) where i + length - 1 <= size
  group by all having count(*) >= 100
), longer as (
  select lang, length, phrase, f, string_split(phrase, ' ') as w from counts where length > 1
), covered as (
  select distinct s.lang, s.phrase from longer s join longer b
  on s.lang = b.lang and s.length < b.length and contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ') and 100 * b.f >= 100 * s.f
), cuts as (
  select lang, phrase, f as a, k, array_to_string(w[1 : k], ' ') as head, array_to_string(w[k + 1 :], ' ') as tail
  from (select *, unnest(range(1, length)) as k from longer) anti join covered using (lang, phrase)
), scored as (
  select c.lang, c.phrase, c.a, c.k, h.f as l, t.f as r, n.n,
         ((1000::hugeint * c.a * n.n) // (h.f::hugeint * t.f))::bigint as score
  from cuts c join counts h on h.lang = c.lang and h.phrase = c.head join counts t on t.lang = c.lang and t.phrase = c.tail
  join totals n on n.lang = c.lang
), best as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from best qualify rank <= 2000
"""
