"""DuckDB SQL of the queries that SQL can express."""

ORACLE_SQL: dict[str, str] = {}

#: Words of every document in order, A-Z folded.
_WORDS = r"""
words as (
  select doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents)"""

ORACLE_SQL["op2_ngram_jaccard"] = f"""
with recursive {_WORDS},
spread as (
  select doc_id, case when len(w) = 0 then []
                      when len(w) < 5 then [array_to_string(w, ' ')]
                      else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) end as s
  from words),
sizes as (select doc_id, len(s)::bigint as n from spread),
grams as (select doc_id, unnest(s) as g from spread),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id
  group by 1, 2),
links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * common >= 80 * (x.n + y.n - common)),
edges as (select a, b from links union all select b, a from links),
reach(doc_id, other) as (
  select doc_id, doc_id from sizes
  union
  select reach.doc_id, edges.b from reach join edges on edges.a = reach.other)
select doc_id, n as n_shingles, (select min(other) from reach where reach.doc_id = sizes.doc_id) as component_id
from sizes
"""

#: Schedules by place: 1.5 to 0.5, level, 0.5 to 1.5; all have an integral of 1.
ORACLE_SQL["op9_mix_sources"] = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5(coalesce(doc_id::varchar, '')) as ord
  from documents),
sources as (
  select source, sum(size)::bigint as s, row_number() over (order by source nulls last) - 1 as place
  from sized group by source),
weighed as (select *, 3 * s as cap, [1, 2, 3][(place % 3 + 1)::int] as w from sources),
filled as (
  select *, (sum(s) over () - coalesce(sum(cap) over prior, 0))::double as room,
         (sum(w) over () - coalesce(sum(w) over prior, 0))::double as weights
  from weighed
  window prior as (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding)),
judged as (select *, cap * weights <= room * w as at_cap from filled),
targets as (
  select source, s, place,
         case when at_cap then cap::double
              else (select arg_max(room / weights, weights) from judged where not at_cap) * w end as target
  from judged),
spread as (
  select doc_id, size, s, place, target, case when s > 0 then floor(target / s) else 0 end as passes,
         coalesce(sum(size) over (partition by sized.source order by ord, size rows between unbounded preceding and 1 preceding), 0) as here
  from sized join targets on sized.source is not distinct from targets.source),
counted as (
  select *, passes + case when here + size / 2.0 < target - passes * s then 1 else 0 end as times, here / target as u
  from spread)
select doc_id, size, s as source_size, target, (size * times)::bigint as taken,
       round(case when times < 1 then null else least(1.0, case place % 3
         when 0 then u * 2 / (sqrt(greatest(1.5 * 1.5 + u * (2 * -1.0), 0)) + 1.5)
         when 1 then u * 2 / (sqrt(greatest(1.0 + u * 0, 0)) + 1)
         else u * 2 / (sqrt(greatest(0.5 * 0.5 + u * (2 * 1.0), 0)) + 0.5) end) end, 9) as position
from counted
"""

_EXACT_WORDS = r"""
split as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents)"""

ORACLE_SQL["op4_substring_dedup"] = f"""
with {_EXACT_WORDS},
starts as (select doc_id, w, unnest(range(1, len(w) - 48)) as i from split where len(w) >= 50),
windows as (select doc_id, i, md5(array_to_string(w[i:i+49], ' ')) as h from starts),
firsts as (select h, min(doc_id) as f from windows group by h having count(distinct doc_id) > 1),
gone as (
  select distinct doc_id, unnest(range(i, i + 50)) as p from windows join firsts on windows.h = firsts.h
  where doc_id > f),
spread as (select doc_id, unnest(range(1, len(w) + 1)) as p, unnest(w) as word from split),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by p) as body
  from spread anti join gone using (doc_id, p) group by doc_id)
select split.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(body, '')) as kept_sha256
from split left join kept on split.doc_id = kept.doc_id
"""

#: 5-word shingles in order, repeats kept; ``{{name}}``, ``{{id}}`` and ``{{table}}`` are filled in.
_SHINGLES = r"""
{name}_words as (
  select {id} as id, list_filter(string_split_regex(lower(coalesce(text, '')), '{gap}'), lambda w: w <> '') as w
  from {table}),
{name} as (
  select id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                  else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) end as s
  from {name}_words)"""

ORACLE_SQL["op1_decontaminate"] = f"""
with {_SHINGLES.format(name="docs", id="doc_id", table="documents", gap="[ \\t-\\r]+")},
{_SHINGLES.format(name="items", id="item_id", table="benchmark", gap="[ \\t-\\r]+")},
doc_grams as (select id, unnest(s) as g, unnest(range(1, len(s) + 1)) as at from docs),
item_grams as (select id, len(s) as length, unnest(s) as g from items),
counted as (select id, g, count(*) as wanted from item_grams group by 1, 2),
starts as (
  select distinct d.id as doc, i.id as item, i.length, greatest(least(d.at, len(s) - i.length + 1), 1) as start
  from doc_grams d join item_grams i on d.g = i.g join docs on docs.id = d.id),
held as (
  select doc, item, start, length, g, count(*) as times
  from (select doc, item, start, length, unnest(s[start:start + length - 1]) as g from starts join docs on docs.id = doc) x
  group by all),
sizes as (select doc, item, start, length, sum(times) as n from held group by all),
common as (
  select doc, item, start, sum(least(times, wanted)) as common
  from held join counted on counted.id = held.item and counted.g = held.g group by all),
judged as (
  select doc, item, common::bigint as common, (n + length - common)::bigint as total
  from common join sizes using (doc, item, start))
select doc as doc_id, item as item_id, arg_max(common, common / total) as common, arg_max(total, common / total) as total
from judged where 100 * common >= 80 * total group by all
"""


def _license_sql() -> str:
    from finspark.llm.license_scan import TEMPLATES
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    listed = ", ".join(f"({i}, {quoted(a)}, {quoted(b)}, {quoted(t)})" for i, (a, b, t) in enumerate(TEMPLATES))
    gap = r"[^\p{{L}}\p{{N}}]+".format()
    return f"""
with texts(number, license, template, text) as (values {listed}),
{_SHINGLES.format(name="docs", id="doc_id", table="documents", gap=gap)},
{_SHINGLES.format(name="wanted", id="number", table="texts", gap=gap)},
known as (select id, list_distinct(s) as s, len(list_distinct(s)) as m from wanted),
places as (
  select docs.id as doc, known.id as number, m, known.s as t, docs.s as s, unnest(range(0, len(docs.s), m)) as start
  from docs join known on list_has_any(docs.s, known.s)),
judged as (
  select doc, number, m, len(list_intersect(s[start + 1:start + 2 * m], t)) as common from places)
select doc as doc_id, license, template, max(common)::int as common, m::int as size
from judged join texts using (number) where 100 * common >= 80 * m group by all
"""


ORACLE_SQL["op10_license_scan"] = _license_sql()


def _centroid_rounds(k: int, rounds: int) -> str:
    """Rounds as one table each: distances of all vectors to all centroids, then floored means."""
    found = """assigned{r} as (
  select i, vec_id, v, arg_min(n, {{'d': d, 'n': n}}) as c, min(d) as d from (
    select i, vec_id, v, n, list_sum(list_transform(list_zip(v, x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
    from kept, centroids{r}) group by i, vec_id, v)"""
    moved = """centroids{s} as (
  select n, coalesce(mean, x) as x from centroids{r} left join (
    select c as n, list((s - ((s % m) + m) % m) // m order by j) as mean from (
      select c, j, sum(y)::bigint as s, count(*) as m from (select c, unnest(v) as y, unnest(range(len(v))) as j from assigned{r})
      group by c, j) group by c) using (n))"""
    return ",\n".join(x for r in range(rounds) for x in (found.format(r=r), moved.format(r=r, s=r + 1))) + ",\n" + found.format(r=rounds)


ORACLE_SQL["op11_centroids"] = f"""
with kept as (
  select row_number() over () as i, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x) and abs(x::double) * 256 < 16777216)) = 64),
centroids0 as (
  select row_number() over (order by h, v) - 1 as n, v as x
  from (select *, sha256('2:' || vec_id) as h from kept where vec_id is not null) qualify n < 40),
{_centroid_rounds(40, 5)},
sums as (select c, sum(d)::bigint as cluster_inertia from assigned5 group by c)
select vec_id, c::int as cluster, d as distance, cluster_inertia, (select sum(d)::bigint from assigned5) as inertia,
       sha256(array_to_string(x, ',')) as centroid_sha256
from assigned5 join sums using (c) join centroids5 on n = c
"""

#: CRC-32 of decimal numbers, bit by bit.
_CRC = """xor(4294967295::ubigint, list_reduce(list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::ubigint),
    lambda a, x: list_reduce(range(8)::ubigint[], lambda b, i: xor(b >> 1, case when b & 1 = 1 then 3988292384 else 0 end::ubigint), xor(a, x)),
    4294967295::ubigint))"""

ORACLE_SQL["op13_prefix_trie"] = rf"""
with own as (
  select conv_id as c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
  from conversations where conv_id is not null group by conv_id),
shifted as (select c, turns, ({_CRC} % 4)::bigint as h from own),
built as (
  select s.c, list_concat(coalesce(b.turns[1:s.h], []), s.turns[s.h + 1:]) as turns
  from shifted s left join own b on b.c = s.c - s.c % 20),
members as (
  select c, depth, turns[1:depth] as node, depth = len(turns) as ends
  from (select c, turns, unnest(range(len(turns) + 1)) as depth from built)),
nodes as (
  select node, depth, min(c) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where ends), '')) as ends_sha256,
         case when depth = 0 then 0 else (count(*) - 1)
           * len(list_filter(string_split_regex(node[depth].t, '[\x20\x09-\x0D]+'), lambda w: w <> '')) end as saved
  from members group by node, depth),
kids as (select node[1:depth - 1] as node, count(*) as n_children from nodes where depth > 0 group by 1),
totals as (
  select node, sum(leaf)::bigint as n_leaves, sum(saved)::bigint as saved_tokens from (
    select n.node[1:d] as node, (k.node is null)::int as leaf, saved
    from (select *, unnest(range(depth + 1)) as d from nodes) n left join kids k on k.node = n.node)
  group by node)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0)::bigint as n_children,
       n_leaves, saved_tokens, n.ends_sha256
from nodes n join totals using (node) left join kids using (node)
left join nodes p on p.depth = n.depth - 1 and p.node = n.node[1:n.depth - 1]
"""
