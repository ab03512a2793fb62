"""DuckDB oracle for the knowledge-base queries.

The chunker is a recursive CTE that walks every document's lines one step
per iteration; TF-IDF, search, rerank and answers are plain SQL on top.
"""

from __future__ import annotations

from oracle.duckdb_sql import Q

WS = (r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
      r"\x{3000}]")
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


CORPUS = """
select doc_id, concat_ws('/', source, lang, 'doc-' || cast(doc_id as varchar) || '.md') as source_file,
  '# ' || source || chr(10) || text as text
from documents"""

SPAN = "struct(s integer, e integer, sec varchar)"

CHUNKS = f"""
with recursive corpus as ({CORPUS}),
docs as (
  select doc_id, source_file, lines, len(lines) as n, list_transform(lines, lambda x: length(x) + 1) as lens
  from (select doc_id, source_file,
          case when parts[len(parts)] = '' then parts[1:len(parts) - 1] else parts end as lines
        from (select doc_id, source_file, regexp_split_to_array(text, '{BREAK}') as parts from corpus) p) q
),
fold(source_file, i, bs, cl, sec, out) as (
  select source_file, 0, 1, 0, 'root', cast([] as {SPAN}[]) from docs
  union all
  select source_file, i1,
    case when is_full and i1 < n then ov_s when is_full then i1 + 1 else bs1 end,
    case when is_full and i1 < n then list_sum(lens[ov_s:i1]) when is_full then 0 else cl1 end,
    sec1,
    case when is_full then list_append(out1, {{'s': bs1, 'e': i1, 'sec': sec1}}::{SPAN}) else out1 end
  from (
    select *, cl1 >= 900 as is_full,
      coalesce(list_max(list_filter(range(greatest(1, i1 - 119), i1 + 1), lambda k: list_sum(lens[k:i1]) >= 120)), 1)
        as ov_s
    from (
      select f.source_file, d.n, d.lens, f.i + 1 as i1,
        case when pf then list_append(f.out, {{'s': f.bs, 'e': f.i, 'sec': f.sec}}::{SPAN}) else f.out end as out1,
        case when pf then f.i + 1 else f.bs end as bs1,
        (case when pf then 0 else f.cl end) + d.lens[f.i + 1] as cl1,
        case when is_h then coalesce(nullif({strip(f"regexp_replace({strip('line')}, '^#+', '')")}, ''), 'root')
             else f.sec end as sec1
      from (
        select f0.*, d0.lines[f0.i + 1] as line,
          regexp_matches(d0.lines[f0.i + 1], '^{WS}*#') as is_h,
          regexp_matches(d0.lines[f0.i + 1], '^{WS}*#') and f0.bs <= f0.i and f0.cl >= 540 as pf
        from fold f0 join docs d0 on f0.source_file = d0.source_file
        where f0.i < d0.n
      ) f join docs d on f.source_file = d.source_file
    ) s1
  ) s2
),
spans as (
  select f.source_file, d.doc_id, d.lines,
    case when f.bs <= d.n then list_append(f.out, {{'s': f.bs, 'e': d.n, 'sec': f.sec}}::{SPAN}) else f.out end
      as spans
  from fold f join docs d on f.source_file = d.source_file and f.i = d.n
),
texts as (
  select source_file, doc_id, ord, sp.s as start_line, sp.e as end_line, sp.sec as section,
    {strip("array_to_string(lines[sp.s:sp.e], chr(10))")} as text
  from (select source_file, doc_id, lines, unnest(spans) as sp, unnest(range(1, len(spans) + 1)) as ord
        from spans) u
),
indexed as (
  select *, row_number() over (partition by source_file order by ord) - 1 as chunk_index
  from texts where text <> ''
)
select source_file || ':' || cast(chunk_index as varchar) as chunk_id, text, source_file, section,
  cast(start_line as integer) as start_line, cast(end_line as integer) as end_line,
  doc_id, chunk_index
from indexed where length(text) >= 80"""


def _wrap(body: str, final: str) -> str:
    return f"with kb_chunks as ({body}\n),\n{final}"


TERMS = """
chunk_terms as (
  select chunk_id, ('0x' || substr(md5(tok), 1, 15))::bigint as bucket, count(*) as tf
  from (select chunk_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) as tok from kb_chunks) t
  group by 1, 2
),
idf as (
  select bucket, ln((1 + (select count(*) from kb_chunks)) / (1 + count(*))) + 1 as idf
  from chunk_terms group by bucket
),
chunk_w as (
  select chunk_id, bucket, cast(round(w / sqrt(sum(w * w) over (partition by chunk_id)) * 1073741824) as bigint) as units
  from (select chunk_id, bucket, tf * idf as w from chunk_terms join idf using (bucket)) x
),
queries as (
  select item_id as query_id, text as query_text from benchmark
  union all select -1, 'how is churn calculated'
),
query_w as (
  select query_id, bucket, cast(round(w / sqrt(sum(w * w) over (partition by query_id)) * 1073741824) as bigint) as units
  from (select query_id, bucket, tf * idf as w
        from (select query_id, ('0x' || substr(md5(tok), 1, 15))::bigint as bucket, count(*) as tf
              from (select query_id, unnest(regexp_extract_all(lower(query_text), '[a-z0-9]+')) as tok
                    from queries) qt group by 1, 2) q
        join idf using (bucket)) x
),
search as (
  select * from (
    select query_id, chunk_id, cast(units as double) / 1152921504606846976.0::double as raw,
      round(cast(units as double) / 1152921504606846976.0::double, 5) as score,
      row_number() over (partition by query_id order by units desc, doc_id asc, chunk_index asc) as search_rank
    from (select q.query_id, c.chunk_id, any_value(k.doc_id) as doc_id, any_value(k.chunk_index) as chunk_index,
            sum(c.units * q.units) as units
          from chunk_w c join query_w q on c.bucket = q.bucket join kb_chunks k on c.chunk_id = k.chunk_id
          group by 1, 2) s
  ) r where search_rank <= 48
),
cand as (
  select s.*, c.text, c.source_file, c.section, c.start_line, c.end_line, q.query_text,
    lower(c.text) as text_lower, lower(q.query_text) as query_lower
  from search s join kb_chunks c on s.chunk_id = c.chunk_id join queries q on s.query_id = q.query_id
),
gated as (
  select * from cand
  where not contains(query_lower, 'churn')
     or contains(text_lower, 'churn') or contains(text_lower, 'subscription_status')
     or contains(text_lower, 'canceled') or contains(text_lower, 'cancelled')
),
reranked as (
  select * from (
    select *, round(adjusted, 5) as adjusted_score from (select *, (raw
      + case when contains(query_lower, 'how is') and contains(query_lower, 'calculated')
              and (contains(text_lower, '## purpose') or contains(text_lower, 'this document')
                   or contains(text_lower, 'these queries are not exploratory')) then -0.12 else 0.0 end
      + case when contains(query_lower, 'churn') then
          (case when ends_with(source_file, 'example_sql.md') then 0.10
                when ends_with(source_file, 'metric_definitions.md') then 0.06
                when ends_with(source_file, 'dbt_model_docs.md') then 0.04 else 0.0 end)
          + (case when contains(text_lower, '```sql') or contains(text_lower, 'select') then 0.10 else 0.0 end
             + case when contains(text_lower, '## churn') or contains(text_lower, 'churn calculation')
                    then 0.10 else 0.0 end)
        else 0.0 end) as adjusted
    from gated) y
  ) x where adjusted >= 0.30
),
deduped as (
  select * exclude (source_rank) from (
    select *, row_number() over (partition by query_id, source_file order by adjusted desc, search_rank)
      as source_rank
    from reranked) d where source_rank = 1
),
final as (
  select * from (
    select *, row_number() over (partition by query_id order by adjusted desc, search_rank) as rank
    from deduped) f where rank <= 8
)"""


def kb(final: str) -> str:
    return _wrap(CHUNKS, TERMS.strip() + "\n" + final)


Q["kb_documents"] = CORPUS
CHUNK_COLS = "chunk_id, text, source_file, section, start_line, end_line"
Q["kb_chunks"] = f"select {CHUNK_COLS} from ({CHUNKS}) c"
Q["kb_chunks_roundtrip"] = Q["kb_chunks"]
Q["kb_chunks_incremental"] = Q["kb_chunks"]
Q["kb_embed"] = kb("select chunk_id, bucket, round(units / 1073741824.0::double, 6) as weight from chunk_w")
Q["kb_search"] = kb("select query_id, chunk_id, score, search_rank from search")
Q["kb_gate"] = kb("select query_id, chunk_id, score, search_rank from gated")
Q["kb_rerank"] = kb("select query_id, chunk_id, source_file, score, adjusted_score, search_rank from reranked")
Q["kb_dedupe_source"] = kb("select query_id, chunk_id, source_file, adjusted_score, search_rank from deduped")
Q["kb_answer_sources"] = kb(f"""
select query_id, rank, printf('%.5f', adjusted_score) as score,
  printf('%s | %s | L%d-L%d', source_file, section, start_line, end_line) as citation,
  replace({strip('substring(text, 1, 350)')}, chr(10), ' ') as preview
from final""")
Q["kb_grounded_answer"] = kb("""
select q.query_id,
  case when f.has_churn is null then 'No strong matches found in the knowledge base.'
       when f.has_churn and f.has_cancel then 'Churn is calculated from subscription cancellations.' || chr(10)
         || 'A churn event occurs when a subscription has `subscription_status = canceled`.' || chr(10)
         || 'Churn tables are built from `silver_subscriptions` and exposed via `gold_churn`.'
       else 'Based on retrieved documentation, churn is defined in the knowledge base, but the exact definition '
         || 'was not strongly matched.' end as answer
from queries q left join (
  select query_id, bool_or(contains(text_lower, 'churn')) as has_churn,
    bool_or(contains(text_lower, 'canceled') or contains(text_lower, 'subscription_status')) as has_cancel
  from final group by query_id) f on q.query_id = f.query_id""")

Q["vector_topk"] = """
with cen as (
  select label, i, avg(cast(v as double)) as v
  from (select label, unnest(embedding) as v, unnest(range(1, len(embedding) + 1)) as i from embeddings) e
  group by label, i
),
q as (select cast(label as bigint) as query_id, list(v order by i) as vec from cen group by label),
qn as (select query_id, list_transform(vec, lambda x: x / sqrt(list_sum(list_transform(vec, lambda y: y * y)))) as qvec
       from q)
select * from (
  select query_id, vec_id, score,
    row_number() over (partition by query_id order by score desc, vec_id asc) as rank
  from (select qn.query_id, e.vec_id,
          round(list_dot_product(qn.qvec, cast(e.embedding as double[])), 5) as score
        from qn, embeddings e) s
) r where rank <= 48"""

Q["kb_index"] = kb("""
select k.chunk_id, k.source_file, k.section, k.start_line, k.end_line, w.terms, w.norm_sq
from kb_chunks k join (
  select chunk_id, count(*) as terms, round(sum(round(units / 1073741824.0::double, 6) * round(units / 1073741824.0::double, 6)), 4) as norm_sq
  from chunk_w group by chunk_id) w on k.chunk_id = w.chunk_id""")
