"""The registered queries as independent DuckDB SQL, where SQL can express them."""

from __future__ import annotations

# Fixed value: the words of most operators.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = rf"""
with recursive w as (
  select doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') as words
  from documents
), s as (
  select distinct doc_id, list_slice(words, i, i + 4) as shingle
  from (select doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) as i from w where len(words) > 0)
), n as (select doc_id, count(*) as n from s group by doc_id
), pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared
  from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2
), links as (
  select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b
  where 100 * shared >= 75 * (x.n + y.n - shared)
), both_ways as (select a, b from links union select b, a from links
), reach as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, e.b from reach r join both_ways e on r.b = e.a
), groups as (select a as doc_id, min(b) as component_id from reach group by a)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, g.component_id, d.doc_id = g.component_id as kept
from documents d left join n using (doc_id) join groups g using (doc_id)
"""

OP9 = rf"""
with w as (select doc_id, {WORDS} as words from documents
), win as (
  select doc_id, i, list_slice(words, i, i + 12) as key
  from (select doc_id, words, unnest(range(1, len(words) - 11)) as i from w where len(words) >= 13)
), firsts as (select key, min(doc_id) as first from win group by key
), gone as (
  select distinct doc_id, unnest(range(i, i + 13)) as i
  from win join firsts using (key) where first < doc_id
), kept as (
  select w.doc_id, w.i, w.word
  from (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as i from w) w
  left join gone using (doc_id, i) where gone.i is null
), texts as (
  select doc_id, string_agg(word, ' ' order by i) as kept, count(*) as n from kept group by doc_id
)
select w.doc_id, len(words)::bigint as n_words, (len(words) - coalesce(n, 0))::bigint as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from w left join texts using (doc_id)
"""


OP1_RULES = (
    ("assign", """(?i)(password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("repository_token", r"gh[opsu]_[A-Za-z0-9]{30,}", 0, 1),
    ("chat_token", r"xox[abps]-[A-Za-z0-9-]{10,}", 0, 1),
    ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
)
_OP1_EACH = " union all ".join(
    f"""
  select doc_id, {rank} as rank, '{kind}' as kind, unnest(string_split_regex(t, '{pattern}')) as gap,
    unnest(regexp_extract_all(t, '{pattern}', 0) || ['']) as found,
    unnest(regexp_extract_all(t, '{pattern}', {group}) || ['']) as own,
    unnest(range(len(regexp_extract_all(t, '{pattern}', 0)) + 1)) as i, {least} as least
  from d"""
    for rank, (kind, pattern, group, least) in enumerate(OP1_RULES)
)
OP1 = f"""
with d as (select doc_id, coalesce(text, '') as t from documents
), parts as ({_OP1_EACH}
), placed as (
  select *, sum(length(gap) + length(found)) over (partition by doc_id, rank order by i) as stop from parts
), spans as (
  select doc_id, rank, kind, (stop - length(found))::bigint as start, stop::bigint as stop
  from placed where length(own) >= least and found <> ''
), per_doc as (
  select doc_id, count(*) filter (rank = 0) as n_assign, count(*) filter (rank = 1) as n_access,
    count(*) filter (rank = 2) as n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) filter (rank < 3) as base,
    string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) as spans
  from spans group by doc_id
)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
  coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join per_doc using (doc_id)
"""

_OP2_WORDS = rf"regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP2 = f"""
with items as (select item_id, {_OP2_WORDS} as words from benchmark
), item_windows as (
  select distinct item_id, size, list_slice(words, i, i + size - 1) as win from (
    select item_id, words, least(len(words), 10) as size, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as i
    from items where len(words) > 0)
), w as (select doc_id, {_OP2_WORDS} as words from documents
), sizes as (select distinct size from item_windows
), doc_windows as (
  select doc_id, size, i, list_slice(words, i, i + size - 1) as win
  from (select doc_id, words, size, unnest(range(1, len(words) - size + 2)) as i
        from w, sizes where len(words) >= size)
), hits as (
  select doc_id, item_id, i, d.size from doc_windows d join item_windows b on d.size = b.size and d.win = b.win
), covered as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + size)) as p from hits) group by 1
), found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from hits) group by 1
)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join covered using (doc_id) left join found using (doc_id)
"""

OP6_FROM = """
with recursive sizes as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size
  from {table}
), totals as (select source, sum(size)::bigint as source_size from sizes group by source
), ranked as (
  select *, ((row_number() over (order by source is null, source) - 1) % 3 + 1)::bigint as weight,
    3 * source_size as cap from totals
), placed as (
  select *, row_number() over r as place,
    sum(source_size) over () - coalesce(sum(cap) over (r rows between unbounded preceding and 1 preceding), 0) as rest,
    sum(weight) over () - coalesce(sum(weight) over (r rows between unbounded preceding and 1 preceding), 0) as others
  from ranked window r as (order by cap::double / weight::double, source is null, source)
), level as (
  select place as p, rest, others from placed where cap * others >= rest * weight order by place limit 1
), targets as (
  select source, source_size,
    case when place < p then cap::double else (weight * level.rest)::double / level.others::double end as target,
    greatest(least(source_size // 256, 32), 1)::bigint as block
  from placed, level
), facts as (
  select *, ceil(source_size / block)::bigint as blocks, target / block::double as slots from targets
), edges as (
  select *, floor(sum(slots) over (o rows between unbounded preceding and current row)
      / sum(slots) over (o rows between unbounded preceding and unbounded following) * 1099511627776.0)::bigint as upper
  from facts where slots > 0 window o as (order by source is null, source)
), shares as (
  select *, lag(upper, 1, 0) over (order by source is null, source) as lower from edges
), slots as (
  select slot, ((slot::hugeint * 679535556991) % 1099511627776)::bigint as point
  from (select unnest(range((select ceil(sum(slots))::bigint from facts))) as slot)
), chosen as (
  select source, blocks, row_number() over (partition by source order by slot) - 1 as rank
  from slots join shares on point >= lower and point < upper
), times as (
  select source, rank % blocks as number, count(*) as times from chosen where rank < 3 * blocks group by 1, 2
), laid as (
  select s.doc_id, s.source, s.size, f.source_size, f.target, f.block,
    sum(size) over (partition by s.source order by md5(coalesce(s.doc_id::varchar, '')), s.doc_id, size
      rows between unbounded preceding and current row) - size as start
  from sizes s join facts f on s.source is not distinct from f.source
), pieces as (
  select *, unnest(range((start // block)::bigint, ((start + size - 1) // block + 1)::bigint)) as number from laid where size > 0
), taken as (
  select p.doc_id, p.source, p.start,
    sum((least(start + size, (p.number + 1) * block) - greatest(start, p.number * block)) * coalesce(times, 0)) as taken
  from pieces p left join times t on t.source is not distinct from p.source and t.number = p.number group by 1, 2, 3
)
select l.doc_id, l.source, l.size, l.source_size, l.target, coalesce(t.taken, 0)::bigint as taken
from laid l left join taken t on l.size > 0 and t.doc_id is not distinct from l.doc_id
  and t.source is not distinct from l.source and t.start = l.start
"""
OP6 = OP6_FROM.format(table="documents")

OP7 = """
with p as (
  select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest
  from pages
), f as (select *, min(page_id) over (partition by payload_digest) as first from p)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes < 100 or page_id = first then 'response' else 'revisit' end as record_type,
  case when payload_bytes < 100 or page_id = first then null else first end as refers_to
from f
"""

_ESCAPED = r"replace(replace(replace({}, '\', '\\'), '<', '\('), '[', '\{{')"
OP10 = f"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(23 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}))::bigint as formatted_chars
from c group by conv_id
"""

OP11 = """
with d as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
    sha256('1:' || coalesce(doc_id::varchar, '')) as digest from documents
), h as (
  select doc_id, t, u, len(u) as n, ('0x' || substr(digest, 1, 8))::bigint as h1, ('0x' || substr(digest, 9, 8))::bigint as h2,
    ('0x' || substr(digest, 17, 8))::bigint as h3, ('0x' || substr(digest, 25, 8))::bigint as h4 from d
), c as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as low, greatest(h1 % (n + 1), h2 % (n + 1)) as high,
    case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end as form from h
), parts as (
  select *, array_to_string(list_slice(u, 1, low), '') as p, array_to_string(list_slice(u, low + 1, high), '') as m,
    array_to_string(list_slice(u, high + 1, n), '') as s from c
)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(p)::bigint end as prefix_chars,
  case when form <> 'plain' then length(m)::bigint end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from parts
"""

OP12 = """
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings
  where vec_id is not null and len(embedding) > 0 and not list_bool_or(list_transform(embedding, lambda x: x is null or not isfinite(x)))
    and list_bool_or(list_transform(embedding, lambda x: x <> 0))
), links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.9
), reach as (
  select vec_id as a, vec_id as b from v union select r.a, l.b from reach r join links l on l.a = r.b
), groups as (select a as vec_id, min(b) as component_id from reach group by a
), counts as (select a as vec_id, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, coalesce(component_id, vec_id) as component_id,
  coalesce(component_id, vec_id) is not distinct from vec_id as kept
from embeddings left join groups using (vec_id) left join counts using (vec_id)
"""

OP13 = rf"""
with pieces as (
  select lang, row_number() over () as piece, words from (
    select coalesce(lang, 'und') as lang,
      unnest(string_split_regex({LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) as t from documents),
    lateral (select regexp_extract_all(t, '[^\x20\x09]+') as words)
), w as (
  select lang, unnest(words) as w1, unnest(words[2:] || [null]) as w2, unnest(words[3:] || [null, null]) as w3
  from (select lang, words from pieces where len(words) > 0)
), f1 as (select lang, w1, count(*) as f from w where w1 is not null group by all
), n as (select lang, sum(f) as n from f1 group by lang
), f2 as (select lang, w1, w2, count(*) as a from w where w2 is not null group by all having a >= 10
), f3 as (select lang, w1, w2, w3, count(*) as a from w where w3 is not null group by all having a >= 10
), s2 as (
  select f2.lang, f2.w1 || ' ' || f2.w2 as phrase, f2.a, x.f as l, y.f as r,
    (1000000::hugeint * f2.a * f2.a) // (x.f::hugeint * y.f) as score
  from f2 join f1 x on x.lang = f2.lang and x.w1 = f2.w1 join f1 y on y.lang = f2.lang and y.w1 = f2.w2
  where not exists (
    select 1 from f3 where f3.lang = f2.lang and f3.w1 = f2.w1 and f3.w2 = f2.w2 and 100 * f3.a >= 50 * f2.a
  ) and not exists (
    select 1 from f3 where f3.lang = f2.lang and f3.w2 = f2.w1 and f3.w3 = f2.w2 and 100 * f3.a >= 50 * f2.a)
), c3 as (
  select f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 as phrase, f3.a,
    x.f as l1, q.a as r1, p.a as l2, z.f as r2,
    (1000000::hugeint * f3.a * f3.a) // (x.f::hugeint * q.a) as k1,
    (1000000::hugeint * f3.a * f3.a) // (p.a::hugeint * z.f) as k2
  from f3 join f1 x on x.lang = f3.lang and x.w1 = f3.w1 join f1 z on z.lang = f3.lang and z.w1 = f3.w3
    join f2 p on p.lang = f3.lang and p.w1 = f3.w1 and p.w2 = f3.w2
    join f2 q on q.lang = f3.lang and q.w1 = f3.w2 and q.w2 = f3.w3
), scored as (
  select * from s2 union all
  select lang, phrase, a, case when k1 <= k2 then l1 else l2 end, case when k1 <= k2 then r1 else r2 end, least(k1, k2) from c3
)
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from scored)
join n using (lang) where rank <= 2000
"""

ORACLE = {
    "op1_secret_scan": OP1,
    "op2_decontamination": OP2,
    "op5_near_duplicates": OP5,
    "op6_source_mix": OP6,
    "op7_web_archive": OP7,
    "op9_substring_dedup": OP9,
    "op10_chat_format": OP10,
    "op11_fill_in_middle": OP11,
    "op12_near_vectors": OP12,
    "op13_phrases": OP13,
}
