"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

from almoner.llm.secrets import ACCESS, ASSIGN, CANDIDATE, HEX

#: Words as the operators take them.
WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: n log2 n in millionths for the counts of a window.
_BITS = "cast(round(n * log2(n) * 1000000) as bigint)"


def _matches(kind: str, rank: int, pattern: str, group: str = "0") -> str:
    """Rows (doc_id, start, rank, stop, kind, found, inner) of all matches: gaps and matches alternate."""
    return f"""
  select doc_id, list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda m: length(m))), 0) as start,
         {rank} as rank, start + length(found[i]) as stop, '{kind}' as kind, found[i] as found, inners[i] as inner_
  from (select doc_id, found, inners, gaps, unnest(range(1, len(found) + 1)) as i from (
    select doc_id, regexp_extract_all(t, $re${pattern}$re$) as found, regexp_extract_all(t, $re${pattern}$re$, {group}) as inners, regexp_split_to_array(t, $re${pattern}$re$) as gaps
    from texts where regexp_matches(t, $re${pattern}$re$)))"""


ORACLE = {
    "op4_near_vectors": """
with recursive v as (
  select row_number() over () as r, vec_id, label, cast(embedding as double[]) as e from embeddings
), good as (
  select * from v where label is not null and len(e) > 0 and list_bool_and(list_transform(e, lambda x: x is not null and isfinite(x))) and list_bool_or(list_transform(e, lambda x: x <> 0))
), pairs as (
  select a.r as a, b.r as b from good a join good b on a.label = b.label and len(a.e) = len(b.e) and a.r <> b.r where list_cosine_similarity(a.e, b.e) >= 0.93
), reach as (
  select a, b from pairs union select x.a, p.b from reach x join pairs p on x.b = p.a
), least as (
  select x.a as r, min(v.vec_id) as m from reach x join v on v.r = x.b group by 1
), links as (
  select a as r, count(*) as n from pairs group by 1
)
select vec_id, coalesce(n, 0) as n_links, least(coalesce(m, vec_id), vec_id) as component_id, least(coalesce(m, vec_id), vec_id) = vec_id as kept
from v left join links using (r) left join least using (r)
""",
    "op6_secrets": f"""
with texts as (
  select doc_id, coalesce(text, '') as t from documents
), base as (
  select * from ({_matches("assign", 1, ASSIGN, "2")}) where length(inner_) >= 12
  union all {_matches("access", 2, ACCESS)}
  union all {_matches("hex", 3, HEX)}
), candidates as (
  select *, case when regexp_full_match(found, '[0-9a-fA-F]+') then 3.0 when regexp_full_match(found, '[A-Za-z0-9]+') then 3.7 else 3.9 end as need
  from ({_matches("entropy", 4, CANDIDATE)})
  where regexp_matches(found, '[0-9]') and regexp_matches(found, '[A-Za-z]')
    and not regexp_matches(found, '^[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}$')
    and len(list_distinct(string_split(trim(found, '-_=+/'), ''))) > 1
    and not regexp_matches(lower(found), 'example|sample|placeholder|changeme|dummy|xxxx')
    and not regexp_matches(found, '^/*([a-z]+[/_-])+[a-z0-9]{{0,12}}$')
), chars as (
  select doc_id, start, w, c, count(*) as n
  from (select doc_id, start, w, unnest(string_split(found[w:w + 19], '')) as c from (select doc_id, start, found, unnest(range(1, length(found) - 18)) as w from candidates))
  group by all
), hot as (
  select doc_id, start, min(s) as low from (select doc_id, start, w, sum({_BITS}) as s from chars group by all) group by all
), spans as (
  select doc_id, start, rank, stop, kind from base
  union all
  select doc_id, start, rank, stop, kind from candidates c join hot using (doc_id, start)
  where 86438562 - low >= cast(round(need * 20 * 1000000) as bigint)
    and not exists (select 1 from base b where b.doc_id = c.doc_id and b.start <= c.start and b.stop >= c.stop)
), told as (
  select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) filter (kind <> 'entropy') as base,
         string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) as spans
  from spans group by doc_id
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join told using (doc_id)
""",
    "op7_mixing": """
with recursive docs as (
  select doc_id, lang, source, case when s = 0 then 'web' when s < 10 then 'reference' else 'forum' end as domain,
         coalesce(lang, '(none)') as l, coalesce(source, '(none)') as src, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r]+')) as tokens, md5(coalesce(text, '')) as tie
  from (select *, try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) as s from documents)
), leaves as (
  select domain, l, src, sum(tokens) as tokens, sum(tokens) * 2.0::double as capacity from docs group by all
), domains as (
  select domain, sum(capacity) as capacity, case domain when 'web' then 4.0 else 3.0 end::double as weight, floor((select sum(tokens) from leaves) * 70 / 100)::double as budget
  from leaves group by all
), d1 as (
  select *, (budget - coalesce(sum(capacity) over before, 0)) / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as lev
  from domains window before as (order by capacity / weight, domain rows between unbounded preceding and 1 preceding)
), d2 as (
  select domain, case when capacity <= weight * lev then capacity else weight * max(case when not capacity <= weight * lev then lev end) over () end as given from d1
), langs as (
  select domain, l, sum(capacity) as capacity, case l when 'en' then 5.0 when 'fr' then 2.0 when 'de' then 2.0 else 1.0 end::double as weight from leaves group by all
), l1 as (
  select *, (budget - coalesce(sum(capacity) over before, 0)) / (sum(weight) over (partition by domain) - coalesce(sum(weight) over before, 0)) as lev
  from (select langs.*, d2.given as budget from langs join d2 using (domain)) window before as (partition by domain order by capacity / weight, l rows between unbounded preceding and 1 preceding)
), l2 as (
  select domain, l, case when capacity <= weight * lev then capacity else weight * max(case when not capacity <= weight * lev then lev end) over (partition by domain) end as given from l1
), s1 as (
  select *, (budget - coalesce(sum(capacity) over before, 0)) / (sum(weight) over (partition by domain, l) - coalesce(sum(weight) over before, 0)) as lev
  from (select leaves.*, 1.0::double as weight, l2.given as budget from leaves join l2 using (domain, l))
  window before as (partition by domain, l order by capacity / weight, src rows between unbounded preceding and 1 preceding)
), s2 as (
  select domain, l, src, tokens, case when capacity <= weight * lev then capacity else weight * max(case when not capacity <= weight * lev then lev end) over (partition by domain, l) end as given from s1
), parts as (
  select domain, l, src, case when tokens = 0 then 2 else least(floor(given / tokens), 2) end::int as epochs, given - epochs * tokens as part from s2
), ordered as (
  select d.*, epochs, part,
         sum(d.tokens) over (partition by domain, l, src order by md5('20/' || epochs || '/' || coalesce(doc_id::varchar, '')), d.tokens, tie rows between unbounded preceding and current row) - d.tokens as begins
  from docs d join parts using (domain, l, src)
), taken as (
  select *, epochs + case when begins < part then 1 else 0 end as times from ordered
)
select doc_id, domain, lang, source, cast(unnest(range(0, times)) as int) as epoch from taken where times > 0
""",
    "op8_chat_formatting": r"""
with turns as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -1, n, case n when 0 then 'user' else 'assistant' end, '<|im_end|><|im_start|>assistant ok' from range(2) t(n)
), sides as (
  select *, lag(role) over w is distinct from role or row_number() over w = 1 as opens,
         lead(role) over w is distinct from role or row_number() over (partition by conv_id order by turn desc, role desc, text desc) = 1 as closes,
         length(text) + len(regexp_extract_all(text, '<\\*\|')) as n
  from turns window w as (partition by conv_id order by turn, role, text)
)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(n + case when opens then 13 + length(role) else 11 end + case when closes then 11 else 0 end)::bigint as formatted_chars
from sides group by conv_id
""",
    "op9_jaccard_join": f"""
with recursive words as (
  select doc_id, {WORDS} as w from documents
), sets as (
  select doc_id, case when len(w) >= 5 then list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))))
                      when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s
  from words
), reps as (
  select s, min(doc_id) as rep, count(*) as copies, len(s) as n from sets where len(s) > 0 group by s
), one as (
  select rep, copies, n, unnest(s) as g from reps
), pairs as (
  select a.rep as a, b.rep as b, any_value(b.copies) as copies
  from one a join one b on a.g = b.g and a.rep <> b.rep
  group by a.rep, b.rep having 5 * count(*) >= 4 * (any_value(a.n) + any_value(b.n) - count(*))
), reach as (
  select a, b from pairs union select r.a, p.b from reach r join pairs p on r.b = p.a
), classes as (
  select rep, least(rep, coalesce(min(b), rep)) as class_id from reps left join reach on rep = a group by rep
), links as (
  select rep, any_value(r.copies) - 1 + coalesce(sum(p.copies), 0) as n_links from reps r left join pairs p on r.rep = p.a group by rep
)
select doc_id, cast(coalesce(class_id, doc_id) as bigint) as class_id, cast(coalesce(n_links, 0) as bigint) as n_links,
       cast(len(sets.s) as bigint) as n_shingles
from sets left join reps on sets.s = reps.s left join classes using (rep) left join links using (rep)
""",
    "op10_decontamination": f"""
with docs as (
  select doc_id, {WORDS} as w from documents
), items as (
  select item_id, {WORDS} as w from benchmark
), item_windows as (
  select distinct item_id, least(len(w), 10) as size, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) as g
  from items where len(w) > 0
), sizes as (
  select distinct size from item_windows
), doc_windows as (
  select doc_id, size, unnest(range(1, len(w) - size + 2)) as pos, w from docs, sizes where len(w) >= size
), hits as (
  select d.doc_id, d.pos, d.size, i.item_id
  from (select doc_id, size, pos, array_to_string(w[pos:pos + size - 1], ' ') as g from doc_windows) d
  join item_windows i on d.g = i.g and d.size = i.size
), covered as (
  select doc_id, count(distinct place) as n from (select doc_id, unnest(range(pos, pos + size)) as place from hits) group by doc_id
), named as (
  select doc_id, list_sort(list(distinct cast(item_id as varchar))) as ids from hits group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_hit, cast(coalesce(len(ids), 0) as bigint) as n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) as items_sha256, n is not null as contaminated
from docs left join covered using (doc_id) left join named using (doc_id)
""",
    "op13_prefix_trie": """
with turns as (
  select conv_id, turn, octet_length(encode(coalesce(text, ''))) as bytes,
         sha256(octet_length(encode(coalesce(role, '')))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as told
  from conversations where conv_id is not null
), ranked as (
  select *, row_number() over (partition by conv_id order by turn nulls first, told) as i from turns
), convs as (
  select conv_id, conv_id - conv_id % 5 as base, count(*) as own,
         xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
                         lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)),
             4294967295) % 9 as h
  from ranked group by conv_id
), steps as (
  select c.conv_id, i as p, told, bytes from convs c join ranked r on r.conv_id = c.base and i <= h
  union all
  select c.conv_id, i - c.h + least(c.h, coalesce(b.own, 0)), told, bytes
  from convs c join ranked r on r.conv_id = c.conv_id left join convs b on b.conv_id = c.base where i > c.h
), paths as (
  select conv_id, p as depth, bytes, string_agg(told, '') over (partition by conv_id order by p) as path from steps
  union all select conv_id, 0, 0, '' from convs
), whole as (
  select *, max(depth) over (partition by conv_id) as size, lag(path) over (partition by conv_id order by depth) as above from paths
), nodes as (
  select path, any_value(above) as above, min(conv_id) as conv_id, any_value(depth) as depth, count(*) as n_convs, any_value(bytes) as bytes, max(size) = any_value(depth) as leaf,
         coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (size = depth), '') as ends
  from whole group by path
), kids as (
  select above as path, count(*) as n_children from nodes where depth > 0 group by above
), sums as (
  select t.path, sum(leaf::int) as n_leaves, sum((n_convs - 1) * m.bytes) as saved
  from nodes m join whole t on t.conv_id = m.conv_id and t.depth <= m.depth group by t.path
)
select n.conv_id, n.depth::bigint as depth, u.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves::bigint as n_leaves,
       saved::bigint as saved_tokens, sha256(n.ends) as ends_sha256
from nodes n join sums using (path) left join kids using (path) left join nodes u on n.depth > 0 and u.path = n.above
""",
}
