"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = "'[^\\x20\\x09-\\x0D]+'"
_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_LINES = f"""d as (select doc_id, source, coalesce(text, '') as text, string_split(coalesce(text, ''), chr(10)) as ls from documents),
l as (select doc_id, source, u.pos, u.line, trim(translate(u.line, {_ASCII}), {_BLANKS}) as key
  from (select doc_id, source, unnest(list_transform(ls, lambda x, i: {{'pos': i, 'line': x}})) as u from d))"""

OP1 = f"""with {_LINES},
w as (select doc_id, regexp_extract_all(text, {_WORD}) as ws, text, ls from d),
g as (select doc_id, unnest(range(1, len(ws) - 1)) as i, ws from w where len(ws) >= 3),
t as (select doc_id, i, count(*) over (partition by doc_id, ws[i], ws[i + 1], ws[i + 2]) as n from g),
r as (select doc_id, count(distinct i + k) as n from t, (values (0), (1), (2)) as o(k) where t.n > 1 group by doc_id),
s as (select doc_id, list_filter(ls, lambda x: trim(x, {_BLANKS}) <> '') as own from d),
b as (select w.doc_id, cast(len(ws) as bigint) as n_words,
    cast(list_sum(list_transform(ws, lambda x: length(x))) as bigint) as word_chars,
    cast(length(text) - length(translate(text, '#*$%&|<>', '')) as bigint) as n_symbols,
    cast(len(own) - len(list_distinct(own)) as bigint) as n_dup_lines,
    cast(coalesce(r.n, 0) as bigint) as n_repeat_words
  from w join s using (doc_id) left join r using (doc_id)),
f as (select source, key, count(distinct doc_id) as n from l where length(key) >= 10 group by source, key),
z as (select source, count(distinct doc_id) as n from documents group by source),
o as (select f.source, f.key from f join z on f.source is not distinct from z.source where f.n > 10 or f.n >= 3 and f.n > z.n * 0.5),
lost as (select doc_id, sum(len(regexp_extract_all(line, {_WORD}))) as n
  from l join o on l.key = o.key and l.source is not distinct from o.source group by doc_id),
c as (select b.*, n_words - coalesce(lost.n, 0) as n_left, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed
  from b left join lost using (doc_id))
select doc_id, n_words, coalesce(word_chars, 0) as word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and n_left >= 50 and n_left >= n_words * 0.3 as kept from c"""

_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((cast('0x' || substr(h, {5 * j + 1}, 5) as bigint) >> {s}) & 31), 1)"
                     for j in range(8) for s in (15, 10, 5, 0))

OP3 = f"""with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h,
  max(page_id) over (partition by coalesce(html, '')) as last from pages)
select page_id, cast(strlen(html) as bigint) as payload_bytes, {_BASE32} as payload_digest,
  case when page_id = last then 'response' else 'revisit' end as record_type,
  case when page_id <> last then last end as refers_to from p"""

OP4 = f"""with {_LINES},
k as (select key, min(doc_id) as first from l where length(key) >= 10 group by key having count(distinct doc_id) >= 2)
select l.doc_id, cast(count(*) as bigint) as n_lines,
  cast(count(*) filter (k.first < l.doc_id) as bigint) as n_dropped,
  sha256(coalesce(string_agg(l.line, chr(10) order by l.pos) filter (k.first is null or k.first >= l.doc_id), '')) as kept_sha256
from l left join k using (key) group by l.doc_id"""

OP7 = f"""with d as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), {_WORD})) as bigint) as size from documents),
s as (select source, sum(size) as n, row_number() over (order by source nulls last) - 1 as no from d group by source),
w as (select *, cast(1 + no % 3 as double) as weight, 3 * n as cap from s),
a as (select *, sum(n) over () as total, sum(weight) over () as all_w,
    coalesce(sum(cap) over before, 0) as fixed, coalesce(sum(weight) over before, 0) as used
  from w window before as (order by cap / weight, no rows between unbounded preceding and 1 preceding)),
v as (select arg_min((total - fixed) / (all_w - used), cap / weight)
    filter (cap >= (total - fixed) / (all_w - used) * weight) as level from a),
t as (select source, n, least(cast(cap as double), level * weight) as target from w, v),
p as (select doc_id, size, cast(n as bigint) as n, target, cast(floor(target + 0.5) as bigint) as take,
    coalesce(sum(size) over (partition by d.source order by md5(doc_id || ':mix'), doc_id
      rows between unbounded preceding and 1 preceding), 0) as start
  from d join t on d.source is not distinct from t.source)
select doc_id, size, n as source_size, target,
  cast(case when n = 0 then 0
    else take // n * size + greatest(0, least(start + size, take % n) - start) end as bigint) as taken from p"""

OP10 = """with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5"""

_UNIT = "'[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+'"

OP12 = f"""with d as (select doc_id, coalesce(text, '') as text, sha256('42:' || doc_id) as h from documents),
u as (select *, regexp_extract_all(text, {_UNIT}) as us, {', '.join(
    f"cast('0x' || substr(h, {8 * i + 1}, 8) as bigint) as h{i + 1}" for i in range(4))} from d),
n as (select *, cast(len(us) as bigint) as n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) as a,
    greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) as b from u),
c as (select *, array_to_string(us[1:a], '') as p, array_to_string(us[a + 1:b], '') as m, array_to_string(us[b + 1:], '') as s,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
      when h4 % 100 < 80 then 'spm' else 'psm' end as form from n)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
  case when form <> 'plain' then length(m) end as middle_chars, sha256(case form when 'plain' then text
    when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(text) as restored_sha256 from c"""

OP13 = f"""with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), {_WORD}) as ws,
    min(doc_id) over (partition by coalesce(text, '')) as first from documents),
l as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
f as (select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    cast(len(ws) < 200 as int) + 2 * cast(100 * len(list_distinct(ws)) < 50 * len(ws) as int)
    + 4 * cast(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) as int)
    + 8 * cast(regexp_matches(text, '[#$%&*|]') as int) + 16 * cast(first < doc_id as int) as mask
  from d left join l using (doc_id)),
c as (select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from f group by all),
x as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as v(name, bit)),
o as (select a.name || b.name || c.name || d.name || e.name as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from x a, x b, x c, x d, x e where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s as (select filter_order, k as step, bits[k] as own, cast(coalesce(list_sum(bits[1:k - 1]), 0) as int) as earlier
  from o, unnest([1, 2, 3, 4, 5]) as t(k))
select part, filter_order, step, {', '.join(f'cast(coalesce(sum({v}) filter ({w}), 0) as bigint) as {a}' for a, v, w in (
    ('kept', 'n', 'mask & (own | earlier) = 0'), ('removed', 'n', 'mask & own <> 0 and mask & earlier = 0'),
    ('redundant', 'n', 'mask & own <> 0 and mask & earlier <> 0'), ('unique_fails', 'n', 'mask = own'),
    ('good_lost', 'good', 'mask & own <> 0 and mask & earlier = 0'),
    ('toxic_lost', 'toxic', 'mask & own <> 0 and mask & earlier = 0'),
    ('shapley', 'n * (120 // greatest(bit_count(mask), 1))', 'mask & own <> 0')))}
from c, s group by part, filter_order, step"""

ORACLES = {"op1_quality_rules": OP1, "op3_warc": OP3, "op4_line_dedup": OP4, "op7_mixing": OP7, "op10_exact_top_k": OP10,
           "op12_fill_in_middle": OP12, "op13_filter_audit": OP13}
