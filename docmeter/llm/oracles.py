"""DuckDB SQL for the contract queries that SQL can express."""

from __future__ import annotations

#: crc32 of UTF-8 bytes, by the reflected polynomial's table.
_CRC_TABLE = """crc_table as (select list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) t)"""
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(octet_length(encode(x)) ), lambda i: cast(concat('0x', substr(hex(encode(x)), 2 * i + 1, 2)) as bigint)))::bigint[],
 lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""

JUMP = f"""with recursive {_CRC_TABLE},
d as materialized (select row_number() over () r, doc_id, coalesce(text, '') x from documents),
j as (select r, n, case when doc_id is null then 0 else doc_id end::hugeint k, -1::hugeint b, 0::hugeint j from d, (select unnest([16, 17]) n)
 union all select r, n, (k * 2862933555777941757 + 1) % 18446744073709551616, j, cast(floor(cast(j + 1 as double) * (2147483648.0 / cast(((k * 2862933555777941757 + 1) % 18446744073709551616) // 8589934592 + 1 as double))) as hugeint) from j where j < n),
s as (select r, cast(max(b) filter (where n = 16) as int) shard, cast(max(b) filter (where n = 17) as int) grown_shard from j group by r),
c as (select r, doc_id, cast(octet_length(encode(x)) + 1 as bigint) size, cast({_CRC} as bigint) text_crc32 from d, crc_table)
select doc_id, size, text_crc32, 'key' law, shard, row_number() over (partition by shard order by md5(concat_ws(':', doc_id, size, text_crc32)), doc_id, size, text_crc32) - 1 slot, grown_shard from c join s using (r)"""

MIX = r"""with d as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) size from documents),
s as (select source, sum(size)::double n, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0 when 1 then 2.0 else 1.0 end w from d group by source),
o as (select *, 3 * n cap, row_number() over (order by 3 * n / w, source nulls last) k from s),
l as (select *, ((select sum(n) from s) - coalesce((select sum(cap) from o p where p.k < o.k), 0)) / (select sum(w) from o p where p.k >= o.k) lv from o),
f as (select lv from l where cap >= w * lv order by k limit 1),
t as (select source, n, case when (select lv from f) is null then cap else least(cap, w * (select lv from f)) end target from l),
p as (select doc_id, d.source, size, n, target, round(target)::bigint budget, coalesce(sum(size) over (partition by d.source order by md5(concat_ws(':', doc_id, size)), doc_id, size rows between unbounded preceding and 1 preceding), 0) before
 from d join t on d.source is not distinct from t.source)
select doc_id, size, n::bigint source_size, target, cast(case when n > 0 then budget // n::bigint else 0 end * size + greatest(0, least(size, budget - case when n > 0 then budget // n::bigint else 0 end * n::bigint - before)) as bigint) taken from p"""

VECTORS = """with recursive v as (select vec_id, label, embedding::double[] e from embeddings where label is not null and embedding is not null and len(embedding) > 0
 and list_count(embedding) = len(embedding) and len(list_filter(embedding, lambda x: isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id a, b.vec_id b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.93),
r as (select vec_id n, vec_id m from embeddings union select r.n, l.b from r join l on l.a = r.m),
c as (select n, min(m) c from r group by n), k as (select a, count(*) k from l group by a)
select vec_id, coalesce(k, 0) n_links, c component_id, vec_id = c kept from embeddings join c on n = vec_id left join k on a = vec_id"""

JACCARD = r"""with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
g as (select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i:i + 4], ' ') end g from (select doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) i from w where len(w) > 0)),
n as (select doc_id, count(*) n from g group by 1),
p as (select x.doc_id a, y.doc_id b, count(*) c from g x join g y on x.g = y.g and x.doc_id <> y.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
r as (select doc_id n, doc_id m from documents union select r.n, l.b from r join l on l.a = r.m)
select d.doc_id, coalesce(n.n, 0) n_shingles, c component_id from documents d join (select n k, min(m) c from r group by n) on k = d.doc_id left join n on n.doc_id = d.doc_id"""

_GROUP = "(cast(concat('0x', substr(h, {i}, 5)) as bigint))"
_DIGITS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
_BASE32 = "concat(" + ", ".join(f"substr({_DIGITS}, cast(({_GROUP.format(i=5 * g + 1)} >> {s}) & 31 as int) + 1, 1)" for g in range(8) for s in (15, 10, 5, 0)) + ")"

WARC = f"""with p as (select page_id, coalesce(html, '') x, sha1(coalesce(html, '')) h from pages), d as (select page_id, cast(octet_length(encode(x)) as bigint) payload_bytes, {_BASE32} payload_digest from p),
g as (select *, max(page_id) over (partition by payload_digest, payload_bytes) leader from d)
select page_id, payload_bytes, payload_digest, case when page_id = leader then 'response' else 'revisit' end record_type, case when page_id <> leader then leader end refers_to,
strftime(make_timestamp((1704067200 + page_id % 1000000000) * 1000000), '%Y%m%d%H%M%S') "timestamp" from g"""

FILTERS = r"""with d as (select doc_id, coalesce(source, '') part, coalesce(text, '') x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
l as (select doc_id, max(case when quality = 1 then 1 else 0 end) good, max(case when toxic = 1 then 1 else 0 end) toxic from labels where doc_id is not null group by doc_id),
f as (select part, coalesce(good, 0) good, coalesce(toxic, 0) toxic,
 [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 5 * length(x), regexp_matches(x, '[#$%&*|]'), coalesce(doc_id > min(doc_id) over (partition by x), false)] fails
 from d left join l using (doc_id)),
o as (select a || b || c || e || g filter_order from (values ('A'), ('B'), ('C'), ('D'), ('E')) t1(a), (values ('A'), ('B'), ('C'), ('D'), ('E')) t2(b), (values ('A'), ('B'), ('C'), ('D'), ('E')) t3(c),
 (values ('A'), ('B'), ('C'), ('D'), ('E')) t4(e), (values ('A'), ('B'), ('C'), ('D'), ('E')) t5(g) where len(list_distinct([a, b, c, e, g])) = 5),
m as (select part, fails, count(*) n, sum(good) good, sum(toxic) toxic from f group by part, fails),
s as (select part, filter_order, step, substr(filter_order, step, 1) letter, n, good, toxic, fails[ascii(substr(filter_order, step, 1)) - 64] failing,
 len(list_filter(range(1, step), lambda i: fails[ascii(substr(filter_order, i::int, 1)) - 64])) > 0 sooner, len(list_filter(fails, lambda y: y)) = 1 alone
 from m, o, (select unnest([1, 2, 3, 4, 5]) step)),
g as (select part, filter_order, step::int step, letter, coalesce(sum(n) filter (where not failing and not sooner), 0)::bigint kept, coalesce(sum(n) filter (where failing and not sooner), 0)::bigint removed,
 coalesce(sum(n) filter (where failing and sooner), 0)::bigint redundant, coalesce(sum(n) filter (where failing and alone), 0)::bigint unique_fails,
 coalesce(sum(good) filter (where failing and not sooner), 0)::bigint good_lost, coalesce(sum(toxic) filter (where failing and not sooner), 0)::bigint toxic_lost from s group by all)
select * exclude (letter), (sum(removed) over (partition by part, letter))::bigint shapley from g"""

_SAID = r"\### Assistant: </turn> ok"
#: Marks are escaped by backslashes before them and at the end of a role or text; a conversation's own marks have 15 characters.
CHAT = rf"""with c as (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') x from conversations union all select -7, 0, 'user', '{_SAID}' union all select -7, 1, 'assistant', '{_SAID}'),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, sha256(length(role)::varchar || ':' || role || x)) k from c),
e as (select *, list_sum(list_transform([role, x], lambda v: length(v) + length(regexp_extract(v, '\\*$')) + coalesce(list_sum(list_transform(regexp_extract_all(v, '\\*(</?turn>|<says>|</?chat>)'), lambda m: length(regexp_extract(m, '^\\*')) + 1)), 0))) n from o)
select conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || x || chr(10), '' order by k)) turns_sha256, coalesce(sum(length(x)) filter (where role = 'assistant'), 0)::bigint loss_chars,
sha256(coalesce(string_agg(x, '' order by k) filter (where role = 'assistant'), '')) loss_sha256, (sum(n + 20) + 15)::bigint formatted_chars from e group by conv_id"""

TRIE = rf"""with {_CRC_TABLE},
o as (select conv_id, coalesce(role, '') role, coalesce(text, '') said, row_number() over (partition by conv_id order by turn nulls first, sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) k from conversations where conv_id is not null),
c as (select conv_id, conv_id - conv_id % 20 base, ({_CRC}) % 4 h from (select distinct conv_id, conv_id::varchar x from o), crc_table),
r as (select c.conv_id, k, role, said from c join o on o.conv_id = c.base and k <= h union all select c.conv_id, k + 3, role, said from c join o on o.conv_id = c.conv_id and k > h),
t as (select *, row_number() over (partition by conv_id order by k) d, len(regexp_extract_all(said, '[^\x20\x09-\x0D]+')) w from r),
p as (select conv_id, d, w, string_agg(sha256(length(role)::varchar || ':' || role || said), '' order by d) over (partition by conv_id order by d) prefix from t union all select conv_id, 0, 0, '' from c),
n as (select d, prefix, any_value(w) w, min(conv_id) c, count(*) n from p group by d, prefix),
m as (select p.conv_id, p.d, n.c, n.n, n.w, max(p.d) over (partition by p.conv_id) d_max from p join n using (d, prefix)),
x as (select m.c, m.d, parent.c parent_c, m.n, m.w from m left join m parent on parent.conv_id = m.conv_id and parent.d = m.d - 1 where m.conv_id = m.c),
kids as (select parent_c c, d - 1 d, count(*) kids from x where d > 0 group by all),
below as (select m.c, m.d, sum((x.n - 1) * x.w) saved, count(*) filter (where kids is null) leaves from x left join kids using (c, d) join m on m.conv_id = x.c and m.d <= x.d group by m.c, m.d),
e as (select c, d, string_agg(conv_id::varchar, ',' order by conv_id) ids from m where d = d_max group by c, d)
select x.c conv_id, x.d::bigint "depth", x.parent_c parent_conv_id, x.n n_convs, coalesce(kids, 0) n_children, leaves n_leaves, saved::bigint saved_tokens, sha256(coalesce(ids, '')) ends_sha256
from x left join kids using (c, d) left join below using (c, d) left join e using (c, d)"""
