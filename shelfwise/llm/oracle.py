"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

OP3_URL_REPUTATION = r"""
with parts as (
  select page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path,
    trim(regexp_replace(html, '(?s)<script\b.*?</script>|<style\b.*?</style>|<[^>]*>', ' ', 'g')) as body
  from pages),
labelled as (
  select *, case when length(body) > 0 then
      100 * (length(body) - length(translate(body, '#*$%&|<>', ''))) > 50 * len(string_split_regex(body, '[ \t\n\x0B\f\r]+')) end as bad
  from parts),
rules(action, target) as (values ('allow', 'com/'), ('block', 'example.com/en/'), ('allow', 'www.example.com/en/'), ('block', 'net/es/'), ('block', 'net/fr/')),
ruled as (
  select l.*, (select max_by(target || '>' || action, length(target)) from rules r
               where (l.host = split_part(target, '/', 1) or ends_with(l.host, '.' || split_part(target, '/', 1)))
                 and starts_with(l.path, substr(target, strpos(target, '/')))) as fit
  from labelled l),
bare as (
  select host, count(bad) as n, coalesce(sum(bad::int), 0) as k,
    string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':\d*$', ''), '.') as labels
  from labelled group by host),
hosts as (
  select host, n, k,
    case when regexp_matches(array_to_string(labels, '.'), '^\d+(\.\d+){3}$') then array_to_string(labels, '.')
         when len(labels) >= 3 and labels[-2] in ('ac','co','com','edu','gov','net','org') and length(labels[-1]) = 2 then array_to_string(labels[-3:], '.')
         else array_to_string(labels[-2:], '.') end as domain,
    case when regexp_matches(array_to_string(labels, '.'), '^\d+(\.\d+){3}$') then ''
         when len(labels) >= 3 and labels[-2] in ('ac','co','com','edu','gov','net','org') and length(labels[-1]) = 2 then array_to_string(labels[-2:], '.')
         else labels[-1] end as suffix
  from bare),
total as (select coalesce(sum(n), 0) as n, coalesce(sum(k), 0) as k from hosts),
s0 as (select suffix, sum(h.n) as n, sum(h.k) as k, any_value(t.k) + 1.0::double as a, any_value(t.n - t.k) + 1.0::double as b from hosts h, total t group by suffix),
s1 as (select *, (a - k) / (a + b - n) as up, a + b - n as held from s0),
s_rho as (select sum((k - n * up) * (k - n * up) - n * up * (1 - up)) / nullif(sum(n::double * (n - 1) * up * (1 - up)), 0) as rho from s1),
s_str as (select case when rho > 0 then least(greatest(1 / rho - 1, 2), 1000) else 1000 end as m from s_rho),
s2 as (select s1.* exclude (a, b), least(m, held) * up + k as a, least(m, held) * (1 - up) + n - k as b from s1, s_str),
d0 as (select domain, suffix, sum(h.n) as n, sum(h.k) as k, any_value(a) as a, any_value(b) as b from hosts h join s2 using (suffix) group by domain, suffix),
d1 as (select *, (a - k) / (a + b - n) as up, a + b - n as held from d0),
d_rho as (select sum((k - n * up) * (k - n * up) - n * up * (1 - up)) / nullif(sum(n::double * (n - 1) * up * (1 - up)), 0) as rho from d1),
d_str as (select case when rho > 0 then least(greatest(1 / rho - 1, 2), 1000) else 1000 end as m from d_rho),
d2 as (select d1.* exclude (a, b), least(m, held) * up + k as a, least(m, held) * (1 - up) + n - k as b from d1, d_str),
h0 as (select host, h.n, h.k, a, b from hosts h join d2 using (domain)),
h1 as (select *, (a - k) / (a + b - n) as up, a + b - n as held from h0),
h_rho as (select sum((k - n * up) * (k - n * up) - n * up * (1 - up)) / nullif(sum(n::double * (n - 1) * up * (1 - up)), 0) as rho from h1),
h_str as (select case when rho > 0 then least(greatest(1 / rho - 1, 2), 1000) else 1000 end as m from h_rho),
h2 as (select h1.* exclude (a, b), least(m, held) * up + k as a, least(m, held) * (1 - up) + n - k as b from h1, h_str),
verdicts as (select host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5 as blocked from h2)
select page_id, r.host, path, nullif(split_part(coalesce(fit, ''), '>', 1), '') as rule,
  case when fit is not null then split_part(fit, '>', 2) when blocked then 'block' else 'allow' end as verdict
from ruled r join verdicts v on r.host = v.host
"""

_OP9_JUDGED = r"""
docs as (select row_number() over () as rid, doc_id, coalesce(source, '') as host, coalesce(text, '') as body from documents),
w as (select *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from docs),
windows as (select rid, i, list_aggregate(words[i:i + 4], 'string_agg', chr(10)) as g
    from (select rid, words, unnest(range(1, len(words) - 3)) as i from w where len(words) >= 5)),
twice as (select rid, unnest(p) as i from (select rid, list(i) as p from windows group by rid, g having count(*) > 1)),
covered as (select rid, count(distinct p) as c from (select rid, unnest(range(i, i + 5)) as p from twice) group by rid),
counted as (
  select rid, doc_id, host, len(words) as n_words,
    length(translate(body, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) as word_chars,
    length(body) - length(translate(body, '#*$%&|<>', '')) as n_symbols,
    len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(c, 0) as n_repeat_words
  from w left join covered using (rid)),
judged as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    100 * n_symbols > 50 * n_words or 100 * n_dup_lines > 50 * n_lines as hint_failed,
    base_failed or hint_failed as failed
  from counted),
hosts as (select host, count(*) as n, count(*) filter (failed) as k from judged group by host),
sums as (select count(*) as h, sum(n)::double as n, sum(k)::double as k, sum(n::double * n) as n2, sum(k::double * k / n) as k2 from hosts),
moments as (
  select h, k / n as rate, k / n * (1 - k / n) as spread,
    (k2 - k * k / n) / nullif(h - 1, 0) - k / n * (1 - k / n) as between_, (n - n2 / n) / nullif(h - 1, 0) - 1 as scale from sums),
prior as (
  select rate, case when h < 2 or spread = 0 or scale <= 0 or between_ <= 0 then 10000
    else least(greatest(spread / (between_ / scale) - 1, 2), 10000) end as m from moments),
post as (select host, rate * m + k as a, (1 - rate) * m + n - k as b from hosts, prior),
verdicts as (
  select host, a / (a + b) as mean, 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as margin,
    mean - margin <= 0.5 as host_ok, mean + margin < 0.01 as host_trusted from post)
"""

OP9_HOST_RULES = f"""
with {_OP9_JUDGED}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and host_ok and (not hint_failed or host_trusted) as kept
from judged join verdicts using (host)
"""


_OP11_START = """
kept as materialized (
  select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
c0 as materialized (
  select row_number() over (order by sha256('3:' || coalesce(vec_id::varchar, '')), v) - 1 as c, v
  from kept qualify c < 8)"""


def _op11_assign(r: int) -> str:
    return f"""
a{r} as materialized (
  select rid, any_value(vec_id) as vec_id, any_value(k.v) as v,
    min(list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i])))::hugeint * 8 + c.c) as best
  from kept k, c{r} c group by rid)"""


def _op11_move(r: int) -> str:
    return f"""
m{r} as (
  select best % 8 as c, i, sum(v[i]) as s, count(*) as n
  from (select best, v, unnest(range(1, 65)) as i from a{r}) group by all),
l{r} as (select c, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as v from m{r} group by c),
c{r + 1} as materialized (select c{r}.c, coalesce(l{r}.v, c{r}.v) as v from c{r} left join l{r} on l{r}.c = c{r}.c)"""


OP11_CENTROID_CLUSTERING = (
    f"with {_OP11_START}, "
    + ", ".join(_op11_assign(r) + ", " + _op11_move(r) for r in range(10))
    + f", {_op11_assign(10)}"
    + """,
found as (select vec_id, (best % 8)::int as cluster, (best // 8)::bigint as distance from a10)
select vec_id, cluster, distance, (sum(distance) over (partition by cluster))::bigint as cluster_inertia,
  (sum(distance) over ())::bigint as inertia, sha256(array_to_string(c10.v, ',')) as centroid_sha256
from found join c10 on c10.c = cluster
"""
)

OP12_CONVERSATION_TRIE = r"""
with t as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, md5(length(role) || ':' || role || ':' || text)) as r,
    md5(length(role) || ':' || role || ':' || text) as digest, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)),
c as (
  select conv_id, conv_id - conv_id % 20 as base,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
      lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, z: xor(x >> 1, (x & 1) * 3988292384::bigint))), 4294967295) % 4 as h
  from (select distinct conv_id from t)),
heads as (select c.conv_id, r, digest, words from c join t on t.conv_id = base and r <= h),
rebuilt as (
  select conv_id, r as pos, digest, words from heads
  union all
  select c.conv_id, r - h + coalesce(m, 0), digest, words from t join c using (conv_id)
    left join (select conv_id, count(*) as m from heads group by 1) using (conv_id) where r > h),
whole as (
  select conv_id, coalesce(len(d), 0) as n, coalesce(d, []) as d, coalesce(w, []) as w
  from c left join (select conv_id, list(digest order by pos) as d, list(words order by pos) as w from rebuilt group by 1) using (conv_id)),
p as materialized (
  select conv_id, n, depth, md5(array_to_string(d[1:depth], ',')) as key, case when depth > 0 then w[depth] else 0 end as words
  from (select *, unnest(range(0, n + 1)) as depth from whole)),
nodes as materialized (
  select depth, key, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (n = depth), '')) as ends_sha256
  from p group by depth, key),
parents as materialized (
  select c.depth, c.key, u.conv_id as parent_conv_id, u.key as up
  from nodes c join p on p.conv_id = c.conv_id and p.depth = c.depth - 1 join nodes u on u.depth = p.depth and u.key = p.key),
kids as materialized (select depth - 1 as depth, up as key, count(*) as n_children from parents group by all),
below as (
  select p.depth, p.key, sum((u.n_convs - 1) * u.words) as saved, count(*) filter (k.n_children is null) as leaves
  from nodes u left join kids k on k.depth = u.depth and k.key = u.key
    join p on p.conv_id = u.conv_id and p.depth <= u.depth group by all)
select v.conv_id, v.depth::bigint as depth, parent_conv_id, n_convs, coalesce(n_children, 0) as n_children,
  leaves as n_leaves, saved::bigint as saved_tokens, ends_sha256
from nodes v join below b on b.depth = v.depth and b.key = v.key
  left join kids k on k.depth = v.depth and k.key = v.key
  left join parents u on u.depth = v.depth and u.key = v.key
"""

OP13_SOURCE_MIX = r"""
with d as materialized (
  select row_number() over () as rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    md5('13:' || coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')) as shuffled
  from documents),
s as (
  select source, sum(size)::bigint as source_size, 3 * sum(size)::double as cap, row_number() over (order by source nulls last) as place
  from d group by source),
w as (select *, (place - 1) % 3 + 1 as weight from s),
l as (
  select *, (select sum(source_size)::double from s) - coalesce(sum(cap) over before, 0) as rest,
    (select sum(weight) from w) - coalesce(sum(weight) over before, 0) as open_
  from w window before as (order by cap / weight, place rows between unbounded preceding and 1 preceding)),
level as (select rest, open_ from l where cap / weight * open_ >= rest order by cap / weight, place limit 1),
targets as materialized (
  select source, source_size, place, least(cap, coalesce((select rest from level) * weight / (select open_ from level), cap))::double as target from w),
queue as (
  select rid, size, place, source_size, target, shuffled,
    sum(size) over (partition by place order by shuffled, rid) as upto
  from d join targets t on t.source is not distinct from d.source where size > 0),
copies as (
  select rid, size, place, epoch, shuffled, ((epoch - 1) * source_size + upto) / target as finish
  from queue, (select unnest([1, 2, 3]) as epoch) where (epoch - 1) * source_size + upto - size < target),
served as (
  select rid, size, sum(size) over (order by finish, place, epoch, shuffled, rid rows between unbounded preceding and current row) as spent from copies),
taken as (select rid, sum(size)::bigint as words from served where spent <= (select sum(source_size) from s) group by rid)
select doc_id, size, source_size, target, coalesce(words, 0) as taken
from d join targets t on t.source is not distinct from d.source left join taken using (rid)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_url_reputation": OP3_URL_REPUTATION,
        "op9_host_rules": OP9_HOST_RULES,
        "op11_centroid_clustering": OP11_CENTROID_CLUSTERING,
        "op12_conversation_trie": OP12_CONVERSATION_TRIE,
        "op13_source_mix": OP13_SOURCE_MIX,
    }
