"""DuckDB SQL of those training-data queries that SQL can express."""

from __future__ import annotations

from tillstream.llm.rules import MAX_REPEATED_PERCENT, MIN_WORDS, RULES, WINDOW, stop_word_forms

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_TESTS = " and ".join([f"{m} >= {low}" for m, low, _ in RULES if low is not None] + [f"{m} <= {high}" for m, _, high in RULES if high is not None])
_STOPS = ", ".join(f"'{w}'" for w in stop_word_forms())

ORACLE: dict[str, str] = {
    "op1_jaccard_join": rf"""
with recursive w as materialized (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as materialized (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as g
  from w, unnest(generate_series(1, greatest(len(w) - 4, 1))) as t(i) where len(w) > 0),
n as materialized (select doc_id, count(*) as n from s group by doc_id),
o as materialized (select a.doc_id as a, b.doc_id as b, count(*) as o from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
l as materialized (
  select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b where 100 * o >= 75 * (x.n + y.n - o)),
e as materialized (select a, b from l union all select b, a from l),
r(d, m) as (select doc_id, doc_id from documents union select r.d, e.b from r join e on e.a = r.m)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c.m as component_id
from documents d left join n on n.doc_id = d.doc_id join (select d, min(m) as m from r group by d) c on c.d = d.doc_id
""",
    "op8_rules": rf"""
with w as materialized (
  select doc_id, coalesce(text, '') as text, {_WORDS} as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: len(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) > 0) as lines,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as solid from documents),
g as materialized (
  select doc_id, i, array_to_string(w[i : i + {WINDOW - 1}], ' ') as g from w, unnest(generate_series(1, len(w) - {WINDOW - 1})) as t(i)),
p as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from g) where c > 1),
k as (select doc_id, least({WINDOW}, i - lag(i, 1, i - {WINDOW}) over (partition by doc_id order by i)) as k from p),
r as (select doc_id, sum(k) as n_repeat_words from k group by doc_id),
m as (
  select w.doc_id, len(w)::bigint as n_words, length(solid)::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    len(lines) as n_lines, length(regexp_replace(solid, '\P{{L}}+', '', 'g')) as letters, length(regexp_replace(solid, '\P{{Lu}}+', '', 'g')) as capitals,
    len(list_filter(w, lambda x: x in ({_STOPS}))) as stops
  from w left join r on r.doc_id = w.doc_id),
v as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words as base_failed,
    coalesce(word_chars / nullif(n_words, 0), 0) as mean_word_chars, coalesce(n_symbols / nullif(n_words, 0), 0) as symbols_per_word,
    coalesce(letters / nullif(word_chars, 0), 0) as letters_per_char, coalesce(stops / nullif(n_words, 0), 0) as stop_word_share,
    coalesce(n_dup_lines / nullif(n_lines, 0), 0) as dup_line_share, coalesce(capitals / nullif(letters, 0), 0) as capital_share from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and {_TESTS} as kept from v
""",
    "op13_divergence": r"""
with d as materialized (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
t as materialized (select r, lang, source, unnest(w) as term from d),
k as materialized (select lang, term, count(*) as n from t group by all having count(distinct r) >= 10),
c as materialized (select lang, source, term, count(*) as n from t join k using (lang, term) group by all),
v as (select lang, count(*) as v, sum(n) as n_all from k group by lang),
s as (select lang, source, sum(n) as n from c group by all),
g as materialized (
  select lang, source, coalesce(v, 0) as v, coalesce(n_all, 0) as n_all, coalesce(s.n, 0) as n
  from (select distinct lang, source from d) left join v using (lang) left join s using (lang, source)),
f as materialized (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (g.n + 2 * g.v)::hugeint as p,
    1 + (1000000000::hugeint * (k.n + 2)) // (g.n_all + 2 * g.v)::hugeint as q
  from g join k on k.lang = g.lang left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
x as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from f a join f b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join x on x.lang = a.lang and x.source = a.source and x.item = b.source),
terms as (
  select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // (p + q))::bigint as value from f where n > 0 and p > q)
select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank
from (select * from pairs union all select * from terms) qualify part = 'pair' or rank <= 10
""",
    "op11_prefix_trie": r"""
with t as materialized (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first) as i,
    {'role': coalesce(role, ''), 'text': coalesce(text, '')} as m from conversations where conv_id is not null),
h as materialized (
  select c, (xor(4294967295, list_reduce(
      list_concat([4294967295], flatten(list_transform(string_split(c::varchar, ''), lambda x: [ord(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, (a & 1) * 3988292384) end)) % 4)::int as h
  from (select distinct c from t)),
r as (
  select h.c, 0 as kind, i, m from h join t on t.c = h.c - h.c % 20 and i <= h
  union all select h.c, 1, i, m from h join t on t.c = h.c and i > h),
l as materialized (select h.c, coalesce(list(m order by kind, i) filter (m is not null), []) as l from h left join r on r.c = h.c group by h.c),
p as materialized (
  select c, d, d = len(l) as ends, case when d > 0 then l[:d] else [] end as k, case when d > 0 then l[:d - 1] end as up,
    case when d > 0 then len(regexp_extract_all(l[d].text, '[^\x20\x09-\x0D]+')) else 0 end as w
  from l, unnest(generate_series(0, len(l))) as g(d)),
n as materialized (
  select k, d, any_value(up) as up, min(c) as c, count(*) as n, (count(*) - 1) * any_value(w) as v,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '')) as e from p group by k, d),
u as (select up as k, d - 1 as d, count(*) as n_children from n where d > 0 group by up, d),
s as (
  select case when g.a > 0 then n.k[:g.a] else [] end as k, g.a as d, sum(v) as v, count(*) filter (u.n_children is null) as leaves
  from n left join u on u.k = n.k and u.d = n.d, unnest(generate_series(0, n.d)) as g(a) group by 1, 2)
select n.c as conv_id, n.d as depth, o.c as parent_conv_id, n.n as n_convs, coalesce(u.n_children, 0) as n_children, s.leaves as n_leaves,
  s.v::bigint as saved_tokens, n.e as ends_sha256
from n join s on s.k = n.k and s.d = n.d left join u on u.k = n.k and u.d = n.d left join n o on o.k = n.up and o.d = n.d - 1
""",
}
