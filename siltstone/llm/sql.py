"""DuckDB SQL for the operators that SQL can express, over the whole tables."""

from siltstone.llm import rules

WORD = r"'[^\x20\x09-\x0D]+'"

OP1 = rf"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORD}) ws from documents),
s as (
  select distinct doc_id, unnest(case when len(ws) >= 5 then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) g from w),
n as (select doc_id, count(*) c from s group by 1),
links as (
  select p.a, p.b from (select x.doc_id a, y.doc_id b, count(*) c from s x join s y on x.g = y.g and x.doc_id <> y.doc_id group by 1, 2) p
  join n na on na.doc_id = p.a join n nb on nb.doc_id = p.b where 100 * p.c >= 85 * (na.c + nb.c - p.c)),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
least as (select a, min(b) m from reach group by 1)
select d.doc_id, coalesce(n.c, 0)::BIGINT as n_shingles, least(d.doc_id, coalesce(l.m, d.doc_id)) as component_id, d.doc_id = least(d.doc_id, coalesce(l.m, d.doc_id)) as kept
from documents d left join n on n.doc_id = d.doc_id left join least l on l.a = d.doc_id
"""

OP3 = """
with p as (select page_id, coalesce(html, '') h from pages),
t as (select h, max(page_id) top from p group by h),
d as (select page_id, strlen(p.h) payload_bytes, sha1(p.h) x, top from p join t on p.h = t.h),
b as (select *, array_to_string(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111', 1 + 4 * (strpos('0123456789abcdef', substr(x, i, 1)) - 1), 4)), '') bits from d)
select page_id, payload_bytes::BIGINT as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(1, 6), lambda k: case when substr(bits, 5 * j + k, 1) = '1' then (16 >> (k - 1)) else 0 end))::INT, 1)), '') as payload_digest,
  case when page_id = top then 'response' else 'revisit' end as record_type, case when page_id <> top then top end as refers_to, true as valid from b
"""

OP4 = rf"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), {WORD}) ws from documents),
u as (select doc_id, len(ws) n, ws, unnest(range(1, len(ws) + 1)) p from w),
h as (select doc_id, p, ws[p] word, case when p + 49 <= n then sha256(array_to_string(ws[p:p + 49], ' ')) end k from u),
f as (select k, min(doc_id) m from h where k is not null group by 1),
r as (select h.doc_id, h.p, word, coalesce(m < h.doc_id, false) hit from h left join f on h.k = f.k),
c as (select doc_id, p, word, max(hit::INT) over (partition by doc_id order by p rows between 49 preceding and current row) gone from r),
g as (select doc_id, sum(gone)::BIGINT n_removed, string_agg(word, ' ' order by p) filter (where gone = 0) kept from c group by 1)
select w.doc_id, len(ws)::BIGINT as n_words, coalesce(n_removed, 0)::BIGINT as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from w left join g on g.doc_id = w.doc_id
"""


def _op6() -> str:
    tests = " union all ".join(f"select '{r}' rule, {c} cut, stratum, count(*) n, count(*) filter (where 1000 * {a} > {c} * {b}) k from good group by stratum" for r, a, b in rules.RULES for c in rules.GRID[r])
    share = rules.ALPHA / len(rules.RULES)
    reason = "coalesce(" + ", ".join(f"case when 1000 * m.{a} > (select min(cut) from admitted t where t.rule = '{r}' and t.stratum = m.stratum) * m.{b} then '{r}' end" for r, a, b in rules.RULES) + ")"
    return rf"""
with w as (select doc_id, coalesce(lang, '') stratum, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), {WORD}) ws from documents),
g as (select doc_id, i, array_to_string(ws[i:i + 2], ' ') k from (select doc_id, ws, unnest(range(1, len(ws) - 1)) i from w)),
two as (select doc_id, k from g group by 1, 2 having count(*) > 1),
cover as (select doc_id, count(distinct p) c from (select g.doc_id, unnest([i, i + 1, i + 2]) p from g join two on two.doc_id = g.doc_id and two.k = g.k) group by 1),
lines as (select doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) ls from w),
m as (
  select w.doc_id, stratum, len(ws)::BIGINT n_words, length(array_to_string(ws, ''))::BIGINT word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT n_symbols,
    length(regexp_replace(t, '[^A-Z]+', '', 'g'))::BIGINT n_capitals, len(ls)::BIGINT n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT n_dup_lines, coalesce(c, 0)::BIGINT n_repeat_words
  from w join lines on lines.doc_id = w.doc_id left join cover on cover.doc_id = w.doc_id),
j as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m),
good as (select * from j where not base_failed and doc_id in (select doc_id from labels where quality = 1)),
tests as ({tests}),
strata as (select count(distinct stratum) s from good),
admitted as (
  select rule, cut, stratum from tests, strata where
  list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share!r}) + (n - i) * ln(1 - {share!r})))) <= {rules.DELTA!r} / (s * {len(rules.RULES)})),
v as (select m.*, case when base_failed then 'base' else {reason} end reason from j m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, reason is null as kept, reason, n_lines, n_capitals, stratum from v
"""


OP6 = _op6()
SQL = {"op1_minhash": OP1, "op3_warc": OP3, "op4_substring": OP4, "op6_rules": OP6}
