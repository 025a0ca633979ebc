"""One registered query per operator, over its whole table, and DuckDB SQL
for those that SQL can express (the others are held against brute force in
tests/llm)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dovetail.llm import (external_shuffle, filter_audit, grammar_repair, license_dice, link_graph, odd_sketch, positional_index,
                          quality_ledger, rank_array, rank_merge, secret_ledger, suffix_trees, vector_packing)
from dovetail.llm.common import table

Build = Callable[[SparkSession, str], DataFrame]

#: Words of a text in SQL.
SQL_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ledger.report(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_graph.filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_dice.scan(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_trees.deduplicate(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positional_index.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positional_index.near_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ledger.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "fail_bits")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_merge.count_tokens(table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.report(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing.pack(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return external_shuffle.report(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_array.round_trip(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grammar_repair.report(table(spark, sf_dir, "conversations"))


# ---------------------------------------------------------------- SQL

def _q(s: str) -> str:
    return s.replace("'", "''")


def _secret_sql() -> str:
    parts = []
    for k, r in enumerate(secret_ledger.RULES):
        # (?i:...) groups count as in the Spark pattern
        p = _q(r.plain or r.pattern)
        parts.append(f"""
  select doc_id, {k} as k, '{r.kind}' as kind,
    unnest(list_transform(regexp_extract_all(t, '{p}', 0), lambda x: length(x))) as m,
    unnest(list_transform(regexp_extract_all(t, '{p}', {r.group}), lambda x: length(x))) as n,
    unnest(list_transform(string_split_regex(t, '{p}')[1:len(regexp_extract_all(t, '{p}', 0))], lambda x: length(x))) as g,
    unnest(range(1, len(regexp_extract_all(t, '{p}', 0)) + 1)) as i, {r.least} as least
  from d""")
    n_base = len(secret_ledger.BASE)
    counts = ", ".join(f"count(k) filter (k = {i}) as n_{r.kind}" for i, r in enumerate(secret_ledger.BASE))
    return f"""with d as (select doc_id, coalesce(text, '') as t from documents),
raw as ({' union all '.join(parts)}),
ends as (select doc_id, k, kind, m, n, least, sum(g + m) over (partition by doc_id, k order by i) as e from raw),
spans as (select doc_id, k, kind, (e - m)::bigint as s, e::bigint as e from ends where n >= least)
select doc_id, {counts},
  sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by s, k, e) filter (k < {n_base}), '')) as base_sha256,
  coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by s, k, e), '') as spans
from d left join spans using (doc_id) group by doc_id"""


def _url_sql() -> str:
    rules = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in link_graph.RULES)
    link = _q(link_graph.LINK)
    c = link_graph.DAMPING
    steps = ""
    for i in range(link_graph.STEPS):
        steps += f""",
c{i} as (select b as host, sum(case when kind = 0 then p * trust else 0 end) as in_t,
    sum(case when kind = 1 then p * distrust else 0 end) as in_d from s{i} join mv on s{i}.host = mv.a group by b),
s{i + 1} as materialized (select s.host, n, t0, d0, gives_t, gives_d,
    {1 - c} * t0 + {c} * (coalesce(in_t, 0) + case when gives_t then 0 else trust end) as trust,
    {1 - c} * d0 + {c} * (coalesce(in_d, 0) + case when gives_d then 0 else distrust end) as distrust
    from s{i} s left join c{i} using (host))"""
    return f"""with u as (select page_id, coalesce(html, '') as html,
    case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as (select page_id, html, translate(regexp_extract(rest, '^[^/?#]*', 0), '{link_graph.A_TO_Z}', '{link_graph.A_TO_Z.lower()}') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
rules(h, pre, v) as (values {rules}),
fit as (select page_id, h || pre as rule, v, row_number() over (partition by page_id order by length(h || pre) desc) as k
    from p join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, pre)),
j as (select p.*, rule, v from p left join (select * from fit where k = 1) using (page_id)),
links as (select host as src, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{link_graph.A_TO_Z}', '{link_graph.A_TO_Z.lower()}') as dst
    from j where host <> ''),
e as (select src, dst, count(*)::double as w from links where src <> dst group by src, dst),
bi as (select src as a, dst as b, w, 0 as kind from e union all select dst, src, w, 1 from e),
mv as materialized (select a, b, kind, w / sum(w) over (partition by a, kind) as p from bi),
seeds as (select host, count(*) as n, sum(case when v = 'allow' then 1.0 else 0 end) as t0,
    sum(case when v = 'block' then 1.0 else 0 end) as d0 from j where host <> '' group by host
    union all select distinct b, 0, 0.0, 0.0 from mv),
s0 as materialized (select host, sum(n) as n, sum(t0)::double as t0, sum(d0)::double as d0,
    host in (select a from mv where kind = 0) as gives_t, host in (select a from mv where kind = 1) as gives_d,
    sum(t0)::double as trust, sum(d0)::double as distrust from seeds group by host){steps},
hv as (select host, case when (distrust - trust) / greatest(n, 1) >= {link_graph.THRESHOLD} then 'block' else 'allow' end as hv
    from s{link_graph.STEPS})
select page_id, host, path, rule, coalesce(v, hv, 'allow') as verdict from j left join hv using (host)"""


def _license_sql() -> str:
    t = license_dice.THRESHOLD
    made = [(i, x, license_dice.normal_words(x.text)) for i, x in enumerate(license_dice.templates())]
    texts = ", ".join(f"({i}, '{x.license}', '{x.name}', string_split('{' '.join(w)}', ' '))" for i, x, w in made)
    lens = ", ".join(f"({i}, {n})" for i, _, w in made for n in license_dice.lengths(len(w) - 1))

    def pairs(w: str) -> str:
        return f"unnest(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1]))"

    def apart(windows: str) -> str:
        return f"""list_reduce({windows}, lambda taken, x: case when len(list_filter(taken, lambda y: y.s <= x[1].e and x[1].s <= y.e)) > 0
        then taken else list_concat(taken, x) end)"""
    return f"""with d as (select row_number() over () as r, doc_id, list_transform(regexp_extract_all(text, '[A-Za-z0-9]+'), lambda x: lower(x)) as w
    from documents where text is not null),
g as (select r, unnest(range(0, len(w) - 1)) as p, {pairs('w')} as g from d where len(w) > 1),
tw(t, license, template, w) as (values {texts}),
tl(t, l) as (values {lens}),
tg as (select distinct t, {pairs('w')} as g from tw),
ts as (select t, count(*) as size from tg group by t),
h as (select r, t, p, g from g join tg using (g)),
able as (select r, t, size from (select r, t, count(distinct g) as c from h group by r, t) join ts using (t) where c >= ceil(size * {t} / {2 - t} - 1e-9)),
win as (select r, t, p as s, l, size from h join able using (r, t) join tl using (t)),
sh as (select r, t, s, l, count(distinct g) as k, max(p) as e from win join h using (r, t) where p >= s and p < s + l group by all),
sz as (select r, t, s, l, size, count(distinct g) as a from win join g using (r) where p >= s and p < s + l group by all),
q as (select *, 2.0::double * k / (a + size) as dice from sh join sz using (r, t, s, l) where 2.0::double * k / (a + size) >= {t}),
f1 as (select r, unnest({apart("list([{'s': s, 'e': e, 't': t, 'k': k, 'dice': dice}] order by dice desc, k desc, s, l)")}) as f from q group by r, t),
f2 as (select r, unnest({apart("list([f] order by f.k desc, f.dice desc, f.t, f.s)")}) as f from f1 group by r)
select doc_id, license, template, f.s::bigint as start_word, (f.e + 1)::bigint as end_word, f.k::bigint as shared, f.dice as dice
from f2 join d using (r) join tw on tw.t = f.t"""


def _quality_sql() -> str:
    return rf"""with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t, {SQL_WORDS} as w from documents),
ln as (select r, x from (select r, unnest(string_split(t, chr(10))) as x from d) where regexp_matches(x, '[^\x20\x09-\x0D]')),
lines as (select r, count(*) as n_lines, count(*) - count(distinct x) as n_dup_lines from ln group by r),
g as (select r, unnest(range(1, len(w) - 6)) as i, unnest(list_transform(range(1, len(w) - 6), lambda i: w[i:i + 7])) as gram from d where len(w) >= 8),
rep as (select r, i from (select r, i, count(*) over (partition by r, gram) as c from g) where c > 1),
cov as (select r, count(distinct p) as n from (select r, unnest(range(i, i + 8)) as p from rep) group by r),
m as (select doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_lines, 0) as n_lines, coalesce(n, 0)::bigint as n_repeat_words
    from d left join lines using (r) left join cov using (r)),
b as (select *, {' + '.join(f"case when {r.fails} then {1 << r.bit} else 0 end" for r in quality_ledger.RULES)} as bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & {quality_ledger.BASE}) <> 0 as base_failed,
    (bits & {quality_ledger.POLICIES[quality_ledger.CURRENT].mask}) = 0 as kept, bits::bigint as fail_bits from b"""


def _repeats_sql() -> str:
    n = suffix_trees.WINDOW
    return rf"""with d as (select doc_id, {SQL_WORDS} as w from documents),
g as (select doc_id, unnest(range(1, len(w) - {n - 2})) as i,
    unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: md5(array_to_string(w[i:i + {n - 1}], ' ')))) as h from d where len(w) >= {n}),
f as (select h, min(doc_id) as m from g group by h),
cov as (select doc_id, unnest(range(i, i + {n})) as p from g join f using (h) where doc_id > m),
c as (select doc_id, list(distinct p) as ps from cov group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(len(ps), 0)::bigint as n_removed,
    sha256(array_to_string(case when ps is null then w else list_filter(w, lambda x, i: not list_contains(ps, i)) end, ' ')) as kept_sha256
from d left join c using (doc_id)"""


def _leak_sql() -> str:
    m, az = positional_index.WINDOW, link_graph.A_TO_Z
    toks = rf"""list_filter(string_split_regex(translate(coalesce(text, ''), '{az}', '{az.lower()}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""
    return rf"""with d as (select doc_id, {toks} as w from documents),
b as (select coalesce(item_id::varchar, '') as item_id, {toks} as w from benchmark),
iw as (select distinct item_id, least(len(w), {m}) as m, unnest(list_transform(range(1, len(w) - least(len(w), {m}) + 2),
    lambda i: array_to_string(w[i:i + least(len(w), {m}) - 1], ' '))) as g from b where len(w) > 0),
ms as (select distinct m from iw),
dw as (select doc_id, m, unnest(range(1, len(w) - m + 2)) as i, unnest(list_transform(range(1, len(w) - m + 2),
    lambda i: array_to_string(w[i:i + m - 1], ' '))) as g from d, ms where len(w) >= m),
hit as (select doc_id, item_id, i, m from dw join iw using (m, g)),
n as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + m)) as p from hit) group by doc_id),
l as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (select distinct doc_id, item_id from hit) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (doc_id) left join l using (doc_id)"""


def _near_sql() -> str:
    k, t = odd_sketch.SHINGLE, odd_sketch.THRESHOLD
    low = SQL_WORDS.replace("coalesce(text, '')", f"translate(coalesce(text, ''), '{link_graph.A_TO_Z}', '{link_graph.A_TO_Z.lower()}')")
    return rf"""with recursive d as materialized (select doc_id, {low} as w from documents),
s as materialized (select distinct doc_id, unnest(case when len(w) between 1 and {k - 1} then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' ')) end) as g from d),
n as materialized (select doc_id, count(*) as n from s group by doc_id),
sets as (select doc_id, md5(string_agg(g, chr(10) order by g)) as h from s group by doc_id),
rep as materialized (select doc_id, min(doc_id) over (partition by h) as r from sets),
rs as materialized (select s.doc_id, g from s join rep using (doc_id) where r = s.doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as i from rs a join rs b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as materialized (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * i >= {t} * (x.n + y.n - i)),
e as materialized (select a as x, b as y from links union select b, a from links),
walk(x, y) as (select distinct r, r from rep union select w.x, e.y from walk w join e on e.x = w.y),
comp as (select x, min(y) as c from walk group by x)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(c, d.doc_id) as component_id, d.doc_id = coalesce(c, d.doc_id) as kept
from d left join n using (doc_id) left join rep using (doc_id) left join comp on comp.x = r"""


def _audit_sql() -> str:
    f = filter_audit.FILTERS
    orders = ", ".join(f"('{o}', {s}, {b}, {e})" for o, s, b, e in filter_audit.steps())
    return rf"""with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, {SQL_WORDS} as w from documents),
b as (select doc_id, part, t, case when len(w) < 200 then {1 << f.index('A')} else 0 end
    + case when 100 * len(list_distinct(w)) < 50 * len(w) then {1 << f.index('B')} else 0 end
    + case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) then {1 << f.index('C')} else 0 end
    + case when regexp_matches(t, '[#$%&*|]') then {1 << f.index('D')} else 0 end
    + case when min(doc_id) over (partition by t) < doc_id then {1 << f.index('E')} else 0 end as mask from d),
l as (select doc_id, max((quality is not distinct from 1)::int) as good, max((toxic is not distinct from 1)::int) as toxic
    from labels where doc_id is not null group by doc_id),
c as (select part, mask, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
    from b left join l using (doc_id) group by part, mask),
o(filter_order, step, bit, before) as (values {orders})
select part, filter_order, step::int as step,
    coalesce(sum(n) filter (mask & (before | bit) = 0), 0)::bigint as kept,
    coalesce(sum(n) filter (mask & bit <> 0 and mask & before = 0), 0)::bigint as removed,
    coalesce(sum(n) filter (mask & bit <> 0 and mask & before <> 0), 0)::bigint as redundant,
    coalesce(sum(n) filter (mask = bit), 0)::bigint as unique_fails,
    coalesce(sum(good) filter (mask & bit <> 0 and mask & before = 0), 0)::bigint as good_lost,
    coalesce(sum(toxic) filter (mask & bit <> 0 and mask & before = 0), 0)::bigint as toxic_lost,
    sum(coalesce(sum(n) filter (mask & bit <> 0 and mask & before = 0), 0)) over (partition by part, bit)::bigint as shapley
from c, o group by part, filter_order, step, bit, before"""


QUERIES: dict[str, Build] = {f.__name__: f for f in (
    op1_secret_scan, op2_url_filter, op3_license_scan, op4_substring_dedup, op5_decontamination, op5_proximity, op6_quality_rules,
    op7_token_counts, op8_near_duplicates, op9_best_fit_packing, op10_sharding, op11_filter_audit, op12_bpe_round_trip,
    op13_conversation_repair)}
ORACLES: dict[str, str] = {
    "op1_secret_scan": _secret_sql(), "op2_url_filter": _url_sql(), "op3_license_scan": _license_sql(),
    "op4_substring_dedup": _repeats_sql(), "op5_decontamination": _leak_sql(),
    "op6_quality_rules": _quality_sql(), "op8_near_duplicates": _near_sql(),
    "op11_filter_audit": _audit_sql()}
