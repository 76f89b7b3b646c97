"""SQL (DuckDB) of the queries of this subpackage that it can state."""

from __future__ import annotations

from shelfcast.llm.ledger import POLICIES, RULES
from shelfcast.llm.site_lines import HIDDEN, INLINE
from shelfcast.llm.spelling import LOWER, UPPER
from shelfcast.llm.url_reputation import RULES as URL_RULES
from shelfcast.llm.url_reputation import SUFFIXES

_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

#: What the rules measure of every document.
_MEASURED = rf"""with docs as (select row_number() over () as id, doc_id, coalesce(text, '') as text from documents),
words as (select id, {_WORDS} as w from docs),
placed as (select id, w[i] as a, w[i + 1] as b, w[i + 2] as c, i from (select id, w, unnest(range(1, len(w) - 1)) as i from words)),
often as (select *, count(*) over (partition by id, a, b, c) as n from placed),
marked as (select id, count(distinct i + k) as n from often, (select unnest([0, 1, 2]) as k) where n > 1 group by id),
lines as (select id, unnest(string_split(text, chr(10))) as line from docs),
real_lines as (select id, count(*) as n, count(distinct line) as d from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by id),
measured as (
  select docs.doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(l.n, 0)::bigint as n_lines,
    coalesce(l.n - l.d, 0)::bigint as n_dup_lines, coalesce(m.n, 0)::bigint as n_repeat_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g'))::bigint as n_upper, length(regexp_replace(text, '[^a-z]', '', 'g'))::bigint as n_lower
  from docs join words using (id) left join marked m using (id) left join real_lines l using (id))"""


def _ledger() -> str:
    bits = " + ".join(f"case when {condition} then {1 << i} else 0 end" for i, (_, condition) in enumerate(RULES))
    fails = lambda policy: " or ".join(f"({c})" for name, c in RULES if name in POLICIES[policy])
    return rf"""{_MEASURED}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({fails('base')}) as base_failed,
  not ({fails('base')} or {fails('v1')}) as kept, n_lines, n_upper, n_lower, ({bits})::bigint as failed
from measured"""


def _ablation(policy: str = "v1") -> str:
    """Rules are tried one by one on the measurements, without bits."""
    wanted = [(name, condition) for name, condition in RULES if name in POLICIES[policy]]
    failed = ", ".join(f"({condition})::int as f{i}" for i, (_, condition) in enumerate(wanted))
    total = " + ".join(f"f{i}" for i in range(len(wanted)))
    rows = " union all ".join(f"select '{name}' as rule, coalesce(sum(f{i}), 0)::bigint as failing, count(*) filter (f{i} = 1 and total = 1) as only_this from tried" for i, (name, _) in enumerate(wanted))
    return f"{_MEASURED}, tried as (select *, {total} as total from (select {failed} from measured)) {rows}"


def _urls(z: float = 1.645, limit: float = 0.25) -> str:
    known = "|".join(s.replace(".", r"\.") for s in sorted(SUFFIXES, key=len, reverse=True))
    fits = lambda r: f"((host = '{r.partition('/')[0]}' or ends_with(host, '.{r.partition('/')[0]}')) and starts_with(path, '/{r.partition('/')[2]}'))"
    ordered = sorted(URL_RULES, key=lambda r: -len(r[1]))
    rule = "case " + " ".join(f"when {fits(r)} then '{r}'" for _, r in ordered) + " end"
    verdict = "case rule " + " ".join(f"when '{r}' then '{v}'" for v, r in URL_RULES) + " end"

    def weight(name: str, units: str, n: str, x: str) -> str:
        return f"""{name}_sums as (select count(*)::double k, sum({n})::double s1, sum({n} * {n})::double s2, sum({x})::double x, sum({x} * ({x} / {n}))::double xp from {units} where {n} > 0),
{name}_spread as (select *, (xp - x * x / s1) / (k - 1) between_, (x - xp) / (s1 - k) inside, (s1 - s2 / s1) / (k - 1) size from {name}_sums),
{name} as (select 1 / (case when k > 1 and s1 > k and between_ + (size - 1) * inside > 0 then greatest(0.001, least(0.5, (between_ - inside) / (between_ + (size - 1) * inside))) else 0.1 end) - 1 as w from {name}_spread)"""

    return rf"""
with seen as (
  select page_id, url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from pages),
named as (select page_id, try_cast(nullif(regexp_extract(path, '/(\d{{1,18}})(?:[./]|$)', 1), '') as bigint) as doc_id from seen),
marks as (select page_id, count(bad) as n, sum(bad)::bigint as x from (
  select page_id, (quality = 0 or toxic = 1)::bigint as bad from named join labels using (doc_id)) where bad is not null group by page_id),
hosts as (select host, regexp_extract(host, '((?:^|[^.]*\.)(?:{known}|[^.]*))$', 1) as domain, regexp_extract(host, '(?:^|\.)({known}|[^.]*)$', 1) as suffix,
  coalesce(sum(n), 0)::bigint as n_labelled, coalesce(sum(x), 0)::bigint as n_bad from seen left join marks using (page_id) group by all),
suffixes as (select suffix, sum(n_labelled) as n, sum(n_bad) as x from hosts group by suffix),
domains as (select suffix, domain, sum(n_labelled) as n, sum(n_bad) as x from hosts group by suffix, domain),
root as (select (sum(n_bad) + 0.5) / (sum(n_labelled) + 1) as rate from hosts),
{weight('of_suffix', 'suffixes', 'n', 'x')},
{weight('of_domain', 'domains', 'n', 'x')},
{weight('of_host', 'hosts', 'n_labelled', 'n_bad')},
suffix_rates as (select suffix, (x + w * rate) / (n + w) as suffix_rate from suffixes, of_suffix, root),
domain_rates as (select suffix, domain, (x + w * suffix_rate) / (n + w) as domain_rate from domains join suffix_rates using (suffix), of_domain),
beta as (select host, n_labelled, n_bad, n_bad + w * domain_rate as a, n_labelled - n_bad + w * (1 - domain_rate) as b from hosts join domain_rates using (suffix, domain), of_host),
bounds as (select host, n_labelled, n_bad, a / (a + b) - {z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as lower_ from beta),
ruled as (select *, {rule} as rule from seen)
select page_id, host, path, rule, coalesce({verdict}, case when greatest(0.0, lower_) > {limit} and n_labelled > 0 then 'block' else 'allow' end) as verdict, n_labelled, n_bad
from ruled join bounds using (host)"""


def _lines(ratio: float = 0.2, min_pages: int = 3) -> str:
    return rf"""
with seen as (
  select row_number() over () as id, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '{HIDDEN}', chr(10), 'g'), '{INLINE}', '', 'g'), '<[^>]*>', chr(10), 'g') as text from pages),
lines as (select id, host, trim(line, ' ') as line, pos from (select id, host, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from seen) where trim(line, ' ') <> ''),
totals as (select host, count(*) as pages from seen group by host),
boiler as (select host, line from (select distinct id, host, line from lines) join totals using (host) group by host, line, pages having count(*) >= {min_pages} and count(*) > {ratio} * pages),
kept as (select id, count(*) as n, count(*) filter (b.line is not null) as dropped, string_agg(l.line, chr(10) order by pos) filter (b.line is null) as text
  from lines l left join boiler b on b.host = l.host and b.line = l.line group by id)
select page_id, host, coalesce(kept.text, '') as text, coalesce(n, 0)::bigint as n_lines, coalesce(dropped, 0)::bigint as n_dropped from seen left join kept using (id)"""


def _search(top: int = 20) -> str:
    terms = lambda c: rf"regexp_extract_all(translate(coalesce({c}, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return rf"""
with items as (select row_number() over () as item, item_id, text from (select distinct item_id, text from benchmark)),
wanted as (select item, term, count(*) as repeats from (select item, unnest({terms('text')}) as term from items) group by item, term),
docs as (select row_number() over () as id, doc_id, {terms('text')} as terms from documents),
sizes as (select id, len(terms) as n from docs where len(terms) > 0),
totals as (select count(*) as docs, sum(n)::bigint as terms from sizes),
counted as (select id, term, count(*) as tf from (select id, unnest(terms) as term from docs) semi join wanted using (term) group by id, term),
weights as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w from (select term, count(*) as df from counted group by term), totals),
worth as (select id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)) as worth from counted join sizes using (id), totals),
sums as (select item, id, sum(repeats * w * worth)::bigint as score from wanted join weights using (term) join worth using (term) group by item, id),
ranked as (select item, doc_id, score, row_number() over (partition by item order by score desc, doc_id nulls last) as place from sums join docs using (id) where score > 0)
select item_id, place::int as rank, doc_id, score from ranked join items using (item) where place <= {top}"""


ORACLES = {"op12_search": _search(), "op3_url_reputation": _urls(), "op9_quality_ledger": _ledger(), "rule_ablation": _ablation(), "op10_site_lines": _lines()}
