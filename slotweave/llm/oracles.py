"""SQL with the same result as a registered query, for the operators that SQL can express."""

from __future__ import annotations

from slotweave.llm.fill_in_middle import SEED, SPM_PERCENT, TRANSFORMED_PERCENT
from slotweave.llm.url_filters import SOFT_LIMIT, SOFT_TERMS, STRICT_TERMS


def _group(number: int) -> str:
    return f"cast(concat('0x', substr(digest, {8 * number + 1}, 8)) as bigint)"


FILL_IN_MIDDLE_SQL = f"""
with texts as (
  select doc_id, coalesce(text, '') as t, sha256(concat('{SEED}:', cast(doc_id as varchar))) as digest from documents),
cut as (
  select *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') as tok from texts),
placed as (
  select *, len(tok) as n, least({_group(0)} % (len(tok) + 1), {_group(1)} % (len(tok) + 1)) as a,
    greatest({_group(0)} % (len(tok) + 1), {_group(1)} % (len(tok) + 1)) as b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or {_group(2)} % 100 >= {TRANSFORMED_PERCENT} then 'plain'
      when {_group(3)} % 100 < {SPM_PERCENT} then 'spm' else 'psm' end as form
  from cut),
parts as (
  select *, array_to_string(tok[1:a], '') as p, array_to_string(tok[a + 1:b], '') as m, array_to_string(tok[b + 1:n], '') as s
  from placed)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then concat('<P>', p, '<S>', s, '<M>', m) else concat('<S>', s, '<P>', p, '<M>', m) end) as output_sha256,
  sha256(t) as restored_sha256
from parts"""


def _terms(terms: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{t}'" for t in terms)
    return f"list_filter([{listed}], lambda t: regexp_matches(low, concat('(^|[^a-z0-9])', t, '($|[^a-z0-9])')))"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
URL_FILTER_SQL = f"""
with opened as (
  select page_id, {_LOWER.format("coalesce(url, '')")} as low,
    case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parts as (
  select *, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from opened),
found as (
  select *, {_terms(STRICT_TERMS)} as strict, {_terms(SOFT_TERMS)} as soft,
    case when concat('.', host) like '%.example.net' and path like '/en/%' then 'example.net/en/'
      when concat('.', host) like '%.example.com' and path like '/de/%' then 'example.com/de/'
      when concat('.', host) like '%.org' and path like '/fr/%' then 'org/fr/'
      when concat('.', host) like '%.net' and path like '/%' then 'net/' end as rule
  from parts)
select page_id, host, path, rule,
  case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow'
    when len(strict) > 0 or len(soft) >= {SOFT_LIMIT} then 'block' else 'allow' end as verdict,
  len(strict) as n_strict, len(soft) as n_soft, array_to_string(list_sort(list_concat(strict, soft)), ',') as terms
from found"""
