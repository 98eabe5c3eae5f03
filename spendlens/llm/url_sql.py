"""DuckDB SQL of the URL query: the same rates, priors and bounds."""

_LEVEL = """
  select case when n = 0 or m < 2 or k = 0 or k = n or nn = n * n then 1e6
    when ((kk - k * k / n) - (m - 1) * (k / n) * (1 - k / n)) / (n - nn / n) <= 0 then 1e6
    else least(1e6, greatest(1.0, (k / n) * (1 - k / n)
      / (((kk - k * k / n) - (m - 1) * (k / n) * (1 - k / n)) / (n - nn / n)) - 1)) end as c
  from (select coalesce(sum(n), 0)::double n, coalesce(sum(k), 0)::double k, count(*) m,
    coalesce(sum(n * n), 0)::double nn, coalesce(sum(k * k / n::double), 0) kk
    from {level} where n > 0)"""

URL_SQL = f"""
with rest as (
  select page_id, coalesce(contains(url, '://'), false) as there,
    split_part(split_part(substr(url, instr(url, '://') + 3), '#', 1), '?', 1) as r from pages),
parts as (
  select page_id, case when there then translate(split_part(r, '/', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
    case when there then substr(r, length(split_part(r, '/', 1)) + 1) else '' end as path from rest),
hosts as (
  select host, count(l.bad) as n, count(*) filter (l.bad) as k,
    regexp_extract(host, '([^.]*[.])?[^.]*$') as domain, regexp_extract(host, '[^.]*$') as suffix
  from parts left join (select doc_id, quality = 0 or toxic = 1 as bad from labels
    where doc_id is not null and (quality = 0 or toxic = 1) is not null) l on l.doc_id = page_id
  group by host),
domains as (select domain, suffix, sum(n) as n, sum(k) as k from hosts group by all),
suffixes as (select suffix, sum(n) as n, sum(k) as k from domains group by all),
c_suffix as ({_LEVEL.format(level='suffixes')}),
c_domain as ({_LEVEL.format(level='domains')}),
c_host as ({_LEVEL.format(level='hosts')}),
base as (select (coalesce(sum(k), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0) as p from suffixes),
s as (select suffix, (k + c * p) / (n + c) as ps from suffixes, c_suffix, base),
d as (select domain, (k + c * ps) / (n + c) as pd from domains join s using (suffix), c_domain),
h as (select host, n + c as size, (k + c * pd) / (n + c) as p
  from hosts join d using (domain), c_host),
ruled as (
  select *, case when (host = 'example.net' or host like '%.example.net') and path like '/en/%'
      then 'example.net/en/'
    when (host = 'example.com' or host like '%.example.com') and path like '/de/%'
      then 'example.com/de/'
    when (host = 'org' or host like '%.org') and path like '/fr/%' then 'org/fr/'
    when (host = 'net' or host like '%.net') and path like '/%' then 'net/' end as rule
  from parts)
select page_id, host, path, rule,
  case when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule is not null then 'block'
    when greatest(0.0, p - 1.6449 * sqrt(p * (1 - p) / (size + 1))) > 0.5 then 'block'
    else 'allow' end as verdict
from ruled join h using (host)
"""
