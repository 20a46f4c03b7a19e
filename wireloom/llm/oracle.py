"""SQL for queries of this subpackage that SQL can express, written for DuckDB."""

_ADDRESS = r"""case when regexp_matches({url}, '(?s)^.*?://[^/?#]+') then
    lower(regexp_extract({url}, '(?s)^(.*?)://', 1)) || '://' || {host} ||
    coalesce(nullif(regexp_extract({url}, '(?s)^.*?://[^/?#]*([^#]*)', 1), ''), '/') end"""
_HOST = """translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""
_PATH = """regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"""


def _host(url: str) -> str:
    return _HOST.format(url=url)


def _address(url: str) -> str:
    return _ADDRESS.format(url=url, host=_host(url))


def _rule(url: str) -> str:
    return f"""(select arg_max(r.host || r.path, length(r.host || r.path)) from rules r
        where ({_host(url)} = r.host or ends_with({_host(url)}, '.' || r.host)) and starts_with({_PATH.format(url=url)}, r.path))"""


URLS = f"""
with recursive rules(verdict, host, path) as (
    values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
),
told as (
    select url, replace(t, '&amp;', '&') t from (
        select url, unnest([
            regexp_extract(regexp_extract(html, '(?i)<link\\s[^>]*rel\\s*=\\s*["'']?canonical["''\\s/>][^>]*'), '(?i)\\shref\\s*=\\s*["'']?([^"''\\s>]+)', 1),
            regexp_extract(regexp_extract(html, '(?i)<meta\\s[^>]*http-equiv\\s*=\\s*["'']?refresh["''\\s/>][^>]*'), '(?i)url\\s*=\\s*["'']?([^"''\\s>]+)', 1)]) t
        from pages) where t <> ''
),
absolute as (
    select url, case
        when regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') then t
        when starts_with(t, '//') then regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || t
        when starts_with(t, '/') then regexp_extract(url, '(?s)^.*?://[^/?#]*') || t
        when regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:|^#|^$') then null
        else regexp_replace(regexp_extract(url, '(?s)^.*?://[^/?#]*') || coalesce(nullif({_PATH.format(url="url")}, ''), '/'), '[^/]*$', '') || t end t
    from told
),
edges as (select {_address("url")} a, {_address("t")} b from absolute),
sides as (select a, b from edges where a is not null and b is not null union select b, a from edges where a is not null and b is not null),
reach(a, b) as (select a, b from sides union select r.a, s.b from reach r join sides s on s.a = r.b),
spread as (
    select a, max(verdict = 'block') blocked, max(verdict = 'allow') allowed
    from reach left join rules on rules.host || rules.path = {_rule("b")} group by a
),
judged as (
    select page_id, coalesce({_host("url")}, '') host, coalesce({_PATH.format(url="url")}, '') path, {_rule("url")} rule, {_address("url")} address
    from pages
)
select page_id, j.host, j.path, rule,
    coalesce(rules.verdict, case when coalesce(blocked, false) and not coalesce(allowed, false) then 'block' else 'allow' end) verdict
from judged j left join rules on rules.host || rules.path = rule left join spread on spread.a = address
"""

SOURCES = """
with told as (
    select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents
),
words as (select doc, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from told),
kept as (select lang, term, count(*) as total from words group by lang, term having count(distinct doc) >= 10),
langs as (select lang, count(*) as v, sum(total)::bigint as n from kept group by lang),
counts as (select lang, source, term, count(*) as n from words semi join kept using (lang, term) group by all),
groups as (
    select g.lang, g.source, coalesce(sum(c.n), 0)::bigint as n from (select distinct lang, source from told) g
    left join counts c on c.lang = g.lang and c.source = g.source group by all
),
shares as (
    select g.lang, g.source, k.term, coalesce(c.n, 0) as n, k.total,
        (1 + 1000000000 * (coalesce(c.n, 0) + 2) // (g.n + 2 * l.v))::hugeint as p, (1 + 1000000000 * (k.total + 2) // (l.n + 2 * l.v))::hugeint as q
    from groups g join langs l on l.lang = g.lang join kept k on k.lang = g.lang
    left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
),
pairs as (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
    from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
),
every as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
    union all
    select lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint from shares where n > 0 and p > q
),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::integer as rank from every)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10
"""

TRIE = """
with own as (
    select conv_id as c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
    from conversations where conv_id is not null group by conv_id
),
opened as (
    select c, turns, list_reduce(
        list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda x: ord(x)::bigint)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
            lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)) as crc
    from own
),
whole as (
    select o.c, list_concat(coalesce(b.turns, [])[1:h], o.turns[h + 1:]) as path
    from (select *, xor(crc, 4294967295) % 6 as h from opened) o left join own b on b.c = o.c - o.c % 100
),
prefixes as (
    select c, path[1:d] as node, d, len(path) = d as ends from (select c, path, unnest(range(0, len(path) + 1)) as d from whole)
),
nodes as (
    select node, d, min(c) as conv_id, count(*) as n_convs, coalesce((count(*) - 1) * length(any_value(node)[d].t), 0) as saved,
        sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where ends), '')) as ends_sha256
    from prefixes group by node, d
),
children as (select node[1:d - 1] as node, count(*) as n from nodes where d > 0 group by all),
above as (
    select node[1:e] as node, sum(saved) as saved, count(*) filter (where leaf) as leaves
    from (select n.node, n.d, saved, c.n is null as leaf, unnest(range(0, d + 1)) as e from nodes n left join children c on c.node = n.node) group by 1
)
select n.conv_id, n.d as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n, 0) as n_children, leaves as n_leaves,
    a.saved::bigint as saved_tokens, n.ends_sha256
from nodes n join above a on a.node = n.node left join children c on c.node = n.node
left join nodes p on n.d > 0 and p.node = n.node[1:n.d - 1]
"""

ORACLES = {"op12_prefix_trie": TRIE, "op13_source_skyband": SOURCES, "op6_url_equivalence": URLS}
