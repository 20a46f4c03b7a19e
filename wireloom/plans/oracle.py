"""The same queries as SQL for DuckDB, written against the supplied tables."""

from __future__ import annotations

from wireloom import fixed_values as fv
from wireloom.plans import fixtures as fx
from wireloom.plans.queries import AS_OF, BULKY_PAGE_ADDRESS, HOME_LANGUAGE

ORACLES: dict[str, str] = {}


def quoted(text: str | None) -> str:
    """A SQL literal."""
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def case_of(number: str, options, modulus: int | None = None) -> str:
    """CASE over ``number`` modulo the number of options."""
    modulus = modulus or len(options)
    branches = " ".join(f"WHEN {i} THEN {option}" for i, option in enumerate(options))
    return f"CASE ({number}) % {modulus} {branches} END"


# --- text ------------------------------------------------------------------


def substitute(text: str, pattern: str, replacement: str = " ") -> str:
    return f"regexp_replace({text}, {quoted(pattern)}, {quoted(replacement)}, 'g')"


def replace_phrases(text: str, phrases) -> str:
    for phrase in sorted(set(phrases), key=lambda phrase: (-len(phrase), phrase)):
        text = f"replace({text}, {quoted(phrase)}, ' ')"
    return text


def without_boilerplate(text: str, channel: str) -> str:
    common = fv.BOILERPLATE[fv.COMMON_LABELS_KEY]
    branches = " ".join(
        f"WHEN {quoted(name)} THEN {replace_phrases(text, [*own, *common])}"
        for name, own in fv.BOILERPLATE.items()
        if name != fv.COMMON_LABELS_KEY
    )
    return f"CASE {channel} {branches} ELSE {replace_phrases(text, common)} END"


EMOJI = f"[{fv.emoji_class()}]"
WHITESPACE = quoted(fv.WHITESPACE)


def without_emoji(text: str) -> str:
    return substitute(text, EMOJI, "")


def without_trailing_url(text: str) -> str:
    return substitute(substitute(text, fv.TRAILING_URL), fv.TRAILING_CHANNEL_LINK)


def without_site_links(text: str) -> str:
    return substitute(text, fv.SITE_LINK)


def without_tags_mentions(text: str) -> str:
    return substitute(substitute(text, fv.TRAILING_HASHTAG), fv.TRAILING_MENTION)


def cleaned(text: str, channel: str) -> str:
    text = substitute(without_boilerplate(text, channel), fv.FLAGS_AND_SMILEYS, "")
    text = f"ltrim(trim({text}, {quoted(fv.VARIATION_SELECTOR)}), '. ')"
    text = without_emoji(text)
    text = f"replace({text}, {quoted(fv.ZERO_WIDTH_SPACE_PAIR)}, ' ')"
    for character in fv.BLANKED_CHARACTERS:
        text = f"replace({text}, {quoted(character)}, ' ')"
    text = without_tags_mentions(without_site_links(without_trailing_url(text)))
    return f"trim({substitute(f'ltrim({text}, {quoted(". ")})', ' +')}, {WHITESPACE})"


TITLE_CASE = (
    r"^[^\p{Lu}\p{Lt}\p{Ll}]*[\p{Lu}\p{Lt}]\p{Ll}*(?:[^\p{Lu}\p{Lt}\p{Ll}]+[\p{Lu}\p{Lt}]\p{Ll}*)*"
    r"[^\p{Lu}\p{Lt}\p{Ll}]*$"
)


def headline_closed(text: str, title: str) -> str:
    first_word = f"regexp_extract({title}, {quoted(f'[^{fv.WHITESPACE_CLASS}]+')})"
    return (
        f"CASE WHEN regexp_matches({first_word}, {quoted(TITLE_CASE)}) "
        f"THEN replace({text}, {title}, rtrim({title}, '.') || '. ') ELSE {text} END"
    )


def window_of(text: str, limit: int = fv.MODEL_INPUT_TOKENS) -> str:
    return (
        f"array_to_string(regexp_split_to_array(trim({text}, {WHITESPACE}), "
        f"{quoted(f'[{fv.WHITESPACE_CLASS}]+')})[1:{limit}], ' ')"
    )


def sentences_of(text: str) -> str:
    marked = f"regexp_replace({window_of(text)}, '([.!?…])[ ]+', '\\1' || chr(1), 'g')"
    return f"list_filter(string_split({marked}, chr(1)), lambda s: s <> '')"


def bound(value: str, name: str, body: str) -> str:
    """``body`` with a name for a value."""
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def cut_repeats(text: str) -> str:
    """Ends before the word that completes a run of four words for the second time."""
    again = "list_filter(range(1, len(runs) + 1), lambda i: list_position(runs, runs[i]) < i)"
    ended = f"CASE WHEN len(list_distinct(runs)) < len(runs) THEN array_to_string(words[1:({again})[1] + 2], ' ') ELSE whole END"
    runs = bound("list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))", "runs", ended)
    return bound(text, "whole", bound("list_filter(string_split_regex(whole, '\\s+'), lambda w: w <> '')", "words", runs))


def summary(text: str) -> str:
    distinct = f"list_filter({sentences_of(text)}, lambda s, i: list_position({sentences_of(text)}, s) = i)"
    words = "list_transform(ss, lambda s: list_distinct(regexp_extract_all(s, '[^\\s.,;:!?…\"()]+')))"
    rank = "list_transform(ss, lambda s: 1000::bigint)"
    for name in ("r1", "r2", "r3"):
        shared = f"CASE WHEN i = j THEN 0 ELSE len(list_intersect(w, v)) * {name}[j] END"
        raised = f"list_transform(ws, lambda w, i: list_sum(list_transform(ws, lambda v, j: {shared}))::bigint)"
        rank = bound(rank, name, bound(raised, f"{name}x", f"list_transform({name}x, lambda x: x * 1000 // greatest(list_max({name}x), 1))"))
    first = "list_sort(list_transform(list_sort(list_transform(rank, lambda x, i: (1000 - x) * 1000 + i))[1:3], lambda x: x % 1000))"
    chosen = bound(words, "ws", bound(rank, "rank", f"array_to_string(list_transform({first}, lambda i: ss[i]), ' ')"))
    return bound(distinct, "ss", f"CASE WHEN len(ss) <= 3 THEN {cut_repeats("array_to_string(ss, ' ')")} ELSE {cut_repeats(chosen)} END")


def title(text: str) -> str:
    return cut_repeats(f"rtrim(coalesce(({sentences_of(text)})[1], ''), '.')")


# --- views -----------------------------------------------------------------

AGENCIES = """agencies AS (
  SELECT source AS telegram,
         CASE n % 4 WHEN 0 THEN 'economy' WHEN 1 THEN 'None' WHEN 3 THEN 'sports' END AS mono_category,
         CASE WHEN n = 12 THEN NULL ELSE n % 3 <> 0 END AS is_parsing,
         CASE WHEN n = 3 THEN NULL WHEN n = 9 THEN '' WHEN n % 3 = 0 THEN 'en' WHEN n % 3 = 1 THEN '' END AS language,
         CASE WHEN n = 15 THEN NULL ELSE n % 7 END AS priority
  FROM (SELECT DISTINCT source, CAST(substr(source, 4) AS INT) AS n FROM documents WHERE source IS NOT NULL))"""

NEWS = """news_v AS (
  SELECT 'https://t.me/' || source || '/' || doc_id AS url,
         TIMESTAMP '2023-01-01 00:00:00' + to_minutes(CAST(doc_id % 500 AS INT)) AS date,
         text AS news, 'https://t.me/' || source || '/' || doc_id AS links, source AS agency, doc_id, lang
  FROM documents)"""

DECORATED = f"""decorated AS (
  SELECT doc_id,
         {case_of('doc_id', [quoted(front) for front, _ in fx.DECORATIONS])} || text ||
         {case_of('doc_id', [quoted(back) for _, back in fx.DECORATIONS])} AS news,
         CASE WHEN doc_id % 24 = 23 THEN 'techinsiderru' ELSE source END AS agency
  FROM documents)"""

LABELLED = f"""labelled AS (
  SELECT *, {case_of('doc_id', [quoted(label) for label in fx.LABELS])} AS category FROM news_v)"""

KNOWN = """known AS (
  SELECT agency, CAST(split_part(url, '/', 5) AS BIGINT) AS id, doc_id % 4 AS part FROM news_v WHERE agency != 'src7')"""

CORRUPTED = f"""corrupted AS (
  SELECT doc_id,
         CASE doc_id % 10 WHEN 2 THEN substr(url, 9) WHEN 3 THEN 'https://localhost/' || doc_id ELSE url END AS url,
         date,
         CASE WHEN doc_id % 10 = 7 THEN NULL ELSE agency END AS title,
         '' AS resume,
         CASE WHEN doc_id % 10 = 8 THEN 'ftp' || substr(links, 6) ELSE links END AS links,
         CASE doc_id % 10 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE news END AS news,
         CASE WHEN doc_id % 10 = 6 THEN 'other'
              ELSE {case_of('doc_id', [quoted(category) for category in fv.CATEGORIES])} END AS category,
         CASE doc_id % 10 WHEN 4 THEN NULL WHEN 5 THEN '' ELSE agency END AS agency
  FROM news_v)"""


def valid_address(url: str) -> str:
    """The URL rule from its parts: scheme, user, host labels or address, port number."""
    t = f"trim({url}, {WHITESPACE})"
    authority = f"regexp_extract({t}, '^[^:]*://([^/?#]*)', 1)"
    place = f"string_split({authority}, '@')[-1]"
    bracketed = f"starts_with({place}, '[')"
    port = f"CASE WHEN {bracketed} THEN string_split({place}, ']')[-1] WHEN contains({place}, ':') THEN ':' || string_split({place}, ':')[-1] ELSE '' END"
    host = f"CASE WHEN {bracketed} THEN string_split({place}, ']')[1] || ']' ELSE string_split({place}, ':')[1] END"
    labels = f"string_split(rtrim({host}, '.'), '.')"
    label_ok = "length(x) BETWEEN 1 AND 63 AND NOT starts_with(x, '-') AND NOT ends_with(x, '-') AND regexp_matches(lower(x), '^[-_0-9a-z\\x{80}-\\x{40000}]+$')"
    named = (
        f"len({labels}) > 1 AND len(list_filter({labels}, lambda x: NOT ({label_ok}))) = 0 "
        f"AND (regexp_matches({labels}[-1], '^[\\p{{L}}]{{2,63}}$') OR starts_with(lower({labels}[-1]), 'xn--'))"
    )
    numbers = f"len({labels}) = 4 AND len(list_filter({labels}, lambda x: try_cast(x AS INT) IS NULL OR length(x) > 3)) = 0"
    sixes = f"{bracketed} AND regexp_matches(upper({host}), '^.[A-F0-9]*:[A-F0-9:]+.$')"
    return (
        f"coalesce(length({t}) BETWEEN 1 AND {fv.URL_MAX_LENGTH} AND NOT regexp_matches({t}, {quoted(f'[{fv.WHITESPACE_CLASS}]')}) "
        f"AND lower(string_split({t}, '://')[1]) IN ('http', 'https') AND contains({t}, '://') "
        f"AND ({port} = '' OR coalesce(try_cast(substr({port}, 2) AS INT) BETWEEN 0 AND 65535, false)) AND (({sixes}) OR ({numbers}) OR ({named})), false)"
    )


SHORT_RULES = {
    "url": valid_address("url"),
    "date": "date IS NOT NULL",
    "news": "news IS NOT NULL AND length(news) >= 1",
    "links": valid_address("links"),
    "agency": "agency IS NOT NULL",
}
FINAL_RULES = {
    **SHORT_RULES,
    "title": "title IS NOT NULL",
    "resume": "resume IS NOT NULL",
    "category": f"category IN ({', '.join(map(quoted, fv.CATEGORIES))})",
}


def checked(rules: dict[str, str]) -> str:
    broken = ", ".join(f"CASE WHEN NOT coalesce({rule}, false) THEN '{name}' END" for name, rule in rules.items())
    return f"""{NEWS}, {CORRUPTED}, checked AS (
  SELECT *, list_filter([{broken}], lambda e: e IS NOT NULL) AS errors FROM corrupted)"""


MONO = "SELECT telegram, mono_category FROM agencies WHERE is_parsing = true AND NOT mono_category = 'None'"

HISTORY = """history AS (
  SELECT o_orderkey, 'https://t.me/archive/' || (o_orderkey // 2) AS url, o_orderdate AS date,
         'Order ' || o_orderkey || '. It''s ' || o_orderpriority || '! Status ' || o_orderstatus
           || '. It''s late. Closed.' AS news,
         CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN '' ELSE 'x' END AS resume
  FROM orders)"""
PAST_DAYS = ", ".join(f"DATE '{year}-{AS_OF:%m-%d}'" for year in range(fv.FIRST_ARCHIVE_YEAR, AS_OF.year))
MISSING = f"CAST(date AS DATE) IN ({PAST_DAYS}) AND (resume IS NULL OR resume = '')"


def register(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


# --- agencies, scans, routing ------------------------------------------------

register("active_agencies", f"WITH {AGENCIES} SELECT telegram FROM agencies WHERE is_parsing IS TRUE")
register(
    "foreign_agencies",
    f"WITH {AGENCIES} SELECT telegram FROM agencies WHERE language <> '' AND is_parsing IS FALSE AND priority <> 6",
)
register(
    "mono_category_lookup",
    """
WITH rows_v AS (
  SELECT source AS telegram, max(doc_id) AS place, CAST(substr(source, 4) AS INT) % 3 <> 0 AS is_parsing,
         CASE lang WHEN 'en' THEN 'economy' WHEN 'fr' THEN 'sports' WHEN 'de' THEN 'None' END AS mono_category
  FROM documents WHERE source IS NOT NULL GROUP BY source, lang)
SELECT telegram, arg_max(mono_category, place) AS mono_category
FROM rows_v WHERE is_parsing = true AND NOT mono_category = 'None' GROUP BY telegram
""",
)
register("staged_scan", f"WITH {NEWS} SELECT url, date, news, links, agency FROM news_v")
register(
    "limit_probe",
    f"""
WITH {NEWS}
SELECT 'staged' AS name, EXISTS (SELECT 1 FROM news_v WHERE doc_id % 4 = 0) AS non_empty
UNION ALL SELECT 'final', EXISTS (SELECT 1 FROM news_v WHERE doc_id % 4 = 1)
UNION ALL SELECT 'empty', EXISTS (SELECT 1 FROM news_v WHERE doc_id < 0)
""",
)
register(
    "route_by_group",
    f"""
SELECT CASE WHEN lang = '{HOME_LANGUAGE}' THEN 'russian' ELSE 'foreign' END AS lang_group,
       count(*) AS rows, count(DISTINCT source) AS agencies
FROM documents GROUP BY 1
""",
)

# --- ids ---------------------------------------------------------------------

register("known_ids", f"WITH {NEWS}, {KNOWN} SELECT agency, id FROM known")
register("known_ids_foreign", f"WITH {NEWS}, {KNOWN} SELECT agency, id FROM known WHERE part IN (0, 2)")
register(
    "agency_id_lists",
    f"""
WITH {AGENCIES}, {NEWS}, {KNOWN},
counted AS (SELECT agency, id // 3 AS id, count(*) AS copies FROM known GROUP BY 1, 2),
chunks AS (
  SELECT agency, id // 1024 AS chunk, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids,
         string_agg(CAST(copies AS VARCHAR), ',' ORDER BY id) AS copies
  FROM counted GROUP BY 1, 2)
SELECT telegram AS agency, chunk, coalesce(ids, '') AS ids, coalesce(copies, '') AS copies
FROM agencies LEFT JOIN chunks ON agency = telegram WHERE is_parsing IS TRUE
""",
)
ARTICLES = f"""
WITH {AGENCIES}, {NEWS},
counted AS (
  SELECT agency, string_split(url, '/')[-1] AS article_id, count(*) AS copies
  FROM news_v WHERE doc_id % 4 = 1 GROUP BY 1, 2)
SELECT telegram AS agency, article_id, coalesce(copies, 0) AS copies
FROM agencies LEFT JOIN counted ON agency = telegram WHERE is_parsing IS TRUE
"""
register("articles_by_agency", ARTICLES)
register("articles_of_one_agency", ARTICLES + " AND telegram = 'src5'")
register(
    "latest_per_agency",
    f"WITH {NEWS} SELECT DISTINCT agency, max(date) OVER (PARTITION BY agency) AS date FROM news_v",
)
register(
    "last_news_id",
    f"""
WITH {AGENCIES}, {NEWS},
numbered AS (
  SELECT agency, CAST(string_split(url, '/')[-1] AS BIGINT) AS message,
         row_number() OVER (PARTITION BY agency ORDER BY date DESC, CAST(string_split(url, '/')[-1] AS BIGINT) DESC) AS place
  FROM news_v WHERE date IS NOT NULL),
newest AS (SELECT agency, message AS last_id FROM numbered WHERE place = 1)
SELECT 'https://t.me/s/' || telegram AS channel_link, coalesce(last_id, 0) AS last_id
FROM agencies LEFT JOIN newest ON agency = telegram WHERE is_parsing IS TRUE
""",
)
register(
    "fresh_anti_join",
    f"""
WITH {NEWS}, numbered AS (SELECT *, CAST(split_part(url, '/', 5) AS BIGINT) AS id FROM news_v)
SELECT agency, id, url, date, news FROM numbered n
WHERE NOT EXISTS (SELECT 1 FROM numbered k WHERE k.doc_id % 4 IN (2, 3) AND k.agency = n.agency AND k.id = n.id)
""",
)

# --- links and dates -----------------------------------------------------------

register(
    "link_normalize",
    """
WITH x AS (
  SELECT page_id, url, CASE page_id % 4 WHEN 0 THEN 'https://www.youtube.com/watch?v=' || page_id
         WHEN 1 THEN '?only=query' ELSE split_part(url, '?utm', 1) END AS link FROM pages)
SELECT page_id, coalesce(nullif(CASE WHEN starts_with(link, 'https://www.youtube.com/watch') THEN link
       ELSE split_part(link, '?', 1) END, ''), url) AS links FROM x
""",
)
register(
    "link_choose",
    f"""
WITH x AS (
  SELECT page_id, 'https://t.me/own/' || page_id AS own,
         CASE page_id % 7 WHEN 0 THEN 'https://t.me/some_channel' WHEN 1 THEN 'https://example.com'
         WHEN 2 THEN 'https://t.me/some_channel/' || page_id WHEN 3 THEN NULL
         WHEN 4 THEN 'tg://resolve?domain=c' || page_id WHEN 5 THEN 'https://t.me/+c' || page_id ELSE url END AS href
  FROM pages)
SELECT page_id, CASE WHEN href IS NULL OR starts_with(href, 'tg://resolve?domain=') OR starts_with(href, 'https://t.me/+')
       OR regexp_matches(href, {quoted(fv.BARE_CHANNEL_LINK)}) OR regexp_matches(href, {quoted(fv.BARE_DOMAIN_LINK)})
       THEN own ELSE split_part(href, '?utm', 1) END AS links FROM x
""",
)
register(
    "event_time_shift",
    """
SELECT event_id, CASE WHEN event_id % 100 <> 0 THEN date_trunc('second', ts) + INTERVAL 3 HOUR END AS date FROM events
""",
)
register(
    "anniversary_dates",
    """
WITH days AS (SELECT DISTINCT CAST(o_orderdate + INTERVAL 4 YEAR AS DATE) AS as_of FROM orders),
years AS (SELECT as_of, unnest(range(1999, CAST(year(as_of) AS BIGINT))) AS past_year FROM days)
SELECT as_of, CAST(as_of - to_years(CAST(year(as_of) - past_year AS INT)) AS DATE) AS past_date FROM years
""",
)
register("anniversary_missing", f"WITH {HISTORY} SELECT o_orderkey, url, date, resume FROM history WHERE {MISSING}")

# --- text ----------------------------------------------------------------------

register(
    "channel_rule",
    f"""
WITH {DECORATED}, x AS (SELECT doc_id, agency, 'a: b: ' || news || ': end# tag' AS t FROM decorated)
SELECT doc_id, CASE WHEN agency = '{fx.RULED_SOURCE}' THEN split_part(string_split(t, ': ')[-1], '#', 1) ELSE t END AS news
FROM x
""",
)
COMMON_ARRAY = "[" + ", ".join(map(quoted, fv.BOILERPLATE[fv.COMMON_LABELS_KEY])) + "]"
register(
    "strip_boilerplate",
    f"""
WITH {DECORATED},
labels_v AS (
  SELECT DISTINCT source AS channel, CASE lang WHEN 'en' THEN 'tion' WHEN 'fr' THEN 'ation' WHEN 'de' THEN 'sch' END AS phrase
  FROM documents),
own AS (SELECT channel, list(phrase) AS phrases FROM labels_v WHERE phrase IS NOT NULL GROUP BY channel),
wanted AS (
  SELECT doc_id, agency, news, unnest(list_distinct(list_concat(coalesce(phrases, []), {COMMON_ARRAY}))) AS phrase
  FROM decorated LEFT JOIN own ON channel = agency),
listed AS (
  SELECT doc_id, agency, news, list(phrase ORDER BY length(phrase) DESC, phrase) AS phrases
  FROM wanted GROUP BY doc_id, agency, news)
SELECT doc_id, agency,
       list_reduce(list_concat([news], phrases), lambda acc, phrase: replace(acc, phrase, ' ')) AS news
FROM listed
""",
)
register(
    "strip_many_phrases",
    f"""
WITH {DECORATED},
labels_v AS (
  SELECT source AS channel, string_split(text, ' ')[1] AS phrase FROM documents
  UNION SELECT source, array_to_string(string_split(text, ' ')[1:2], ' ') FROM documents),
own AS (SELECT channel, list(phrase) AS phrases FROM labels_v WHERE phrase <> '' GROUP BY channel),
ordered AS (
  SELECT channel, list(phrase ORDER BY length(phrase) DESC, phrase) AS phrases
  FROM (SELECT channel, unnest(list_distinct(list_concat(phrases, {COMMON_ARRAY}))) AS phrase FROM own) GROUP BY channel),
others AS (SELECT list(phrase ORDER BY length(phrase) DESC, phrase) AS common FROM (SELECT unnest({COMMON_ARRAY}) AS phrase))
SELECT doc_id, agency,
       list_reduce(list_concat([news], coalesce(phrases, common)), lambda acc, phrase: replace(acc, phrase, ' ')) AS news
FROM decorated LEFT JOIN ordered ON channel = agency, others
""",
)
for _name, _sql in (
    ("strip_fixed_boilerplate", without_boilerplate("news", "agency")),
    ("strip_emoji", without_emoji("news")),
    ("strip_trailing_url", without_trailing_url("news")),
    ("strip_site_links", without_site_links("news")),
    ("strip_tags_mentions", without_tags_mentions("news")),
    ("clean_text", cleaned("news", "agency")),
):
    register(_name, f"WITH {DECORATED} SELECT doc_id, {_sql} AS news FROM decorated")
register("label_strip", "SELECT doc_id, string_split('__label__' || lang, '__')[-1] AS category FROM documents")

# --- pages ---------------------------------------------------------------------

register(
    "html_blocks",
    """
WITH x AS (SELECT page_id, string_split(html, '<p>')[2:] AS parts FROM pages),
y AS (SELECT page_id, unnest(parts) AS part, unnest(range(len(parts))) AS block_no FROM x)
SELECT page_id, CAST(block_no AS INT) AS block_no,
       split_part(split_part(part, '</p>', 1), '</article>', 1) AS block FROM y
""",
)
# What the given pages hold; ``&amp;`` comes last, so that each reference is resolved once.
REFERENCES = (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
# What a reader sees of fixtures.referenced: its bold part, what follows, and where its link leads.
LINE_BOLD = "(chr(CAST(page_id + 161 AS INT)) || ' ' || chr(CAST(page_id + 1024 AS INT)) || ' –\ufffd ')"
LINE_NAMED = case_of("page_id", ("'é'", "'«'", "'…'", "'¬it;'", "'&bogus;'", "'Ö&lt;'"))
LINE_LINK = "'https://e.org/?p=1&copy=' || page_id || '&copy=2'"


def resolved(text: str) -> str:
    for reference, character in REFERENCES:
        text = f"replace({text}, {quoted(reference)}, {quoted(character)})"
    return text


VISIBLE = f"{LINE_BOLD} || {LINE_NAMED} || " + resolved(
    substitute(
        substitute(
            substitute(substitute("html", "(?s)<script[^>]*>.*?</script>", ""), "(?s)<style[^>]*>.*?</style>", ""),
            "(?s)<!--.*?-->",
            "",
        ),
        "<[^>]*>",
        "",
    )
)
BOLD = f"list_prepend({LINE_BOLD}, list_transform(regexp_extract_all(html, '(?s)<b>(.*?)(?:</b>|</?(?:p|div|br|li|h1|article)[ />]|$)', 1), lambda b: {resolved("regexp_replace(b, '<[^>]*>', '', 'g')")}))"
register(
    "html_first_link",
    f"""SELECT page_id, CASE WHEN page_id % 4 <> 0 THEN {LINE_LINK}
  ELSE nullif({resolved("regexp_extract(html, '(?i)<a\\s(?:[^>]*\\s)?href\\s*=\\s*\"([^\"]*)\"', 1)")}, '') END AS href FROM pages""",
)
register("html_text", f"SELECT page_id, {VISIBLE} AS text FROM pages")
register("html_bold", f"SELECT page_id, array_to_string({BOLD}, '|') AS bold FROM pages")
register(
    "headline_split",
    f"""
WITH x AS (SELECT page_id, {VISIBLE} AS body, array_to_string({BOLD}, ' ') AS title FROM pages)
SELECT page_id, {headline_closed('body', 'title')} AS news FROM x
""",
)

# What a reader sees of fixtures.BODIES: text, headline, link.
BODY_TEXTS = (
    "word || ' ' || text",
    "'Alpha Betaxgamma. ' || text",
    "text || ' more b'",
    "'video ' || text",
    "text || ' channel'",
    "text || ' open'",
    "NULL",
    "word || text || ' site'",
    "text || 'source'",
    "'😀' || text || ': last. #tag'",
)
HEADLINES = ("word", "'Alpha Beta gamma.'", "''", "''", "''", "''", "NULL", "word", "''", "'😀'")
LINKS = (
    "own", "own", "'https://site.example.com/a/b'", "'https://www.youtube.com/watch?v=abc&t=1'", "own", "own", "NULL",
    "own", "'https://example.com/p'", "own",
)
MESSAGES = f"""
WITH m AS (
  SELECT doc_id, text, split_part(text, ' ', 1) AS word,
         CASE WHEN source = '{fx.RULED_SOURCE}' THEN 'briefsmi' ELSE source END AS agency
  FROM documents WHERE source IS NOT NULL AND text IS NOT NULL AND doc_id % 10 <> 6),
u AS (SELECT *, 'https://t.me/' || agency || '/' || doc_id || CASE WHEN doc_id % 50 = 33 THEN '?single' ELSE '' END AS url
      FROM m),
b AS (
  SELECT *, 'https://t.me/' || agency || '/' || doc_id AS own, {case_of('doc_id', BODY_TEXTS)} AS whole,
         {case_of('doc_id', HEADLINES)} AS title FROM u),
r AS (
  SELECT *, CASE WHEN agency = 'briefsmi' THEN split_part(string_split(whole, ': ')[-1], '#', 1) ELSE whole END AS ruled
  FROM b),
h AS (SELECT *, {headline_closed('ruled', 'title')} AS closed FROM r)
SELECT url,
       CASE WHEN doc_id % 50 <> 44 THEN TIMESTAMP '2023-01-01 03:00:00' + to_minutes(CAST(doc_id % 500 AS INT)) END AS date,
       {cleaned('closed', 'agency')} AS news,
       {case_of('doc_id', LINKS)} AS links,
       agency,
       CASE WHEN doc_id % 50 <> 33 THEN doc_id END AS id,
       CASE doc_id % 50 WHEN 33 THEN 'id' WHEN 44 THEN 'date' END AS parse_error
FROM h
"""
register("parse_message", MESSAGES)
register("parse_message_regular", MESSAGES)

# --- validation ------------------------------------------------------------------

register(
    "valid_url",
    f"""
WITH x AS (
  SELECT page_id, CASE page_id % 13
    WHEN 1 THEN 'ftp://' || string_split(url, '://')[-1]
    WHEN 2 THEN string_split(url, '://')[-1]
    WHEN 3 THEN 'http://localhost/' || page_id
    WHEN 4 THEN '  ' || url || chr(10)
    WHEN 5 THEN url || '/a b'
    WHEN 6 THEN 'http://10.0.0.1:8080/x?' || page_id
    WHEN 7 THEN 'HTTPS://user:pw@новости.рф/ы?q=' || page_id
    WHEN 8 THEN 'http://example.com:' || (65000 + page_id % 1000)
    WHEN 9 THEN url || '#' || repeat('a', {BULKY_PAGE_ADDRESS})
    WHEN 10 THEN 'http://[2001:db8::1]:80/' || page_id
    WHEN 11 THEN NULL ELSE url END AS url FROM pages)
SELECT page_id, url, {valid_address('url')} AS is_valid FROM x
""",
)
register(
    "validate_short_split",
    f"""
WITH {checked(SHORT_RULES)}
SELECT doc_id, url, date, news, links, agency, array_to_string(errors, ',') AS errors FROM checked
""",
)
register(
    "validate_final",
    f"""
WITH {checked(FINAL_RULES)}
SELECT doc_id, url, date, title, resume, links, news, category, agency FROM checked WHERE len(errors) = 0
""",
)
register(
    "rejects_by_reason",
    f"""
WITH {checked(FINAL_RULES)}, reasons AS (SELECT unnest(errors) AS reason FROM checked)
SELECT reason, count(*) AS rows FROM reasons GROUP BY reason
""",
)
register(
    "validation_counts",
    f"""
WITH {checked(FINAL_RULES)}
SELECT count(*) FILTER (len(errors) = 0) AS len_news, count(*) FILTER (len(errors) > 0) AS len_errors FROM checked
""",
)

# --- enrichment --------------------------------------------------------------------

IS_NEWS = "category NOT IN ('other', 'not_news')"
register(
    "category_filter", f"WITH {NEWS}, {LABELLED} SELECT doc_id, url, category FROM labelled WHERE {IS_NEWS}"
)
register(
    "category_override",
    f"""
WITH {AGENCIES}, {NEWS}, {LABELLED}, mono AS ({MONO})
SELECT doc_id, agency, coalesce(mono_category, category) AS category FROM labelled LEFT JOIN mono ON telegram = agency
""",
)
register(
    "spread_lookup",
    """
SELECT doc_id, d.source, of_source
FROM documents d LEFT JOIN (SELECT source, count(doc_id) AS of_source FROM documents GROUP BY source) c ON d.source = c.source
""",
)
register("truncate_tokens", f"SELECT doc_id, {window_of('text')} AS text FROM documents")
register("summarize", f"SELECT doc_id, {summary('text')} AS resume FROM documents")
register("headline", f"SELECT doc_id, {title('text')} AS title FROM documents")
ENRICHED = f"""
WITH {AGENCIES}, {NEWS}, {LABELLED}, mono AS ({MONO})
SELECT url, date, {title('news')} AS title, {summary('news')} AS resume, links, news,
       coalesce(mono_category, category) AS category, agency
FROM labelled LEFT JOIN mono ON telegram = agency WHERE {IS_NEWS}
"""
register("enrich_news", ENRICHED)
register(
    "resume_backfill",
    f"""
WITH {HISTORY},
made AS (
  SELECT url, date, trim(replace({summary('news')}, '''', '`'), {WHITESPACE}) AS resume FROM history WHERE {MISSING}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY date, resume) AS place FROM made),
updates AS (SELECT url, resume FROM ranked WHERE place = 1)
SELECT o_orderkey, h.url, date, CASE WHEN u.url IS NULL THEN h.resume ELSE u.resume END AS resume
FROM history h LEFT JOIN updates u ON u.url = h.url
""",
)

# --- metrics and jobs ------------------------------------------------------------------

register(
    "batch_position",
    """
WITH x AS (
  SELECT source AS agency, TIMESTAMP '2023-01-01 00:00:00' + to_minutes(CAST((doc_id // 40) % 500 AS INT)) AS date,
         'https://t.me/' || source || '/' || (doc_id // 40) AS url FROM documents)
SELECT agency, date, url, row_number() OVER (PARTITION BY agency ORDER BY date, url) AS place,
       count(*) OVER (PARTITION BY agency) AS total FROM x
""",
)
register(
    "collected_per_agency",
    """
SELECT source AS agency, grouping(source) = 1 AS is_total, count(*) AS news_amount FROM documents GROUP BY ROLLUP (source)
""",
)
register(
    "enrich_counts",
    f"""
WITH {NEWS}, {LABELLED}
SELECT count(*) FILTER ({IS_NEWS}) AS processed, count(*) FILTER (NOT {IS_NEWS}) AS skipped FROM labelled
""",
)
register(
    "throughput_rate",
    """
WITH x AS (
  SELECT event_type, count(*) AS items, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS seconds
  FROM events GROUP BY event_type)
SELECT event_type, items, round(seconds / 60, 2) AS minutes, round(seconds / (items + 0.000001), 2) AS sec_per_item FROM x
""",
)
register(
    "enrich_rate",
    """
WITH x AS (
  SELECT event_type, count(*) AS items, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS seconds
  FROM events GROUP BY event_type)
SELECT event_type, items, round(seconds / 60, 2) AS minutes, round(seconds / (items + 0.01), 2) AS sec_per_item FROM x
""",
)
register(
    "tomorrow_in_zone",
    "SELECT event_id, CAST(ts + INTERVAL 3 HOUR AS DATE) + 1 AS tomorrow FROM events",
)
register(
    "classify_text",
    """
WITH words AS (SELECT doc_id, lang, unnest(list_filter(string_split_regex(text, '[ \\n]+'), lambda w: w <> '')) AS term FROM documents),
own AS (SELECT doc_id, term, count(*) AS n FROM words GROUP BY ALL),
model AS (SELECT lang AS label, term, CAST(round(ln(count(*) + 1) * 1000000) AS BIGINT) AS weight FROM words WHERE lang IS NOT NULL GROUP BY ALL),
totals AS (
  SELECT lang AS label, CAST(round(ln(count(*) + (SELECT count(DISTINCT term) FROM words WHERE lang IS NOT NULL)) * 1000000) AS BIGINT) AS total
  FROM words WHERE lang IS NOT NULL GROUP BY 1),
priors AS (SELECT lang AS label, CAST(round(ln(count(*)) * 1000000) AS BIGINT) AS prior FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL GROUP BY 1),
met AS (SELECT doc_id, label, sum(n * weight) AS met FROM own JOIN model USING (term) GROUP BY ALL),
sizes AS (SELECT doc_id, count(*) AS words FROM words GROUP BY 1),
scores AS (
  SELECT d.doc_id, p.label, prior + coalesce(met, 0) - coalesce(words, 0) * coalesce(total, (SELECT CAST(round(ln(count(DISTINCT term)) * 1000000) AS BIGINT) FROM words WHERE lang IS NOT NULL)) AS score
  FROM documents d CROSS JOIN priors p LEFT JOIN totals t ON t.label = p.label
  LEFT JOIN met m ON m.doc_id = d.doc_id AND m.label = p.label LEFT JOIN sizes s ON s.doc_id = d.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS place FROM scores)
SELECT doc_id, label AS category FROM ranked WHERE place = 1
""",
)
for name in ("publish_roundtrip", "publish_retry", "handover_conflict"):
    register(name, ENRICHED)
register(
    "collect_both_groups",
    f"""
WITH {NEWS}
SELECT url, CASE WHEN doc_id % 5 = 0 THEN 'error_table' WHEN doc_id % 2 = 0 THEN 'russian' ELSE 'foreign' END AS target FROM news_v
""",
)
register("dead_letter", f"WITH {NEWS} SELECT url, news, agency FROM news_v")
register("query_with_parameter", f"WITH {NEWS} SELECT url, date, agency FROM news_v WHERE agency = 'src5'")
_BROKEN_RULES = ", ".join(f"CASE WHEN NOT coalesce({rule}, false) THEN '{name}' END" for name, rule in SHORT_RULES.items())
for name in ("collect_pages", "stream_pages"):
    register(
        name,
        f"""
WITH message AS ({MESSAGES}),
polled AS (
  SELECT CASE WHEN source = '{fx.RULED_SOURCE}' THEN 'briefsmi' ELSE source END AS agency, unnest([
           CASE WHEN n <= 4 OR n % 3 = 0 THEN 'russian' END, CASE WHEN n <= 4 OR n % 3 = 1 THEN 'foreign' END]) AS target
  FROM (SELECT DISTINCT source, CAST(source[4:] AS INT) AS n FROM documents WHERE source IS NOT NULL)),
met AS (
  SELECT message.*, target, array_to_string(list_filter([{_BROKEN_RULES}], lambda e: e IS NOT NULL), ',') AS broken
  FROM message JOIN (SELECT * FROM polled WHERE target IS NOT NULL) USING (agency))
SELECT url, date, news, links, agency, broken AS errors, CASE WHEN broken = '' THEN target ELSE 'error_table' END AS target
FROM met WHERE parse_error IS NULL
UNION ALL
SELECT DISTINCT url, date, news, links, agency, parse_error AS errors, 'error_table' AS target FROM met WHERE parse_error IS NOT NULL
""",
    )
register(
    "backfill_store",
    "SELECT * EXCLUDE (o_orderkey) FROM (" + ORACLES["resume_backfill"] + ")",
)
register(
    "stream_ingest",
    f"""
WITH {NEWS}
SELECT url, date, CASE WHEN doc_id % 25 = 0 THEN '' ELSE news END AS news, links, agency,
       CASE WHEN doc_id % 25 = 0 THEN 'error_table' ELSE 'news' END AS target
FROM news_v WHERE doc_id % 4 <> 3
""",
)
register(
    "collect_slice",
    f"""
WITH x AS (
  SELECT source AS agency, {cleaned('text', 'source')} AS news FROM documents WHERE doc_id % 4 = 0)
SELECT agency, count(*) FILTER (length(news) >= 1) AS news_amount, count(*) FILTER (length(news) < 1) AS rejects
FROM x GROUP BY agency
""",
)
