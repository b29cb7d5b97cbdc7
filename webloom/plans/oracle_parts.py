"""SQL text shared by the check queries (DuckDB dialect)."""

from __future__ import annotations

import html.entities

from webloom.functions import html as H
from webloom.functions import text as txt
from webloom.functions import urls as U
from webloom.plans import inputs


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def rx(pattern: str) -> str:
    """A pattern as a literal; the check engine has no possessive quantifiers and no need."""
    for q in "*+?":
        pattern = pattern.replace(f"{q}+", q)
    return lit(pattern)


# ---------------------------------------------------------------------- URLs


def scheme(u: str) -> str:
    return f"lower(regexp_extract({u}, {rx(U.SPLIT_URL)}, 1))"


def domain(u: str) -> str:
    host = f"regexp_extract(regexp_extract({u}, {rx(U.SPLIT_URL)}, 2), '([^@]*)$', 1)"
    return f"split_part({host}, ':', 1)"


def raw_path(u: str) -> str:
    return f"regexp_extract({u}, {rx(U.SPLIT_URL)}, 3)"


def path(u: str) -> str:
    return f"url_decode({raw_path(u)})"


def canonical(u: str) -> str:
    return f"'https://' || {domain(u)} || {path(u)}"


def sanitized(p: str) -> str:
    return f"CASE WHEN {p} = '' THEN 'empty' ELSE regexp_replace({p}, '[^a-zA-Z0-9_-]', '_', 'g') END"


# ---------------------------------------------------------------------- HTML


def _filled(block: str) -> str:
    out = lit(block)
    values = {
        "{id}": "p.page_id::varchar",
        **{f"{{id{n}}}": f"(p.page_id % {n})::varchar" for n in (3, 5, 7)},
        "{hub}": "hub",
        "{parent}": "parent",
    }
    for mark, value in values.items():
        if mark in block:
            out = f"replace({out}, {lit(mark)}, coalesce({value}, '#none'))"
    return out


NUMBERED_PAGES = r"""numbered AS (SELECT page_id,
  regexp_replace(url, '^([^?#]*)', '\1/' || page_id) AS url, html FROM pages)"""


def marked_cte(name: str = "marked", parent: str = "q.address", pages: str = "pages") -> str:
    return f"""{name}_known AS (SELECT page_id, {canonical('url')} AS address FROM {pages}),
{name} AS (
  SELECT p.page_id, p.url,
    replace(replace(p.html, '</head>', {_filled(inputs.HEAD_BLOCK)}),
            '<body>', {_filled(inputs.BODY_BLOCK)}) AS html
  FROM (SELECT p.*, h.address AS hub, {parent} AS parent FROM {pages} p
        LEFT JOIN {name}_known h ON h.page_id = p.page_id % 10
        LEFT JOIN {name}_known q ON q.page_id = p.page_id // 2) p
)"""


def _mask(block: str) -> str:
    opening = f"regexp_extract({block}, {rx(H.OPENING_TAG)})"
    closing = f"regexp_extract({block}, {rx(H.CLOSING_TAG)})"
    body = (
        f"substring({block}, length({opening}) + 1, "
        f"length({block}) - length({opening}) - length({closing}))"
    )
    return f"""CASE WHEN {block} IS NULL OR starts_with({block}, '<!--') THEN ''
      WHEN regexp_matches({block}, {rx(H.ESCAPABLE_START)})
        THEN {opening} || replace({body}, '<', '&lt;') || {closing}
      ELSE {opening} || replace(replace({body}, '&', '&amp;'), '<', '&lt;') || {closing} END"""


def _map(entries: dict) -> str:
    return "MAP {" + ", ".join(f"{k}: {lit(v)}" for k, v in entries.items()) + "}"


_ENTITIES = _map({lit(k): v for k, v in html.entities.html5.items()})
# Numbers of the Windows range that have a character there.
_WINDOWS = _map(
    {k: bytes([k]).decode("cp1252") for k in range(128, 160) if k not in (129, 141, 143, 144, 157)}
)
_OLD = "|".join(
    sorted((k for k in html.entities.html5 if k[-1] != ";"), key=len, reverse=True)
)


def masked_cte(source: str = "marked", name: str = "masked") -> str:
    """page_id, url, masked and the character reference table."""
    return f"""{name}_cut AS (
  SELECT page_id, url, string_split_regex(html, {rx(H.INERT)}) AS txt,
         regexp_extract_all(html, {rx(H.INERT)}) AS blk FROM {source}),
{name} AS MATERIALIZED (
  SELECT page_id, url, array_to_string(list_transform(range(1, len(txt) + 1),
    lambda i: txt[i] || {_mask('blk[i]')}), '') AS masked, {_ENTITIES} AS ents, {_WINDOWS} AS wins
  FROM {name}_cut)"""


def pages_ctes() -> str:
    return marked_cte() + ",\n" + masked_cte()


def decode(text: str, attribute: bool = False) -> str:
    digits, hexes = "regexp_extract(pc, '^#0*([0-9]+)', 1)", "regexp_extract(pc, '^#[xX]0*([0-9a-fA-F]+)', 1)"
    number = f"""CASE WHEN length({digits}) > 7 OR length({hexes}) > 6 THEN -1
      WHEN {digits} <> '' THEN {digits}::bigint ELSE ('0x' || {hexes})::bigint END"""
    character = f"""CASE WHEN wins[{number}] IS NOT NULL THEN wins[{number}]
      WHEN {number} < 1 OR {number} > 1114111 OR {number} BETWEEN 55296 AND 57343 THEN chr(65533)
      ELSE chr(({number})::int) END"""
    numeric = "'^#([0-9]+|[xX][0-9a-fA-F]+);?'"
    name, old = "regexp_extract(pc, '^[A-Za-z][A-Za-z0-9]*;')", f"regexp_extract(pc, '^({_OLD})')"
    bare = f"AND NOT regexp_matches(substring(pc, length({old}) + 1, 1), '[A-Za-z0-9=]')" if attribute else ""
    piece = f"""CASE WHEN pi = 1 THEN pc
      WHEN regexp_matches(pc, {numeric})
        THEN {character} || substring(pc, length(regexp_extract(pc, {numeric})) + 1)
      WHEN ents[{name}] IS NOT NULL THEN ents[{name}] || substring(pc, length({name}) + 1)
      WHEN {old} <> '' {bare} THEN ents[{old}] || substring(pc, length({old}) + 1)
      ELSE '&' || pc END"""
    return (
        f"CASE WHEN contains({text}, '&') THEN array_to_string(list_transform("
        f"string_split({text}, '&'), lambda pc, pi: {piece}), '') ELSE {text} END"
    )


def tags(element: str, masked: str = "masked") -> str:
    return f"regexp_extract_all({masked}, {rx(H.start_tag_pattern(element))})"


def attribute(tag: str, name: str) -> str:
    names = (
        f"list_transform(regexp_extract_all({tag}, {rx(H.ATTRIBUTE)}, 1), lambda an: lower(an))"
    )
    at = f"list_position({names}, {lit(name)})"
    raw = f"coalesce(regexp_extract_all({tag}, {rx(H.ATTRIBUTE)}, 2)[{at}], '')"
    bare = (
        f"CASE WHEN {raw}[1] IN ('\"', '''') THEN substring({raw}, 2, length({raw}) - 2) "
        f"ELSE {raw} END"
    )
    return f"CASE WHEN {at} > 0 THEN {decode('(' + bare + ')', True)} END"


def attributes(element: str, name: str) -> str:
    return f"list_transform({tags(element)}, lambda tg: {attribute('tg', name)})"


def targets() -> str:
    return f"list_transform({tags('a')}, lambda tg: coalesce({attribute('tg', 'href')}, ''))"


def link_class(v: str) -> str:
    endings = " OR ".join(f"ends_with({v}, '{e}')" for e in H.FILE_ENDINGS)
    return (
        f"CASE WHEN starts_with({v}, 'https') THEN 'https' WHEN starts_with({v}, 'http') "
        f"THEN 'http' WHEN {endings} THEN 'files' ELSE 'internal' END"
    )


def element_texts(element: str, cut: str) -> str:
    pieces = f"string_split_regex(masked, {rx(H.start_tag_pattern(element))})[2:]"
    text = (
        f"regexp_replace(string_split_regex(bd, {rx('(?i)' + cut)})[1], {rx("(?s)" + H.ANY_TAG)}, '', 'g')"
    )
    return f"list_transform(list_transform({pieces}, lambda bd: {text}), lambda el: {decode('el')})"


def headings(level: int) -> str:
    return element_texts(f"h{level}", H.HEADING_CUT)


def paragraphs() -> str:
    return element_texts("p", H.PARAGRAPH_CUT)


def title() -> str:
    return f"array_to_string({element_texts('title', H.TITLE_CUT)}, '')"


def internal_urls(links: str, url: str = "url") -> str:
    site = f"{scheme(url)} || '://' || {domain(url)}"
    kept = (
        f"list_filter({links}, lambda v: NOT (starts_with(v, '//') OR starts_with(v, 'mailto') "
        "OR starts_with(v, 'tel') OR starts_with(v, '#') OR v IN ('', '/')))"
    )
    return (
        f"list_transform({kept}, lambda v: CASE WHEN starts_with(v, '/') THEN {site} || v "
        f"ELSE {site} || '/' || v END)"
    )


def parsed_cte(masked: str = "masked", name: str = "parsed") -> str:
    """One row per page with the lists of the content record as columns."""
    by_class = ",\n    ".join(
        f"list_filter(hrefs, lambda v: {link_class('v')} = '{c}') AS {c}"
        for c in ("http", "https", "files", "internal")
    )
    return f"""{name}_lists AS MATERIALIZED (
  SELECT page_id, url, {targets()} AS hrefs, {tags('meta')} AS metas, ents, wins,
    list_filter({attributes('link', 'href')}, lambda v: v IS NOT NULL) AS link_hrefs,
    list_filter({attributes('script', 'src')}, lambda v: starts_with(v, 'https')) AS scripts,
    list_filter({attributes('img', 'src')}, lambda v: starts_with(v, 'https')) AS imgs,
    {title()} AS title, {headings(1)} AS h1, {headings(2)} AS h2, {paragraphs()} AS p
  FROM {masked}),
{name} AS MATERIALIZED (
  SELECT page_id, url, title, h1, h2, p, scripts, imgs, metas, ents, wins, hrefs,
    list_filter(link_hrefs, lambda v: ends_with(v, '.css')) AS styles,
    list_filter(link_hrefs, lambda v: ends_with(v, '.png') OR ends_with(v, '.ico')) AS logo,
    {by_class}
  FROM {name}_lists)"""


# ---------------------------------------------------------------------- tags


def keyword_rows(text: str, keywords: dict[str, list[str]]) -> str:
    """List of keyword tags of a lower-cased text."""
    cases = ", ".join(
        "CASE WHEN "
        + " OR ".join(f"contains({text}, {lit(w)})" for w in words)
        + f" THEN {lit(tag)} END"
        for tag, words in keywords.items()
    )
    return f"list_filter([{cases}], lambda v: v IS NOT NULL)"


_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def phrase_list(segments: str, patterns: list[str]) -> str:
    found = " || ".join(f"regexp_extract_all(lower(sg), {rx(p)}, 1)" for p in patterns)
    phrases = f"flatten(list_transform({segments}, lambda sg: {found}))"
    pieces = (
        f"flatten(list_transform({phrases}, lambda ph: "
        f"string_split_regex(trim(ph, {_BLANK}), '\\s*(?:,|y|and)\\s*')))"
    )
    trimmed = f"list_transform({pieces}, lambda pc: trim(pc, {_BLANK}))"
    return (
        f"list_distinct(list_filter({trimmed}, lambda pc: strlen(pc) > 2 "
        "AND len(string_split_regex(pc, '\\s+')) <= 4))"
    )


def flag_list(conditions: list[tuple[str, str]]) -> str:
    cases = ", ".join(f"CASE WHEN {c} THEN {lit(tag)} END" for tag, c in conditions)
    return f"list_filter([{cases}], lambda v: v IS NOT NULL)"


def contains_any(text: str, words: list[str]) -> str:
    return " OR ".join(f"contains({text}, {lit(w)})" for w in words)


# --------------------------------------------------------------------- index


def token_rows(source: str, key: str = "doc_id", text: str = "text") -> str:
    return f"""SELECT {key} AS doc_key, unnest(string_split_regex(trim(regexp_replace(
    lower({text}), '[^{txt.TOKEN_CHARS}]+', ' ', 'g')), '\\s+')) AS token FROM {source}"""


def index_ctes(source: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """tf (token, doc_key, tf), df and idf of a text table."""
    return f"""tok AS ({token_rows(source, key, text)}),
tf AS (SELECT token, doc_key, count(*) AS tf FROM tok WHERE token <> '' GROUP BY ALL),
df AS (SELECT token, count(*) AS doc_freq FROM tf GROUP BY token),
idf AS (SELECT token, doc_freq,
  ln(((SELECT count(*) FROM {source}) + 1) / (doc_freq + 1)) AS idf FROM df)"""


DOCUMENT_MAPPINGS = """mappings AS (SELECT doc_id AS doc_key,
  'https://' || source || '.example/' || lang || '/' || doc_id AS url,
  split_part(text, chr(10), 1) AS title, n_chars % 7 AS external_refs,
  0.15::double + (n_chars % 13) / 8.0::double AS pagerank FROM documents)"""


RANK_ORDER = (
    "exact DESC, round(content_score, 6) DESC, matches DESC, pagerank DESC, "
    "external_refs DESC, partial DESC, doc_key"
)
