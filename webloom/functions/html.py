"""HTML extraction with regular expressions, as Catalyst expressions and on Arrow batches.

A page is masked once (``mask_inert``). Afterwards every ``<tag`` that is left
is a real element, so start tags and attributes can be read with plain regular
expressions. The possessive quantifiers keep each scan linear and iterative.

Single fields are Catalyst expressions. ``parse_pages``, which takes all of them, reads
the lists of a page in a small helper on Arrow batches with the same patterns: Spark's
functions on arrays are interpreted value by value, at some ten times the cost.
"""

from __future__ import annotations

import html.entities
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WS = r" \t\n\f\r"

# Inside a tag, a quoted string counts as one unit only right after "=".
_TAG_REST = rf"""(?:=[{WS}]*+"[^"]*+"|=[{WS}]*+'[^']*+'|[^>])*+>"""

# Elements whose body is text, never markup. In the escapable ones character
# references still count.
RAW_ELEMENTS = ("script", "style", "noscript", "iframe", "noembed", "noframes", "xmp")
ESCAPABLE_ELEMENTS = ("title", "textarea")

INERT = (
    "(?is)<(?:!--(?:-?>|.*?(?:--!?>|\\z))"
    + "".join(
        rf"|{e}(?:[{WS}/]{_TAG_REST}|>).*?(?:</{e}(?:[{WS}/][^>]*+)?>|\z)"
        for e in RAW_ELEMENTS + ESCAPABLE_ELEMENTS
    )
    + ")"
)
OPENING_TAG = rf"(?s)^<[^!]{_TAG_REST}"
CLOSING_TAG = r"</[A-Za-z]+[^>]*+>\z"
ESCAPABLE_START = rf"(?i)^<(?:{'|'.join(ESCAPABLE_ELEMENTS)})[{WS}/>]"

ANY_TAG = rf"</?[A-Za-z]{_TAG_REST}"
ATTRIBUTE = (
    rf"""([^{WS}/>=][^{WS}/>=]*+)"""
    rf"""(?:[{WS}]*+=[{WS}]*+("[^"]*+"|'[^']*+'|[^{WS}"'>][^{WS}>]*+))?+"""
)

# Tags that end an open paragraph.
PARAGRAPH_ENDS = (
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h[1-6] header hgroup hr html li listing main "
    "menu nav ol p pre search section summary table tbody td th tr ul"
).split()
PARAGRAPH_CUT = rf"</?(?:{'|'.join(PARAGRAPH_ENDS)})(?:[{WS}/][^>]*+)?>"
HEADING_CUT = rf"</?h[1-6](?:[{WS}/][^>]*+)?>"
HEADING_BLOCK = rf"(?is)<h[12](?:[{WS}/]{_TAG_REST}|>).*?(?={HEADING_CUT}|\z)"
TITLE_CUT = rf"</title(?:[{WS}/][^>]*+)?>"
TITLE_BLOCK = rf"(?is)<title(?:[{WS}/]{_TAG_REST}|>).*?(?={TITLE_CUT}|\z)"

# Link endings that mark a file.
FILE_ENDINGS = "pdf xlsx xls docx doc pptx ppt txt csv zip rar".split()

# Names with ';' and old names without, from the standard library's table.
_ALL_NAMES = dict(sorted(html.entities.html5.items()))
# Looked up first, as a map is searched from its start.
_COMMON_NAMES = {n: _ALL_NAMES[n] for n in ("amp;", "lt;", "gt;", "quot;", "apos;", "nbsp;")}
_OLD_NAME = "^(?:{})".format(
    "|".join(sorted((n for n in _ALL_NAMES if not n.endswith(";")), key=lambda n: (-len(n), n)))
)
# Numbers 128 to 159 mean what Windows calls them, where it has a character there.
_CONTROL_RANGE = "".join(
    bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)
)


def start_tag_pattern(element: str) -> str:
    return rf"(?is)<(?:{element})(?:[{WS}/]{_TAG_REST}|>)"


# ---------------------------------------------------------------- characters


def _character(code: Column) -> Column:
    """The character of a numeric reference. ``code`` is a plain name, or costs twice."""
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    safe = F.when(valid, code).otherwise(F.lit(0xFFFD))
    plain = F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")
    high = F.get(F.split(F.lit(_CONTROL_RANGE), ""), (code - 0x80).cast("int"))
    return F.when(code.between(0x80, 0x9F), high).otherwise(plain)


def _number(digits: Column, base: int) -> Column:
    """Value of a digit string of any length; whatever is out of range becomes -1."""
    plain = F.regexp_replace(digits, "^0+(?=.)", "")
    return F.when(F.length(plain) > 7, F.lit(-1)).otherwise(F.conv(plain, base, 10).cast("bigint"))


def _named(name: Column) -> Column:
    """Characters of a reference's name, which ends in ';' or is one of the old ones."""
    return F.coalesce(
        F.try_element_at(_table(_COMMON_NAMES), name), F.try_element_at(_table(_ALL_NAMES), name)
    )


def _table(names: dict[str, str]) -> Column:
    values = F.split(F.lit("\x01".join(names.values())), "\x01")
    return F.map_from_arrays(F.split(F.lit("\x01".join(names)), "\x01"), values)


def decode_entities(text: Column, attribute: bool = False) -> Column:
    """Character references: all names, old names without ';', numbers of any length.

    In an attribute an old name without ';' stays as it is before a letter, a digit or
    '='. ``text`` occurs several times in the result, so it should be a plain column
    or a lambda variable. The steps are chained transforms for the same reason: each
    gives its result a name that the next one can use freely.
    """
    old_name = _OLD_NAME + ("(?![A-Za-z0-9=])" if attribute else "")
    pieces = F.transform(
        F.split(text, "&"),
        lambda p: F.struct(
            p.alias("piece"),
            F.regexp_extract(p, "^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0).alias("number"),
            F.regexp_extract(p, "^[A-Za-z][A-Za-z0-9]*+;", 0).alias("name"),
            F.regexp_extract(p, old_name, 0).alias("old"),
        ),
    )
    coded = F.transform(
        pieces,
        lambda p: F.struct(
            p["piece"].alias("piece"),
            p["number"].alias("number"),
            p["old"].alias("old"),
            p["name"].alias("name"),
            F.when(p["name"] != "", _named(p["name"])).alias("whole"),
            F.when(
                p["number"].rlike("^#[xX]"), _number(F.regexp_extract(p["number"], "^#.([^;]+)", 1), 16)
            )
            .when(p["number"] != "", _number(F.regexp_extract(p["number"], "^#([^;]+)", 1), 10))
            .alias("code"),
        ),
    )

    def rest(p: Column, reference: Column) -> Column:
        return p["piece"].substr(F.length(reference) + 1, F.length(p["piece"]))

    decoded = F.transform(
        coded,
        lambda p, i: F.when(i == 0, p["piece"])
        .when(p["number"] != "", F.concat(_character(p["code"]), rest(p, p["number"])))
        .when(p["whole"].isNotNull(), F.concat(p["whole"], rest(p, p["name"])))
        .when(p["old"] != "", F.concat(_named(p["old"]), rest(p, p["old"])))
        .otherwise(F.concat(F.lit("&"), p["piece"])),
    )
    return F.when(text.contains("&"), F.array_join(decoded, "")).otherwise(text)


def _decode_all(texts: Column, attribute: bool = False) -> Column:
    return F.transform(texts, lambda t: decode_entities(t, attribute))


# ------------------------------------------------------------ masking, tags


def _masked_block(b: Column) -> Column:
    """Keep the element's own tags, turn its body into inert text; drop comments."""
    body = b["block"].substr(
        F.length(b["opening"]) + 1,
        F.length(b["block"]) - F.length(b["opening"]) - F.length(b["closing"]),
    )
    kept = F.when(b["block"].rlike(ESCAPABLE_START), body).otherwise(
        F.replace(body, F.lit("&"), F.lit("&amp;"))
    )
    return F.when(b["block"].startswith("<!--"), F.lit("")).otherwise(
        F.concat(b["opening"], F.replace(kept, F.lit("<"), F.lit("&lt;")), b["closing"])
    )


def mask_inert(page: Column) -> Column:
    """Drop comments and escape markup-like text in script, style, title and the like."""
    blocks = F.transform(
        F.regexp_extract_all(page, F.lit(INERT), F.lit(0)),
        lambda b: F.struct(
            b.alias("block"),
            F.regexp_extract(b, OPENING_TAG, 0).alias("opening"),
            F.regexp_extract(b, CLOSING_TAG, 0).alias("closing"),
        ),
    )
    inert = F.transform(blocks, _masked_block)
    between = F.split(page, INERT, -1)
    return F.array_join(
        F.zip_with(between, inert, lambda t, b: F.concat(t, F.coalesce(b, F.lit("")))), ""
    )


def start_tags(masked: Column, element: str) -> Column:
    """Start tags of an element, or of several given as a pattern like ``a|img``."""
    return F.regexp_extract_all(masked, F.lit(start_tag_pattern(element)), F.lit(0))


def tags_of(tags: Column, element: str) -> Column:
    return F.filter(tags, lambda t: t.rlike(rf"(?i)^<{element}[{WS}/>]"))


def tag_attributes(tags: Column) -> Column:
    """array<struct<names, values>> of start tags; '' for an attribute without a value."""
    found = F.transform(
        tags,
        lambda t: F.struct(
            F.regexp_extract_all(t, F.lit(ATTRIBUTE), F.lit(1)).alias("names"),
            F.regexp_extract_all(t, F.lit(ATTRIBUTE), F.lit(2)).alias("values"),
        ),
    )
    return F.transform(
        found,
        lambda a: F.struct(
            F.transform(a["names"], lambda n: F.lower(n)).alias("names"),
            F.transform(a["values"], _unquoted).alias("values"),
        ),
    )


def _unquoted(value: Column) -> Column:
    quoted = value.startswith('"') | value.startswith("'")
    return F.when(quoted, value.substr(F.lit(2), F.length(value) - 2)).otherwise(value)


def _raw_values(attributes: Column, name: str) -> Column:
    """One attribute of each tag, null where absent; the first of a repeated name counts."""
    return F.transform(
        attributes, lambda a: F.get(a["values"], F.array_position(a["names"], name).cast("int") - 1)
    )


def attribute_values(masked: Column, element: str, name: str) -> Column:
    """The attribute of every such element in page order, null where absent."""
    return _decode_all(_raw_values(tag_attributes(start_tags(masked, element)), name), True)


def _without_tags(fragments: Column, cut: str | None = None) -> Column:
    """Fragments without their tags and without everything from the first ``cut`` on."""
    drop = f"(?is){cut}.*|{ANY_TAG}" if cut else ANY_TAG
    return F.transform(fragments, lambda f: F.regexp_replace(f, drop, ""))


def _raw_headings(blocks: Column, level: int) -> Column:
    return _without_tags(F.filter(blocks, lambda b: F.substring(b, 3, 1) == str(level)))


def _raw_paragraphs(masked: Column) -> Column:
    pieces = F.split(masked, start_tag_pattern("p"), -1)
    return _without_tags(F.filter(pieces, lambda _, i: i > 0), PARAGRAPH_CUT)


def _raw_titles(masked: Column) -> Column:
    return _without_tags(F.regexp_extract_all(masked, F.lit(TITLE_BLOCK), F.lit(0)))


def heading_blocks(masked: Column) -> Column:
    """h1 and h2 elements, each from its start tag to the next heading tag."""
    return F.regexp_extract_all(masked, F.lit(HEADING_BLOCK), F.lit(0))


def headings(masked: Column, level: int) -> Column:
    return _decode_all(_raw_headings(heading_blocks(masked), level))


def paragraphs(masked: Column) -> Column:
    return _decode_all(_raw_paragraphs(masked))


def title(masked: Column) -> Column:
    """One element: the text of all titles run together, '' without a title."""
    return F.array(F.array_join(_decode_all(_raw_titles(masked)), ""))


# ------------------------------------------------------------------- fields


def link_targets(masked: Column) -> Column:
    """``href`` of every anchor, '' where it has none."""
    return F.transform(
        attribute_values(masked, "a", "href"), lambda v: F.coalesce(v, F.lit(""))
    )


def link_class(link: Column) -> Column:
    """First match wins: https, http, files (by ending), else internal."""
    is_file = reduce(lambda a, b: a | b, [link.endswith(e) for e in FILE_ENDINGS])
    return (
        F.when(link.startswith("https"), "https")
        .when(link.startswith("http"), "http")
        .when(is_file, "files")
        .otherwise("internal")
    )


def links_of_class(targets: Column, cls: str) -> Column:
    return F.filter(targets, lambda v: link_class(v) == cls)


def stylesheets(link_hrefs: Column) -> Column:
    return F.filter(link_hrefs, lambda v: v.endswith(".css"))


def logos(link_hrefs: Column) -> Column:
    return F.filter(link_hrefs, lambda v: v.endswith(".png") | v.endswith(".ico"))


def https_only(values: Column) -> Column:
    return F.filter(values, lambda v: v.startswith("https"))


def present(values: Column) -> Column:
    return F.filter(values, lambda v: v.isNotNull())


def meta_charsets(masked: Column) -> Column:
    return present(attribute_values(masked, "meta", "charset"))


def named_metas(charsets: Column, names: Column, contents: Column) -> Column:
    """array<struct<name, content>> of metas with a name and no charset, in page order.

    The three lists hold one entry per meta tag, null where it lacks the attribute.
    """
    rows = F.arrays_zip(charsets.alias("charset"), names.alias("name"), contents.alias("content"))
    rows = rows.cast("array<struct<charset:string,name:string,content:string>>")
    named = F.filter(rows, lambda r: r["charset"].isNull() & r["name"].isNotNull())
    return F.transform(
        named,
        lambda r: F.struct(
            r["name"].alias("name"), F.coalesce(r["content"], F.lit("")).alias("content")
        ),
    )


def link_hrefs(masked: Column) -> Column:
    return present(attribute_values(masked, "link", "href"))


def meta_map(pairs: Column) -> Column:
    """map<name, array<content>>; a repeated name appends."""
    names = F.array_distinct(F.transform(pairs, lambda p: p["name"]))
    return F.map_from_arrays(
        names,
        F.transform(
            names,
            lambda n: F.transform(
                F.filter(pairs, lambda p: p["name"] == n), lambda p: p["content"]
            ),
        ),
    )


# What ``parse_pages`` takes from start tags: (element, attribute).
_FIELDS = [
    ("a", "href"),
    ("link", "href"),
    ("script", "src"),
    ("img", "src"),
    ("meta", "charset"),
    ("meta", "name"),
    ("meta", "content"),
]
_TEXTS = 4  # first and second headings, paragraphs, titles


def _compiled(pattern: str) -> re.Pattern:
    """One of the patterns above in Python's dialect, where Java's ``\\z`` is ``\\Z``."""
    return re.compile(pattern.replace(r"\z", r"\Z"), re.ASCII)


_INERT_START = _compiled(
    rf"(?is)<(?:!--(-?>)?+|({'|'.join(RAW_ELEMENTS + ESCAPABLE_ELEMENTS)})(?:[{WS}/]{_TAG_REST}|>))"
)
_INERT_ENDS = {
    e: _compiled(rf"(?i)</{e}(?:[{WS}/][^>]*+)?>") for e in RAW_ELEMENTS + ESCAPABLE_ELEMENTS
}
_COMMENT_END = re.compile("--!?>")
_CLOSING = _compiled(CLOSING_TAG)
_FIELD_TAG = _compiled(
    rf"(?is)<({'|'.join(dict.fromkeys(e for e, _ in _FIELDS))})(?:[{WS}/]{_TAG_REST}|>)"
)
_ATTRIBUTE = _compiled(ATTRIBUTE)
_HEADING, _HEADING_CUT = _compiled(start_tag_pattern("h[12]")), _compiled(f"(?i){HEADING_CUT}")
_TITLE, _TITLE_CUT = _compiled(start_tag_pattern("title")), _compiled(f"(?i){TITLE_CUT}")
_PARAGRAPH = _compiled(start_tag_pattern("p"))
_TAG = _compiled(ANY_TAG)
_PARAGRAPH_REST = _compiled(f"(?is){PARAGRAPH_CUT}.*|{ANY_TAG}")
_REFERENCE = _compiled("&(?:#(?:[0-9]+|[xX][0-9a-fA-F]+);?|[A-Za-z][A-Za-z0-9]*+;?)")
_OLD, _OLD_IN_ATTRIBUTE = (
    _compiled(_OLD_NAME.removeprefix("^") + end) for end in ("", "(?![A-Za-z0-9=])")
)


def _referred(found: re.Match, old_name: re.Pattern) -> str:
    """What ``decode_entities`` makes of one reference."""
    name = found.group()[1:]
    if name[0] == "#":
        digits = name[1:].rstrip(";")
        plain = (digits[1:] if digits[0] in "xX" else digits).lstrip("0") or "0"
        code = -1 if len(plain) > 7 else int(plain, 16 if digits[0] in "xX" else 10)
        if 0x80 <= code <= 0x9F:
            return _CONTROL_RANGE[code - 0x80]
        return chr(code) if 0 < code < 0xD800 or 0xDFFF < code < 0x110000 else "\ufffd"
    if name in _ALL_NAMES and name[-1] == ";":
        return _ALL_NAMES[name]
    old = old_name.match(found.string, found.start() + 1)
    return _ALL_NAMES[old.group()] + name[len(old.group()) :] if old else found.group()


def _decoded(text: str, old_name: re.Pattern = _OLD) -> str:
    return _REFERENCE.sub(lambda r: _referred(r, old_name), text) if "&" in text else text


def _masked(page: str) -> str:
    """What ``mask_inert`` does, with a search for the end of each block."""
    out, at = [], 0
    while start := _INERT_START.search(page, at):
        out.append(page[at : start.start()])
        short, element = start.groups()
        if element is None:
            end = start if short else _COMMENT_END.search(page, start.end())
            at = end.end() if end else len(page)
            continue
        end = _INERT_ENDS[element.lower()].search(page, start.end())
        at = end.end() if end else len(page)
        block, opening = page[start.start() : at], start.group()
        closing = _CLOSING.search(block)
        closing = closing.group() if closing else ""
        body = block[len(opening) : len(block) - len(closing)]
        if element.lower() in RAW_ELEMENTS:
            body = body.replace("&", "&amp;")
        out += [opening, body.replace("<", "&lt;"), closing]
    return "".join(out) + page[at:]


def _until(masked: str, start: re.Pattern, cut: re.Pattern) -> Iterator[str]:
    """Pieces from a ``start`` to the next ``cut``."""
    at = 0
    while opening := start.search(masked, at):
        end = cut.search(masked, opening.end())
        at = end.start() if end else len(masked)
        yield masked[opening.start() : at]


def _lists_of(page: str) -> list[list[str | None]]:
    """The values of ``_FIELDS``, null where a tag lacks the attribute, then the texts."""
    masked = _masked(page)
    tags: dict[str, list[dict[str, str]]] = {e: [] for e, _ in _FIELDS}
    for tag in _FIELD_TAG.finditer(masked):
        values: dict[str, str] = {}
        for name, value in _ATTRIBUTE.findall(tag.group()):
            # The first of a repeated name counts.
            values.setdefault(name.lower(), value[1:-1] if value[:1] in ('"', "'") else value)
        tags[tag[1].lower()].append(values)
    lists = [
        [_decoded(a[name], _OLD_IN_ATTRIBUTE) if name in a else None for a in tags[element]]
        for element, name in _FIELDS
    ]
    headings = list(_until(masked, _HEADING, _HEADING_CUT))
    for level in "12":
        lists.append([_decoded(_TAG.sub("", h)) for h in headings if h[2] == level])
    lists.append([_decoded(_PARAGRAPH_REST.sub("", p)) for p in _PARAGRAPH.split(masked)[1:]])
    lists.append([_decoded(_TAG.sub("", t)) for t in _until(masked, _TITLE, _TITLE_CUT)])
    return lists


def _page_lists(pages: pa.Array) -> pa.Array:
    """Lists of each page, given as bytes: text with broken characters is no error."""
    nothing = [None] * (len(_FIELDS) + _TEXTS)
    rows = [
        _lists_of(p.as_py().decode("utf-8", "replace")) if p.is_valid else nothing for p in pages
    ]
    return pa.array(rows, pa.list_(pa.list_(pa.string())))


def parse_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Replace the HTML column by ``content``; other columns pass through.

    ``_page_lists`` reads and decodes all lists of a page; the projections after it sort
    the values into their fields.
    """
    others = [c for c in pages.columns if c != html_col]
    lists_of = F.arrow_udf(_page_lists, T.ArrayType(T.ArrayType(T.StringType())))
    texts = pages.select(*others, lists_of(F.col(html_col).cast("binary")).alias("_t"))
    part = [F.get("_t", F.lit(i)) for i in range(len(_FIELDS) + _TEXTS)]
    a_href, link_href, script_src, img_src, charset, name, meta_content, h1, h2, p, titles = part
    lists = texts.select(
        *others,
        F.transform(a_href, lambda v: F.coalesce(v, F.lit(""))).alias("_a"),
        present(link_href).alias("_link"),
        named_metas(charset, name, meta_content).alias("_named"),
        F.struct(https_only(img_src).alias("imgs")).alias("_imgs"),
        F.struct(h1.alias("h1"), h2.alias("h2"), p.alias("p")).alias("_texts"),
        https_only(script_src).alias("_scripts"),
        present(charset).alias("_charset"),
        F.array(F.array_join(titles, "")).alias("_title"),
    )
    a, link = F.col("_a"), F.col("_link")
    classes = ("http", "https", "files", "internal")
    return lists.select(
        *others,
        F.struct(
            F.struct(*[links_of_class(a, c).alias(c) for c in classes]).alias("links"),
            F.struct(
                F.col("_charset").alias("charset"),
                logos(link).alias("logo"),
                F.col("_scripts").alias("scripts"),
                stylesheets(link).alias("styles"),
                F.col("_title").alias("title"),
                meta_map(F.col("_named")).alias("other"),
            ).alias("metadata"),
            F.col("_imgs").alias("imgs"),
            F.col("_texts").alias("texts"),
        ).alias("content"),
    )


# --------------------------------------------------- response level helpers


def decode_body(body: Column, content_type: Column) -> Column:
    """Bytes to text: ISO-8859-1 if the content type says so, else UTF-8."""
    parts = F.split(content_type, "charset=")
    charset = F.lower(F.trim(F.get(parts, 1)))
    latin1 = F.decode(body, "ISO-8859-1")
    return F.when(charset == "iso-8859-1", latin1).otherwise(body.cast("string"))


def needs_render(page: Column) -> Column:
    """True if the page looks like a shell that a browser would have to fill."""
    low = F.lower(page)
    begin, end = F.instr(low, "<body"), F.instr(low, "</body>")
    body = low.substr(begin, end - begin)
    visible = F.length(body) - F.length(F.translate(body, "ap", ""))
    return (
        (F.octet_length(page) < 1000)
        | low.contains("<body></body>")
        | low.contains("<body/>")
        | ((begin > 0) & (end > begin) & (visible < 10))
        | low.contains('id="root"')
        | low.contains('id="app"')
        | low.contains("ng-app")
    )
