"""Page tags as Catalyst expressions: keywords, phrases, structure, URL.

Only the search for the words of a dictionary runs on Arrow batches: in a chain of
``contains`` each word costs a slow pass of its own over the text.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())
_FOUND = T.StructType([T.StructField("tags", _STRINGS), T.StructField("hits", _STRINGS)])


class Dictionary(NamedTuple):
    """A tagging dictionary. It is configuration and becomes part of the plan."""

    keywords: dict[str, list[str]]
    patterns: list[str]


# Tag -> words, and the phrases whose continuation becomes a tag.
KEYWORDS = {
    "empresa": ["empresa", "about", "nosotros", "compañía", "equipo", "misión", "visión"],
    "contacto": ["contacto", "email", "correo", "teléfono"],
    "producto": ["producto", "servicio", "oferta", "catálogo"],
    "noticias": ["blog", "noticia", "artículo"],
    "autenticacion": ["login", "registrarse", "usuario"],
    "educación": ["curso", "tutorial", "aprender", "formación"],
    "legal": ["privacidad", "términos", "condiciones"],
    "tecnología": ["api", "html", "css", "javascript", "backend", "frontend"],
}
LEADS = [
    "our company is",
    "we are",
    "we offer",
    "we provide",
    "we develop",
    "we build",
    "we create",
    "specialized in",
    "focused on",
    "experts in",
    "working with",
    "servicios de",
    "empresa de",
    "productos de",
    "expertos en",
    "especializados en",
    "enfocados en",
    "ofrecemos",
    "brindamos",
    "desarrollamos",
    "creamos",
]
PHRASE_GROUP = r"([a-záéíóúñ\s]+)"
CONNECTOR = r"\s*(?:,|y|and)\s*"
# Tags by page structure and by parts of the address.
STRUCTURE_TAGS = [
    ("marca", "metadata", "logo"),
    ("javascript", "metadata", "scripts"),
    ("css", "metadata", "styles"),
    ("sitio_seguro", "links", "https"),
    ("descargas", "links", "files"),
]
DOMAIN_TAGS = [("repositorio", ["github"]), ("ecommerce", ["shop", "store"]), ("blog", ["blog"])]
PATH_TAGS = [
    ("contacto", ["contact"]),
    ("autenticación", ["login", "signin"]),
    ("producto", ["product", "service"]),
    ("noticias", ["news", "blog"]),
]

DEFAULT_DICTIONARY = Dictionary(KEYWORDS, [f"{lead} {PHRASE_GROUP}" for lead in LEADS])


def _contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words], F.lit(False))


def _tags_if(conditions: list[tuple[str, Column]]) -> Column:
    none = F.array().cast("array<string>")
    if not conditions:
        return none
    return F.array_compact(F.array(*[F.when(c, F.lit(tag)) for tag, c in conditions]))


def _list(column: Column) -> Column:
    return F.coalesce(column, F.array().cast("array<string>"))


def text_segments(texts: Column) -> Column:
    """h1, h2 and p as one list."""
    return F.concat(_list(texts["h1"]), _list(texts["h2"]), _list(texts["p"]))


def _searched(segments: Column, keywords: dict[str, list[str]], starts: list[str]) -> Column:
    """struct<tags, hits>: tags with a word in the text, segments with any of ``starts``.

    Both are looked for in lower case; ``hits`` are as they were and null for null.
    """

    def search(lists: pa.Array) -> pa.Array:
        tags, hits = [], []
        for cells in lists.to_pylist():
            # Bytes, as text with broken characters is no error.
            segments = [c.decode("utf-8", "replace") for c in cells or () if c is not None]
            lowered = [s.lower() for s in segments]
            text = " ".join(lowered)
            tags.append([tag for tag, words in keywords.items() if any(w in text for w in words)])
            here = [x for x in starts if x in text]
            held = [s for s, low in zip(segments, lowered) if any(x in low for x in here)]
            hits.append(None if cells is None else held)
        strings = pa.list_(pa.string())
        return pa.StructArray.from_arrays([pa.array(tags, strings), pa.array(hits, strings)], _FOUND.names)

    return F.arrow_udf(search, _FOUND)(segments.cast("array<binary>"))


def keyword_tags(segments: Column, keywords: dict[str, list[str]] = KEYWORDS) -> Column:
    """Tags with at least one word that occurs anywhere in the text, also inside words."""
    return _searched(segments, keywords, [])["tags"]


def _literal_start(pattern: str) -> str:
    """Text that every match of a pattern begins with, '' if that is not plain to see."""
    if "|" in pattern:
        return ""
    start = re.match(r"[^\\.^$*+?{}\[\]()]*", pattern).group()
    return start[:-1] if pattern[len(start) : len(start) + 1] in ("*", "?", "{") else start


def _groups(pattern: str) -> bool:
    """Whether a pattern has a capturing group, by its text: the dialects differ."""
    plain = re.sub(r"\\.|\[\^?\]?(?:\\.|[^\]])*\]", "", pattern)
    return bool(re.search(r"\((?!\?)|\(\?P?<(?![=!])", plain))


def phrase_tags(segments: Column, patterns: list[str] = DEFAULT_DICTIONARY.patterns) -> Column:
    """Pieces of the first group of each pattern, cut at commas and connectors.

    Kept are pieces of more than two bytes and at most four words. Every pattern
    searches a segment on its own, but only where its literal start occurs. A
    pattern without a group has no phrase to give and is skipped.
    """
    patterns, starts = _searchable(patterns)
    return _phrases(_searched(segments, {}, starts)["hits"] if all(starts) else segments, patterns)


def _searchable(patterns: list[str]) -> tuple[list[str], list[str]]:
    """The patterns that have a phrase to give, and their literal starts."""
    patterns = [p for p in patterns if _groups(p)]
    return patterns, [_literal_start(p) for p in patterns]


def _phrases(segments: Column, patterns: list[str]) -> Column:
    none = F.array().cast("array<string>")
    if not patterns:
        return none
    starts = [_literal_start(p) for p in patterns]
    hits = F.transform(segments, lambda s: F.lower(s))
    phrases = F.flatten(
        F.transform(
            hits,
            lambda s: F.concat(
                *[
                    F.when(
                        s.contains(start), F.regexp_extract_all(s, F.lit(p), F.lit(1))
                    ).otherwise(none)
                    for p, start in zip(patterns, starts)
                ]
            ),
        )
    )
    pieces = F.transform(
        F.flatten(F.transform(phrases, lambda s: F.split(_strip(s), CONNECTOR, -1))), _strip
    )
    return F.array_distinct(
        F.filter(pieces, lambda p: (F.octet_length(p) > 2) & (F.size(F.split(p, r"\s+")) <= 4))
    )


def _strip(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\u000b\f\r"))


def structure_tags(content: Column) -> Column:
    return _tags_if(
        [(tag, F.size(_list(content[part][field])) > 0) for tag, part, field in STRUCTURE_TAGS]
    )


def url_tags(domain: Column, path: Column) -> Column:
    d, p = F.lower(domain), F.lower(path)
    return _tags_if(
        [(tag, _contains_any(d, words)) for tag, words in DOMAIN_TAGS]
        + [(tag, _contains_any(p, words)) for tag, words in PATH_TAGS]
    )


def page_tags(
    domain: Column, path: Column, content: Column, dictionary: Dictionary = DEFAULT_DICTIONARY
) -> Column:
    """All tags of a page, sorted and without duplicates."""
    segments = text_segments(content["texts"])
    patterns, starts = _searchable(dictionary.patterns)
    found = _searched(segments, dictionary.keywords, starts)
    return F.array_sort(
        F.array_distinct(
            F.concat(
                found["tags"],
                _phrases(found["hits"] if all(starts) else segments, patterns),
                structure_tags(content),
                url_tags(domain, path),
            )
        )
    )
