"""URL operators as Catalyst expressions.

The authority is read with one regular expression because ``parse_url`` returns
null for hosts with ``_`` and raises on a space in the path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLIT_URL = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, SPLIT_URL, 1))


def domain(url: Column) -> Column:
    """Host without user info and port; case kept."""
    host = F.regexp_extract(F.regexp_extract(url, SPLIT_URL, 2), r"([^@]*)$", 1)
    return F.when(host.startswith("["), F.regexp_extract(host, r"^\[([^\]]*)\]", 1)).otherwise(
        F.substring_index(host, ":", 1)
    )


def raw_path(url: Column) -> Column:
    return F.regexp_extract(url, SPLIT_URL, 3)


def path(url: Column) -> Column:
    """Percent-decoded path; ``+`` stays, a broken escape gives null."""
    raw = raw_path(url)
    decoded = F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when(raw.contains("%"), decoded).otherwise(raw)


def sanitize_path(value: Column) -> Column:
    return F.when(value == "", "empty").otherwise(
        F.regexp_replace(value, "[^a-zA-Z0-9_-]", "_")
    )


def canonical_url(domain_col: Column, real_path: Column) -> Column:
    """Identity of a page: scheme, port, query and fragment are not part of it."""
    return F.concat_ws("", F.lit("https://"), domain_col, real_path)


def external_links(links: Column) -> Column:
    """https list then http list; a missing list counts as empty."""
    none = F.array().cast("array<string>")
    return F.concat(F.coalesce(links["https"], none), F.coalesce(links["http"], none))


def resolve_internal(page_url: Column, internal: Column) -> Column:
    """Site-relative links as absolute URLs; ``../`` is left alone, the port dropped."""
    site = F.concat(scheme(page_url), F.lit("://"), domain(page_url))
    kept = F.filter(
        internal,
        lambda v: ~(
            v.startswith("//")
            | v.startswith("mailto")
            | v.startswith("tel")
            | v.startswith("#")
            | v.isin("", "/")
        ),
    )
    return F.transform(
        kept,
        lambda v: F.when(v.startswith("/"), F.concat(site, v)).otherwise(
            F.concat(site, F.lit("/"), v)
        ),
    )


def lookup_candidates(text: Column) -> Column:
    """Spellings of a typed address: with a scheme, with and without the last slash."""
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    url = F.when(trimmed.startswith("http"), trimmed).otherwise(
        F.concat(F.lit("https://"), trimmed)
    )
    other = F.when(url.endswith("/"), F.rtrim(url, F.lit("/"))).otherwise(
        F.concat(url, F.lit("/"))
    )
    return F.array(url, other)


def site_root(link: Column) -> Column:
    """Scheme and domain of an external link, ``http`` unless it says https."""
    prefix = F.when(link.startswith("https://"), "https://").otherwise("http://")
    return F.concat(prefix, domain(link))
