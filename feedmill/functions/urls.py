"""URL authority and relative-reference expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
# An http(s) URL up to the end of its host, as it stands in running text. The possessive
# quantifiers keep the matcher from recursing on long runs; they do not change what matches.
MENTION = r"(?U)https?://(?:[-\w.]++|%[\da-fA-F]{2})++"


def strip_www(host: Column) -> Column:
    return F.regexp_replace(host, r"^www\.", "")


def url_domain(url: Column) -> Column:
    """Authority of a URL without a leading ``www.``; keeps port, user info and letter case.

    Null when there is none, or when its square brackets do not pair up.
    """
    clean = F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")
    host = F.regexp_extract(clean, AUTHORITY, 1)
    paired = host.contains("[") == host.contains("]")
    return F.when(paired, F.nullif(strip_www(host), F.lit("")))


def mentioned_urls(text: Column) -> Column:
    """Array of every http(s) URL head in ``text``, repeats kept."""
    return F.regexp_extract_all(text, F.lit(MENTION), F.lit(0))


def _without_dots(path: Column) -> Column:
    """``.`` and ``..`` segments resolved against the site root."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, part: F.when(part == ".", acc)
        .when(part == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.array_append(acc, part)),
    )
    joined = F.array_join(kept, "/")
    tail = F.when(F.element_at(parts, -1).isin(".", "..") & ~joined.endswith("/"), F.lit("/"))
    joined = F.concat(joined, F.coalesce(tail, F.lit("")))
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def resolve_href(href: Column, base: Column) -> Column:
    """Absolute form of ``href``; ``base`` is a bare ``https://host``.

    http(s) links pass through untouched and so does any other scheme.
    """
    ref = F.regexp_replace(href, r"^[\x00-\x20]+|[\t\r\n]", "")
    ref = F.regexp_replace(ref, r"#$", "")
    ref = F.regexp_replace(ref, r"\?(?=#|$)", "")
    path = F.regexp_extract(ref, r"^([^?#]*)", 1)
    rest = F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)
    return (
        F.when(href.startswith("http://") | href.startswith("https://"), href)
        .when(ref == "", base)
        .when(ref.startswith("//"), F.concat(F.lit("https:"), ref))
        .when(ref.rlike(r"^(?i)https://"), F.regexp_replace(ref, r"^(?i)https", "https"))
        .when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(path == "", F.concat(base, rest))
        .otherwise(F.concat(base, _without_dots(path), rest))
    )
