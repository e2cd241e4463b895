"""URL expressions: host, resolution, normalisation, priority and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webloom.functions.fixed_values import (
    PRIORITY_DEFAULT,
    PRIORITY_HIT,
    PRIORITY_KEYWORD,
    SKIPPED_SCHEMES,
    SKIPPED_SUFFIXES,
)

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
_QUERY = r"^[^?#]*(\?[^#]*)"
_FRAGMENT = r"(#.*)$"


def host(url: Column) -> Column:
    """Authority part (with port and user info); null unless scheme and authority both exist."""
    return F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1), F.lit(""))


def path(url: Column) -> Column:
    return F.regexp_extract(url, _PATH, 1)


def after_host(url: Column) -> Column:
    """Path, query and fragment."""
    return F.regexp_replace(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?", "")


def path_and_query(url: Column) -> Column:
    """What a robots rule is compared with: path, query and fragment, at least ``/``."""
    rest = after_host(url)
    return F.when(rest == "", F.lit("/")).otherwise(rest)


def normalize(url: Column) -> Column:
    """Drop trailing slashes."""
    return F.rtrim(url, F.lit("/"))


def is_page_link(href: Column, skip_binary: bool = True) -> Column:
    """Links worth following: no mail or phone scheme and, by default, no binary file suffix.

    The suffix test is case-sensitive and looks at the end of the whole href.
    """
    keep = ~F.startswith(href, F.lit(SKIPPED_SCHEMES[0]))
    for scheme in SKIPPED_SCHEMES[1:]:
        keep = keep & ~F.startswith(href, F.lit(scheme))
    if skip_binary:
        suffixes = "|".join(s.lstrip(".") for s in SKIPPED_SUFFIXES)
        keep = keep & ~href.rlike(rf"\.({suffixes})$")
    return keep


def base_parts(base: Column) -> Column:
    """What resolution needs of a page address. As a column of its own it is worked out once for a
    page and not once for every link."""
    folder = F.regexp_extract(path(base), r"^(.*/)", 1)
    scheme = F.regexp_extract(base, _SCHEME, 0)
    return F.struct(
        base.alias("url"),
        scheme.alias("scheme"),
        F.concat(scheme, F.lit("//"), F.regexp_extract(base, _AUTHORITY, 1)).alias("root"),
        path(base).alias("path"),
        F.when(folder == "", F.lit("/")).otherwise(folder).alias("folder"),
        F.regexp_replace(base, r"#.*$", "").alias("document"),
    )


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` found on page ``base`` (RFC 3986 reference resolution)."""
    return resolve_from(base_parts(base), href)


def resolve_from(base: Column, href: Column) -> Column:
    """Like ``resolve``, with the ``base_parts`` of the page."""
    href_path = path(href)
    rest = F.concat(F.regexp_extract(href, _QUERY, 1), F.regexp_extract(href, _FRAGMENT, 1))
    rooted = base["root"]
    joined = F.concat(base["folder"], href_path)
    resolved = (
        F.when(href == "", base["url"])
        .when(href.rlike(_SCHEME), href)
        .when(F.startswith(href, F.lit("//")), F.concat(base["scheme"], href))
        .when(F.startswith(href, F.lit("/")), F.concat(rooted, _without_dots(href_path), rest))
        .when(F.startswith(href, F.lit("?")), F.concat(rooted, base["path"], rest))
        .when(F.startswith(href, F.lit("#")), F.concat(base["document"], href))
        .otherwise(
            F.concat(rooted, _without_dots(F.regexp_replace(joined, r"(?<=.)/{2,}", "/")), rest)
        )
    )
    # An empty query or fragment leaves no mark.
    return F.when(href == "", resolved).otherwise(F.regexp_replace(resolved, r"(?<!\?)\??#?$", ""))


def _without_dots(url_path: Column) -> Column:
    """Fold ``.`` and ``..`` segments away. Paths without any are passed through untouched."""
    segments = F.split(url_path, "/")
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, seg: F.when(
            seg == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        )
        .when(seg == ".", done)
        .otherwise(F.concat(done, F.array(seg))),
    )
    closed = F.when(
        url_path.rlike(r"(^|/)\.{1,2}$"), F.concat(folded, F.array(F.lit("")))
    ).otherwise(folded)
    text = F.array_join(closed, "/")
    rooted = F.when(F.startswith(text, F.lit("/")), text).otherwise(F.concat(F.lit("/"), text))
    return F.when(url_path.rlike(r"(^|/)\.{1,2}(/|$)"), rooted).otherwise(url_path)


def priority(url: Column, keyword: str = PRIORITY_KEYWORD) -> Column:
    """Crawl priority: addresses holding the keyword come first."""
    return F.when(url.contains(keyword), F.lit(PRIORITY_HIT)).otherwise(F.lit(PRIORITY_DEFAULT))


def file_name(url: Column) -> Column:
    """Safe JSON file name: authority followed by the path with ``/`` and ``:`` replaced."""
    bare_path = F.regexp_replace(path(url), r";[^/]*$", "")
    return F.concat(
        F.regexp_extract(url, _AUTHORITY, 1), F.translate(bare_path, "/:", "_-"), F.lit(".json")
    )


def percent_decoded(text: Column) -> Column:
    """Percent escapes decoded; text that is no valid escape sequence is kept."""
    plus_safe = F.replace(text, F.lit("+"), F.lit("%2B"))
    return F.when(text.contains("%"), F.coalesce(F.try_url_decode(plus_safe), text)).otherwise(text)
