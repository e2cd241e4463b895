"""Page expressions: visible text and anchor addresses of raw HTML."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from webloom.functions.text import clean_text

HIDDEN = (
    r"(?is)<!--.*?-->|<script(?:\s[^>]*)?>.*?</script\s*>|<style(?:\s[^>]*)?>.*?</style\s*>"
)
COMMENT = r"(?is)<!--.*?-->"
TAG = r"(?s)<[/!?a-zA-Z][^>]*>"
ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def page_text(html: Column, include_scripts: bool = False) -> Column:
    """Text a reader sees: lines joined, hidden parts and tags removed, entities decoded."""
    hidden = COMMENT if include_scripts else HIDDEN
    visible = F.regexp_replace(clean_text(html), hidden, "")
    return unescape(F.regexp_replace(visible, TAG, ""))


def anchor_hrefs(html: Column) -> Column:
    """``href`` values of all anchors outside scripts, styles and comments, in page order."""
    found = F.regexp_extract_all(F.regexp_replace(html, HIDDEN, ""), F.lit(ANCHOR), F.lit(1))
    return F.transform(found, lambda raw: unescape(F.regexp_replace(raw, "^[\"']|[\"']$", "")))


def unescape(text: Column) -> Column:
    """Decode named (HTML 4) and numeric character references that end in ``;``."""
    names = F.create_map(
        *[F.lit(v) for name, code in name2codepoint.items() for v in (name, chr(code))],
        F.lit("apos"),
        F.lit("'"),
    )

    def decode(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^(#?[0-9A-Za-z]{1,10});", 1)
        code = F.when(
            name.rlike("^#[xX][0-9A-Fa-f]{1,6}$"), F.conv(F.substring(name, 3, 8), 16, 10)
        ).when(name.rlike("^#[0-9]{1,7}$"), F.substring(name, 2, 8))
        number = F.when(code.cast("int").between(1, 0x10FFFF), code.cast("int"))
        wide = F.lpad(F.hex(number.cast("long")), 8, "0")
        char = F.coalesce(F.decode(F.unhex(wide), "UTF-32"), names[name])
        rest = piece.substr(F.length(name) + 2, F.length(piece))
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))

    pieces = F.split(text, "&")
    tail = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), decode)
    return F.when(text.contains("&"), F.concat(pieces[0], F.array_join(tail, ""))).otherwise(text)
