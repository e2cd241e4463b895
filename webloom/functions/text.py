"""Text expressions: cleaning, tokenising, shingling and digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webloom.functions.fixed_values import STOP_WORDS, TOKEN_PUNCTUATION

# White space as Python's str.strip and str.split see it.
SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
SPACE_NOT_NEWLINE = r"[\t\x0b-\r\x1c-\x20\x{85}\p{Z}]"
NOT_SPACE = r"[^\t-\r\x1c-\x20\x{85}\p{Z}]"
EDGE_SPACE = rf"^{SPACE}+|{SPACE}+$"
# White space that parts tokens: a run that holds a space or a line feed, or stands at an edge of the
# text. One space alone is left out, it need not be replaced.
NEITHER = r"[\t\x0b-\r\x1c-\x20\x{85}\p{Z}&&[^ ]]"
PARTING = rf"(?={SPACE})(?:\n{SPACE}*+|\x20{SPACE}++|{NEITHER}++[\x20\n]{SPACE}*+|^{SPACE}++|{SPACE}++$)"

WORD = r"[\p{L}\p{N}_]{2,}"


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, EDGE_SPACE, "")


def clean_text(text: Column, decode_escapes: bool = False) -> Column:
    """Strip every line, join the lines by one space, strip the result.

    ``decode_escapes`` turns literal ``\\uXXXX`` sequences into their characters first; all other
    text stays as it is.
    """
    if decode_escapes:
        text = decode_unicode_escapes(text)
    joined = F.regexp_replace(text, rf"{SPACE_NOT_NEWLINE}*\n{SPACE_NOT_NEWLINE}*", " ")
    return strip_space(joined)


def decode_unicode_escapes(text: Column) -> Column:
    pieces = F.split(text, r"\\u(?=[0-9A-Fa-f]{4})")
    tail = F.transform(
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda piece: F.concat(
            F.decode(F.unhex(F.substring(piece, 1, 4)), "UTF-16BE"),
            piece.substr(F.lit(5), F.length(piece)),
        ),
    )
    return F.when(text.contains("\\u"), F.concat(pieces[0], F.array_join(tail, ""))).otherwise(text)


def tokens(text: Column, keep_empty: bool = False) -> Column:
    """Index tokens: split on spaces, strip, lower-case, delete punctuation.

    Lines are joined first, so words never fuse across a newline. Empty tokens are dropped unless
    ``keep_empty`` asks for the plain split on single spaces.
    """
    if keep_empty:
        return F.transform(
            F.split(text, " "),
            lambda t: F.translate(F.lower(strip_space(t)), TOKEN_PUNCTUATION, ""),
        )
    spaced = F.regexp_replace(text, PARTING, " ")
    return F.array_remove(F.split(F.translate(F.lower(spaced), TOKEN_PUNCTUATION, ""), " "), "")


def is_stop_word(term: Column, strip_apostrophe: bool = False) -> Column:
    """Membership in the fixed stop list. Tokens carry no apostrophe any more, so
    ``strip_apostrophe`` compares them with the stop words written without theirs as well."""
    words = set(STOP_WORDS)
    if strip_apostrophe:
        words |= {w.replace("'", "") for w in STOP_WORDS}
    return term.isin(*sorted(words))


def words(text: Column) -> Column:
    """Lower-case words between runs of white space."""
    return F.array_remove(F.split(F.lower(text), f"{SPACE}+"), "")


def has_words(text: Column, n: int) -> Column:
    """Whether a text holds at least ``n`` words; looks no further than the n-th."""
    return text.rlike(rf"^{SPACE}*(?:{NOT_SPACE}++{SPACE}++){{{n - 1}}}{NOT_SPACE}")


def runs(word_list: Column, n: int) -> Column:
    """All runs of ``n`` words in order, repeats kept; empty if there are fewer."""
    check_shingle_length(n)
    starts = F.sequence(F.lit(1), F.size(word_list) - (n - 1))
    joined = F.transform(starts, lambda i: F.array_join(F.slice(word_list, i, n), " "))
    return F.when(F.size(word_list) >= n, joined).otherwise(F.array().cast("array<string>"))


def shingles(word_list: Column, n: int) -> Column:
    """Distinct runs of ``n`` words in order of first appearance; empty if there are fewer."""
    return F.array_distinct(runs(word_list, n))


def run_hashes(word_hashes: str, n: int) -> Column:
    """A 64-bit hash of every run of ``n`` words, in order, from a column of the words' hashes; empty if
    there are fewer."""
    check_shingle_length(n)
    starts = F.sequence(F.lit(0), F.size(word_hashes) - n)
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(word_hashes, i + j) for j in range(n)]))
    return F.when(F.size(word_hashes) >= n, hashed).otherwise(F.array().cast("array<bigint>"))


def check_shingle_length(n: int) -> None:
    if isinstance(n, bool) or not isinstance(n, int):
        raise TypeError("the shingle length must be an integer")
    if n <= 0:
        raise ValueError("the shingle length must be greater than 0")


_DIGESTS = {
    "md5": F.md5,
    "sha1": F.sha1,
    "sha224": lambda c: F.sha2(c, 224),
    "sha256": lambda c: F.sha2(c, 256),
    "sha512": lambda c: F.sha2(c, 512),
}


def _digest(value: Column, function: str) -> Column:
    if function not in _DIGESTS:
        raise ValueError(f"unknown digest function {function!r}; use one of {sorted(_DIGESTS)}")
    return _DIGESTS[function](value.cast("binary"))


def digest64(value: Column, function: str) -> Column:
    """First 64 bits of a digest as 16 hex digits: fixed width, so string order is number order."""
    return F.substring(_digest(value, function), 1, 16)


def min_hash(shingle_list: Column, function: str) -> Column:
    """Smallest 64-bit digest over a shingle array, of strings or bytes. The smallest whole digest
    begins with it, so only that one is cut."""
    return F.substring(F.array_min(F.transform(shingle_list, lambda s: _digest(s, function))), 1, 16)


def unsigned64(hex16: Column) -> Column:
    """A 16-digit hex value as its unsigned decimal string."""
    return F.conv(hex16, 16, 10)


def vocabulary_words(text: Column) -> Column:
    """Lower-case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def parse_price(price: Column) -> Column:
    """Number behind an optional leading ``$``; null for anything that is not a number."""
    bare = F.when(price.startswith("$"), F.replace(price, F.lit("$"), F.lit(""))).otherwise(price)
    return strip_space(bare).try_cast("double")
