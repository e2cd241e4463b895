"""Porter's suffix-stripping algorithm (1980) with the usual published extensions.

A small per-word helper. Spark applies it to the distinct vocabulary in Arrow batches, see
``webloom.operators.index.stem_vocabulary``.
"""

from __future__ import annotations

import re

import pandas as pd

# Whole-word exceptions (fixed values).
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}

# Suffix tables of the algorithm (fixed values). The first suffix that matches decides.
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
]


def _shape(word: str) -> str:
    """The word as a string of ``c`` (consonant) and ``v`` (vowel); y after a consonant is a vowel."""
    shape = ""
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(word: str) -> int:
    return len(re.findall("v+c+", _shape(word)))


def _has_vowel(word: str) -> bool:
    return "v" in _shape(word)


def _short_end(word: str) -> bool:
    """Ends consonant-vowel-consonant (last not w, x, y), or is a vowel-consonant pair."""
    shape = _shape(word)
    return (shape.endswith("cvc") and word[-1] not in "wxy") or shape == "vc"


def _double_end(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _replace(word: str, table: list[tuple[str, str]]) -> str:
    for suffix, new in table:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + new if _measure(stem) > 0 else word
    return word


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: -len(suffix)]
        if word.endswith(suffix) and _has_vowel(stem):
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _double_end(stem):
                return stem if stem[-1] in "lsz" else stem[:-1]
            return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem
    return word


def _double_suffix(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _double_suffix(word[:-2])
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _replace(word, STEP_2)


def _long_suffix(word: str) -> str:
    for suffix in STEP_4:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            fits = _measure(stem) > 1 and (suffix != "ion" or stem[-1] in "st")
            return stem if fits else word
    return word


def _final_e(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _short_end(stem)):
            word = stem
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def stem(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and len(word) > 2 and _shape(word)[-2] == "c":
        word = word[:-1] + "i"
    return _final_e(_long_suffix(_replace(_double_suffix(word), STEP_3)))


def stem_series(terms: pd.Series) -> pd.Series:
    return terms.map(stem, na_action="ignore")
