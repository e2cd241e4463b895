import hashlib
from html import unescape
from urllib.parse import urljoin, urlparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webloom.functions import html, text, urls, vectors
from webloom.functions.fixed_values import STOP_WORDS, TOKEN_PUNCTUATION
from webloom.functions.stem import stem


def values(spark, inputs, build):
    """``build(column)`` for each input, in order."""
    table = spark.createDataFrame(list(enumerate(inputs)), "i int, v string")
    return [r.x for r in table.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()]


def test_fixed_lists():
    assert len(STOP_WORDS) == 174 and len(set(STOP_WORDS)) == 174
    assert sum("'" in w for w in STOP_WORDS) == 50
    assert STOP_WORDS == sorted(STOP_WORDS)
    assert len(set(TOKEN_PUNCTUATION)) == 33


TEXTS = [
    "Hello,  World.\n\n  next line\t \n last ",
    "a\tb c - \n-\n!",
    "",
    " \n ",
    "one two   three",
    "isn't (it) <fine> `yes` ´no´",
]


def python_clean(value):
    return " ".join(line.strip() for line in value.split("\n")).strip()


def python_tokens(value, keep_empty=False):
    out = []
    for token in value.split(" "):
        token = token.strip().lower()
        out.append("".join(c for c in token if c not in TOKEN_PUNCTUATION))
    return out if keep_empty else [t for t in out if t]


def test_clean_text(spark):
    assert values(spark, TEXTS, text.clean_text) == [python_clean(t) for t in TEXTS]


def test_tokens(spark):
    assert values(spark, TEXTS, text.tokens) == [python_tokens(python_clean(t)) for t in TEXTS]
    kept = values(spark, TEXTS, lambda c: text.tokens(c, keep_empty=True))
    assert kept == [python_tokens(t, keep_empty=True) for t in TEXTS]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab,. \n\t '-", max_size=30), min_size=1, max_size=20))
def test_text_functions_agree_with_python(spark, samples):
    assert values(spark, samples, text.clean_text) == [python_clean(t) for t in samples]
    assert values(spark, samples, text.tokens) == [python_tokens(python_clean(t)) for t in samples]
    assert values(spark, samples, text.words) == [t.lower().split() for t in samples]
    for n in (1, 3):
        enough = values(spark, samples, lambda c: text.has_words(c, n))
        assert enough == [len(t.split()) >= n for t in samples]


def test_decode_escapes(spark):
    found = values(spark, [r"aæb A", "plain"], lambda c: text.clean_text(c, True))
    assert found == ["aæb A", "plain"]


def test_stop_words(spark):
    words = ["the", "isnt", "banana"]
    assert values(spark, words, text.is_stop_word) == [True, False, False]
    stripped = values(spark, words, lambda c: text.is_stop_word(c, strip_apostrophe=True))
    assert stripped == [True, True, False]


def test_shingles(spark):
    found = values(spark, ["a b c b c", "a b", "a b c"], lambda c: text.shingles(text.words(c), 3))
    assert found == [["a b c", "b c b", "c b c"], [], ["a b c"]]
    repeated = values(spark, ["x y x y x y"], lambda c: text.shingles(text.words(c), 2))
    assert repeated == [["x y", "y x"]]


def test_shingle_length_is_checked():
    with pytest.raises(ValueError):
        text.check_shingle_length(0)
    with pytest.raises(TypeError):
        text.check_shingle_length(2.0)


@pytest.mark.parametrize("function", ["md5", "sha1", "sha224", "sha256", "sha512"])
def test_digests(spark, function):
    found = values(spark, ["some words", "æøå"], lambda c: text.digest64(c, function))
    digest = getattr(hashlib, function)
    assert found == [digest(w.encode()).hexdigest()[:16] for w in ("some words", "æøå")]
    unsigned = values(spark, ["some words"], lambda c: text.unsigned64(text.digest64(c, function)))
    assert unsigned == [str(int(digest(b"some words").hexdigest()[:16], 16))]


def test_unknown_digest(spark):
    with pytest.raises(ValueError):
        text.digest64(F.lit("x"), "crc32")


def test_prices(spark):
    found = values(spark, ["$12.50", "7", "", "abc", "$1,000", None], text.parse_price)
    assert found == [12.5, 7.0, None, None, None, None]


WORDS = {
    "caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "motoring": "motor", "sing": "sing", "conflated": "conflat",
    "troubling": "troubl", "sized": "size", "hopping": "hop", "falling": "fall", "hissing": "hiss",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "rational": "ration", "digitizer": "digit", "operator": "oper", "feudalism": "feudal",
    "hopefulness": "hope", "formalize": "formal", "electrical": "electr", "goodness": "good",
    "revival": "reviv", "allowance": "allow", "adjustment": "adjust", "adoption": "adopt",
    "effective": "effect", "probate": "probat", "rate": "rate", "cease": "ceas", "controller":
    "control", "roll": "roll", "dying": "die", "dies": "die", "tied": "tie", "news": "news",
    "enjoy": "enjoy", "doubled": "doubl", "works": "work", "engineer": "engin", "an": "an",
    "geology": "geolog",
}


def test_stemmer():
    assert {w: stem(w) for w in WORDS} == WORDS


HREFS = [
    "", "http://other.org/x", "https://h.com", "//cdn.net/y/", "/root", "/a/../b", "/./c/.", "plain",
    "sub/page.html", "../up", "../../../far", "./here", "..", ".", "?q=1", "#frag", "x?y#z",
    "/p?../q", "mailto:a@b.c", "a//b", "/a//b",
]
BASES = [
    "http://h.com/dir/page.html?x=1#top", "https://h.com", "https://h.com/", "https://u@h.com:8080/a/b/",
]


@pytest.mark.parametrize("base", BASES)
def test_resolve(spark, base):
    found = values(spark, HREFS, lambda c: urls.resolve(F.lit(base), c))
    assert dict(zip(HREFS, found)) == {h: urljoin(base, h) for h in HREFS}


def test_hosts_and_names(spark):
    samples = [
        "https://u:p@h.com:8080/a/b:c?x/y", "http://h.com", "//h.com/x", "/x", "mailto:a@b", "h.com/x",
    ]
    hosts = values(spark, samples, urls.host)
    expected = [urlparse(u).netloc if urlparse(u).scheme and urlparse(u).netloc else None for u in samples]
    assert hosts == expected
    names = values(spark, samples, urls.file_name)
    for url, name in zip(samples, names):
        parsed = urlparse(url)
        path = parsed.path.replace("/", "_").replace(":", "-")
        if parsed.scheme != "mailto":
            assert name == parsed.netloc + path + ".json"


def test_normalize_and_priority(spark):
    assert values(spark, ["http://h/a//", "http://h/"], urls.normalize) == ["http://h/a", "http://h"]
    assert values(spark, ["http://news.dk", "http://h"], urls.priority) == [1, 5]
    assert values(spark, ["http://blog.dk"], lambda c: urls.priority(c, "blog")) == [1]


def test_link_filter(spark):
    samples = ["mailto:x", "tel:1", "a.pdf", "a.PDF", "a.pdf?x=1", "a.jpeg", "x", "ZIP"]
    assert values(spark, samples, urls.is_page_link) == [False] * 3 + [True, True, False, True, True]
    loose = values(spark, samples, lambda c: urls.is_page_link(c, skip_binary=False))
    assert loose == [False, False] + [True] * 6


def test_page_text(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style>"
        '<script>var t="</p>";</script></head>\n <body><!-- hidden <b> -->\n<p class="a">One &lt;two'
        "&#233;&#x41;&nosuch;&middot;</p><p>a < b</p></body></html> "
    )
    assert values(spark, [page], html.page_text) == ["T & U  One <twoéA&nosuch;·a < b"]
    with_scripts = values(spark, [page], lambda c: html.page_text(c, include_scripts=True))
    assert "var t" in with_scripts[0] and "hidden" not in with_scripts[0]


def test_unescape_agrees_with_python(spark):
    samples = ["&quot;x&quot; &copy;", "a & b", "&amp;lt;", "&#128512;", "&hellip;&apos;", "none", "&"]
    assert values(spark, samples, html.unescape) == [unescape(s) for s in samples]


def test_anchors(spark):
    page = (
        "<a href=\"/double\">a</a><A class=x HREF = '/single'>b</A><a href=/bare>c</a>"
        '<a data-href="/no">d</a><a name="n">e</a><abbr href="/no2">f</abbr>'
        "<!-- <a href=\"/comment\"> --><script>'<a href=\"/script\">'</script>"
        '<a\n href="/x?a=1&amp;b=2">g</a>'
    )
    assert values(spark, [page], html.anchor_hrefs) == [["/double", "/single", "/bare", "/x?a=1&b=2"]]


def test_vectors(spark):
    table = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 2.0])], "a array<double>, b array<double>")
    found = table.select(
        vectors.dot(F.col("a"), F.col("b")), vectors.norm(F.col("a")), vectors.cosine(F.col("a"), F.col("b"))
    ).collect()
    assert [tuple(r) for r in found] == [(24.0, 5.0, 0.96), (0.0, 0.0, 0.0)]
    clipped = spark.range(1).select(vectors.clip(F.lit(-5000.0)), vectors.clip(F.lit(2.0)))
    assert tuple(clipped.first()) == (-1000.0, 2.0)
    assert tuple(spark.range(1).select(vectors.as_percent(F.lit(2 / 3))).first()) == (66.67,)
