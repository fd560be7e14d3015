import re
import unicodedata
from html.entities import html5
from html.parser import HTMLParser

import pytest
from conftest import as_dicts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadsheet.functions import clean_columns, clean_text, corpus_clean, html_text, nfkd, normalize_ws, strip_ws
from broadsheet.functions.text import _ODD_SPACE

SKIPPED = {"script", "style", "template", "rt", "rp"}


class Walker(HTMLParser):
    """Text nodes in order, by a parser that knows nothing of our patterns."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.nodes, self.open, self.joined = [], [], False

    def text(self, data):
        if not any(t in SKIPPED for t in self.open):
            if self.joined:
                self.nodes[-1] += data
            else:
                self.nodes.append(data)
            self.joined = True

    handle_data = text

    def handle_entityref(self, name):
        self.text(html5.get(name + ";") or html5.get(name) or "&" + name)

    def handle_charref(self, name):
        code = int(name[1:], 16) if name[0] in "xX" else int(name)
        self.text(bytes([code]).decode("cp1252") if code < 256 else chr(code))

    def handle_starttag(self, tag, attrs):
        self.joined = False
        if tag in SKIPPED:
            self.open.append(tag)

    def handle_endtag(self, tag):
        self.joined = False
        if tag in self.open:
            del self.open[self.open.index(tag) :]

    def handle_startendtag(self, tag, attrs):
        self.joined = False

    def handle_comment(self, data):
        self.joined = False

    handle_decl = handle_pi = unknown_decl = handle_comment


def walk(html):
    walker = Walker()
    walker.feed(html)
    walker.close()
    return " ".join(walker.nodes)


def py_clean(html):
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKD", walk(html or ""))).strip()


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", function("v").alias("out")).collect()
    return [r.out for r in sorted(rows)]


CLEANED = {
    None: "",
    "": "",
    "<b>foo</b>bar": "foo bar",
    "a<!-- c -->b": "a b",
    'x<script>var t="</p>";</script>y': "x y",
    '<a title="x>y">hi</a>': "hi",
    "1 < 2": "1 < 2",
    "&lt;b&gt;": "<b>",
    "&amp;lt;": "&lt;",
    "é": "é",
    "ﬁ": "fi",
    "a b": "a b",
    "a \t\n b\x1cc\x85d　": "a b c d",
    "<script>var a = '<!--';</script>text<!-- c -->more": "text more",
    "<!-- <script> -->kept<!-- </script> -->": "kept",
    "<script>never closed <b>x</b>": "",
    "<script src=x />kept": "kept",
    "<ruby>漢<rp>(</rp><rt>kan</rt><rp>)</rp></ruby>": "漢",
    "<style>p{}</style ><STYLE>q{}</STYLE>z": "z",
    "<template><p>no</p></template>yes": "yes",
    "a<![CDATA[b]]>c": "a b c",
    "caf&eacute; &#8364; &#x20AC; &#146; &bogus; &bogus": "café € € ’ &bogus &bogus",
    "AT&T and x?a=1&page=2&image=3": "AT&T and x?a=1&page=2ℑ=3".replace("ℑ", "I"),
    "&copy 2020 &copy2020 &copy": "© 2020 &copy2020 &copy",
    "&#55357; &#x110000;": "� �",
    "a <b>": "a",
    "<p>one</p>\n<p>two</p>": "one two",
}


def test_clean_text_cases(spark):
    assert dict(zip(CLEANED, apply(spark, clean_text, CLEANED))) == CLEANED


def test_clean_columns_equals_clean_text(spark):
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(CLEANED)], "i int, a string, b string")
    rows = sorted(clean_columns(df, "a", "b").collect())
    assert [r.a for r in rows] == [r.b for r in rows] == list(CLEANED.values())
    assert clean_columns(df, "a", "b").columns == df.columns


def test_html_text_keeps_inner_space(spark):
    cases = {"<b>foo</b>bar": "foo bar", "<p> a </p><p>b</p>": " a  b", "<br>": "", None: "", "x<br><br>y": "x y", "<p>a&amp</p>": "a&", "a&amp": "a&amp"}
    assert dict(zip(cases, apply(spark, html_text, cases))) == cases


def test_pages_equal_a_parser_walk(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = pages.select("html", clean_text("html").alias("clean"), html_text("html").alias("text")).collect()
    assert rows and all(r.text == walk(r.html) and r.clean == py_clean(r.html) for r in rows)


def test_long_markup_does_not_overflow(spark):
    cases = {
        "<a " + "x" * 200_000: "<a " + "x" * 200_000,
        "<b>" * 50_000 + "t": "t",
        "<a " + 'q="1" ' * 50_000 + ">t": "t",
        "<!-- " + "c" * 200_000 + "-->t": "t",
        "<rt>" * 20_000 + "t": "",
        "a" + " " * 200_000 + "b": "a b",
    }
    assert apply(spark, clean_text, cases) == list(cases.values())
    blanks = "a" + " " * 100_000 + "b"
    assert apply(spark, strip_ws, [f"\n{blanks} "]) == [blanks]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), min_size=20, max_size=60))
def test_unicode_functions_equal_python(spark, texts):
    texts = [t.replace("\x00", "") for t in texts]
    assert apply(spark, nfkd, texts) == [unicodedata.normalize("NFKD", t) for t in texts]
    assert apply(spark, normalize_ws, texts) == [re.sub(r"\s+", " ", t).strip() for t in texts]
    assert apply(spark, strip_ws, texts) == [t.strip() for t in texts]
    lowered = [t for t in texts if "Σ" not in t]
    assert apply(spark, corpus_clean, lowered) == [
        re.sub(r"\s+", " ", re.sub(r"[^a-zA-Z0-9\s]", "", t.lower())).strip() for t in lowered
    ]


def test_every_white_space_character(spark):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    out = apply(spark, normalize_ws, [f"a{s}{s}b" for s in spaces])
    assert out == ["a b"] * len(spaces)
    others = [chr(c) for c in range(1, 0xD800) if not chr(c).isspace()]
    kept = spark.createDataFrame([(c,) for c in others], "c string").filter(~F.col("c").rlike(f"[ {_ODD_SPACE}]"))
    assert kept.count() == len(others)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text("abc \té.,0", max_size=60), min_size=10, max_size=40))
def test_clean_is_idempotent_without_markup(spark, texts):
    once = apply(spark, clean_text, texts)
    assert apply(spark, clean_text, once) == once


def test_ascii_rows_send_only_null_to_python(spark):
    df = spark.createDataFrame([("plain",), ("café",)], "v string")
    plan = df.select(nfkd("v"))._jdf.queryExecution().toString()
    assert "ArrowEvalPython" in plan
    assert as_dicts(df.select(nfkd("v").alias("o"))) == [{"o": "plain"}, {"o": "café"}]


@pytest.mark.parametrize("value", ["<p>a</p>", "é", "&hearts;"])
def test_null_is_empty_beside_other_rows(spark, value):
    assert apply(spark, clean_text, [None, value])[0] == ""
