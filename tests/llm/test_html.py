import html
import random
import re
import time

import pytest

from broadsheet.llm import html_article
from broadsheet.llm.html_article import article_text, blocks_of, main_text, path_scores
from broadsheet.llm.queries import QUERIES


def test_query_equals_the_articles(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op7_html_article"](spark, sf).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


PAGE = """<html><head><title>T</title><script>if (a < b) document.write("<p>no</p>")</script></head><body>
<header><h1>Site</h1></header><nav><a href=x>One</a> <a href=y>Two</a></nav>
<div class="cookie-notice">We use cookies, and tell you so at great length, again and again.</div>
<div id=content><h2>The&nbsp;title &amp; more</h2>
<p>First paragraph, with <b>bold</b> and a <a href=z>link</a>,
over two lines.<p>Second one: it never closes
<ul><li>one item<li>another <i>item</i>, too</ul>
<blockquote><p>A quoted sentence, somewhat long.</p></blockquote><table><tr><td>a cell<td>next</table></div>
<aside>Aside, aside.</aside><form>Your name <input name=n><button>Go</button></form>
<section class="comments"><p>I do not agree, and I say so at length, with many words, and more.</p></section>
<!-- <p>hidden</p> --><footer>&copy; us</footer>"""
WANT = [
    "The title & more",
    "First paragraph, with bold and a link, over two lines.",
    "Second one: it never closes",
    "one item",
    "another item, too",
    "A quoted sentence, somewhat long.",
    "a cell",
    "next",
]


def test_parts_of_a_page():
    assert main_text(PAGE) == "\n".join(WANT)


@pytest.mark.parametrize("inner", ["<main>{}</main>", "<article>{}</article>", "<div class='post'><section>{}</section></div>"])
def test_short_articles_among_other_text(inner):
    body = inner.format("<h1>Title here</h1><p>Short, but all there is.</p>")
    page = f"<body><nav><ul><li><a href=a>Menu one</a><li><a href=b>Menu two</a></ul></nav><div class=ad>Buy this, buy that, buy it all.</div>{body}<footer>Words, words, and more words of the publisher.</footer></body>"
    assert main_text(page) == "Title here\nShort, but all there is."


@pytest.mark.parametrize(
    "icon",
    ['<svg class="i"/>', "<svg/>", '<svg data-x="a > b" />', '<svg-icon name="x"></svg-icon>', "<svg-icon />", "<title-bar></title-bar>", "<svg><title>t</title><path d='x'/></svg>"],
)
def test_icons_do_not_end_the_article(icon):
    page = f"<body><article><p>One, and more.</p>{icon}<p>Two, and more.</p></article></body>"
    assert main_text(page) == "One, and more.\nTwo, and more."


def test_broken_pages_never_fail():
    for page in ("", "<", "<p", "a < b & c", "<p>x</q></p></p>", "<!-- open", "<script>x", "</div>", "<a href='>x", "&#x110000; &#0; &bogus;", "<p>" * 3000 + "deep"):
        main_text(page)
    assert main_text("only text") == "only text" and main_text("<p>a &lt;b&gt; c</p>") == "a <b> c"
    assert main_text("<nav>menu</nav>") == "" and [b.text for b in blocks_of("<p>a<p>b")[0]] == ["a", "b"]


@pytest.mark.parametrize(
    "wrap",
    ["<div class='layout has-sidebar'>{}</div>", "<div class=no-sidebar>{}</div>", "<div class='page-with-header'>{}</div>", "<form action=x>{}</form>", "<div class=widget>{}</div>"],
)
def test_names_around_the_article(wrap):
    inner = "<nav><a href=x>Menu</a></nav><article><h1>Title</h1><p>One, and more.</p><p>Two, and more.</p></article><footer>Words of the house.</footer>"
    assert main_text(f"<body>{wrap.format(inner)}</body>") == "Title\nOne, and more.\nTwo, and more."
    plain = inner.replace("<article>", "<div>").replace("</article>", "</div>")
    assert main_text(f"<body>{wrap.format(plain)}</body>") == "Title\nOne, and more.\nTwo, and more."


def test_names_inside_the_article():
    page = (
        "<body><article><div class='post-header'><h1>Title</h1></div><p class=notice-period>One month, in writing.</p>"
        "<p data-class='ad'>Two, and more.</p><div class=ad-slot>Buy, buy, buy.</div><p>Three, and more.</p></article>"
        "<section class=comments><article class=comment-body><p>I say, at length, no, no, no.</p></article></section></body>"
    )
    assert main_text(page) == "Title\nOne month, in writing.\nTwo, and more.\nThree, and more."


def test_quotes_and_open_ends():
    assert main_text("<p title=it's>One, don't.</p><p>Two, it's.</p>") == "One, don't.\nTwo, it's."
    assert main_text("<p>One, two.</p><p>a <b c") == "One, two.\na <b c" and main_text("<p>One, two.</p><!-- a > b") == "One, two."
    assert main_text("<p>One, two.</p><script>a > b; c") == "One, two."


@pytest.mark.parametrize(
    "piece",
    ["<div>x ", "<p ", "<a>x ", "<p '", '<p a="', "<b><div>", "<li><ul>x", "</p>", "<svg ", "<!", "&", "<li></li><div>", "<div class=a>x</div>", "<p x='>", "<table><td><p>x"],
)
def test_hostile_pages_take_linear_time(piece):
    page = piece * ((1 << 20) // len(piece))
    for text in (page, page + ">", page + "'>"):
        start = time.process_time()
        main_text(text)
        assert time.process_time() - start < 8  # a second or two; seconds are those of a busy machine


def plain_scores(blocks, paths, links):
    """The same scores from whole paths, each against every other one."""

    def whole(node):
        return (*whole(paths.parent[node]), paths.step[node]) if node else ()

    by_path = {}
    for b in blocks:
        by_path.setdefault(b.path, []).append(b)
    unlinked = [sum(len(b.text) - min(b.links, len(b.text)) for b in by_path.get(i, ())) for i in range(len(paths.parent))]
    weights, own = paths.weights(unlinked), {}
    for node, some in by_path.items():
        marks = sum(len(html_article._PUNCTUATION.findall(b.text)) for b in some)
        weak = 0.5 if paths.kind[node] == html_article._WEAK else 1
        own[node] = weak * weights[node] * unlinked[node] / len(some) * (1 + marks / len(some))
    out = {}
    for node, some in by_path.items():
        path, near = whole(node), 0.0
        for k in range(len(path)):
            if k == len(path) - 1 or (k and path[k - 1] not in ("html", "body")):
                near = max([near, *(own[o] for o in own if whole(o)[:-1] == path[:k] and (len(whole(o)) == k + 1 or k == 0))])
        length = sum(len(b.text) for b in some)
        linked = sum(min(b.links, len(b.text)) for b in some)
        out[node] = (own[node] + near) / 2 if weights[node] and linked <= links * length else 0.0
    return out


def test_scores_equal_a_plain_version():
    rng = random.Random(5)
    pieces = ["<div>", "</div>", "<div class=post-header>", "<section class=comments>", "</section>", "<p>", "</p>", "<article>", "</article>", "<ul>", "<li>", "</ul>"]
    pieces += ["<a href=x>", "</a>", "<b>", "</b>", "<form>", "</form>", "<body>", "<main>", "<nav>", "</nav>", "<td>", "<br>", "one, two. ", "words here ", "x ", "long text, with many; marks! "]
    for _ in range(400):
        blocks, paths = blocks_of("".join(rng.choices(pieces, k=rng.randint(1, 60))))
        got, want = path_scores(blocks, paths), plain_scores(blocks, paths, html_article.LINKS)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "<p>kept</p>", None), (None, "<p>kept</p>", None), (5, "<p>" + "long text, " * 50_000, "y")], "page_id long, html string, text string")
    rows = pages.select("page_id", article_text("html").alias("out")).collect()
    assert [r.out for r in rows[:4]] == ["", "", "kept", "kept"] and len(rows[4].out) == 50_000 * 11 - 1
    assert pages.limit(0).select(article_text("html")).count() == 0
