import time

import pytest

from broadsheet.sources.feed_reader import attributes, decoded, read_feed, tokens

ITEM = "<item><title>{0}</title><link>http://x/{0}</link><description>about {0}</description></item>"


def titles(text):
    feed = read_feed(text)
    return feed and (feed["title"], [i["title"] for i in feed["items"]])


@pytest.mark.parametrize(
    ("text", "want"),
    [
        # an item without an end is dropped, those around it stay
        ("<rss><channel><title>F</title><item><title>a</title>" + ITEM.format("b") + ITEM.format("c"), ("F", ["b", "c"])),
        ("<rss><channel><title>F</title>" + ITEM.format("a") + "<item><title>half", ("F", ["a"])),
        # bare markup characters are text of their own item
        ("<rss><channel><title>F</title>" + ITEM.format("1 < 2 & 3 <b") + ITEM.format("d"), ("F", ["1 < 2 & 3 <b", "d"])),
        # any prefix, declared or that of the root
        ("<a:feed xmlns:a='http://www.w3.org/2005/Atom'><a:title>F</a:title><a:entry><a:title>p</a:title></a:entry></a:feed>", ("F", ["p"])),
        ("<x:feed><x:title>F</x:title><x:entry><x:title>p</x:title></x:entry></x:feed>", ("F", ["p"])),
        ("<rss><channel><title>F</title><image><title>no</title></image>" + ITEM.format("a"), ("F", ["a"])),
        ("<rss><channel><image><title>no</title></image><title/>" + ITEM.format("a"), (None, ["a"])),
        ("<rss><channel><title>F</title><item><title>a</item>" + ITEM.format("b"), ("F", ["a", "b"])),
        ("<!-- <item><title>no</title></item> --><rss><channel>" + ITEM.format("<![CDATA[<item>&amp;</item>]]>"), (None, ["<item>&amp;</item>"])),
        ("<rss><channel>" + ITEM.format("<!-- open comment"), (None, ["<!-- open comment"])),
        ("<rss><channel><item/>" + ITEM.format("a") + "</entry></item></item>", (None, ["a"])),
        ("<rss><channel><title>no items</title></channel></rss>", None),
        ("junk", None),
        ("", None),
        (None, None),
    ],
)
def test_whole_items_are_kept(text, want):
    assert titles(text) == want


def test_fields():
    feed = read_feed(
        "<rss xmlns:c='http://purl.org/rss/1.0/modules/content/' xmlns:d='http://purl.org/dc/elements/1.1/' xmlns:m='urn:m'><channel>"
        "<item><m:title>other</m:title><title> a\r\nb </title><guid>http://g</guid><c:encoded>x<b class='y'>z</b> &eacute;</c:encoded>"
        "<d:creator>me</d:creator><m:group><title>deep</title></m:group><title>second</title></item>"
        "<item><title>n</title><guid isPermaLink='false'>7</guid><author/></item></channel></rss>"
    )
    one, two = feed["items"]
    assert (one["title"], one["guid"], one["whole"], one["creator"]) == ("a\nb", "http://g", "x<b class='y'>z</b> é", "me")
    assert two["guid"] is None and two["author"] is None
    entry = read_feed(
        "<feed><entry><link rel='self' href='s'/><link href='h&amp;1'/><link href='later'/><author><uri>u</uri><name> N </name></author>"
        "<content type='xhtml'><div>deep <p>down</p></div></content><updated>2024</updated></entry></feed>"
    )["items"][0]
    assert (entry["link"], entry["author"], entry["whole"], entry["updated"]) == ("h&1", "N", "<div>deep <p>down</p></div>", "2024")


def test_references():
    assert decoded("&lt;&#65;&#x42;&eacute;&nosuch;&#0;&#x110000;&#xD800;& &;") == "<AB\xe9&nosuch;&#0;&#x110000;&#xD800;& &;"
    assert attributes(""" a="1" b:c = '2 "x"' d""") == {"a": "1", "b:c": '2 "x"'}


def test_tokens_cover_the_text():
    text = "a<b c='>'>d<![CDATA[<e>]]><!-- f --></b><g/><?h?>i < j <k"
    assert [t[0] for t in tokens(text)] == ["text", "open", "text", "text", "close", "open", "text", "text", "text", "text", "text"]


@pytest.mark.parametrize("piece", ["<", "<a ", "<a>", "<![CDATA[", "<!--", "<item>", "<item><title>x", "</item>", "&", "<a b='", "<?", "<entry><link "])
def test_hostile_texts_take_linear_time(piece):
    text = "<rss><channel>" + piece * (500_000 // len(piece)) + "</b>" * 100_000
    start = time.perf_counter()
    read_feed(text)
    read_feed("<rss><channel><item>" + text)
    assert time.perf_counter() - start < 15
