"""Reading feeds as they come: a pull tokenizer for XML that need not be well-formed.

One pass over the text. What is not markup is text: a bare ``&`` or ``<``, names of characters that
nobody declared, anything between items. An item that opens while another is open drops that one, which
has no end; its end closes whatever it left open. So every whole item is kept, and no fault
reaches beyond the item it stands in.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.entities import name2codepoint

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The namespaces that feeds are made of.
NAMESPACES = {
    "http://www.w3.org/2005/Atom": "atom",
    "http://purl.org/rss/1.0/": "",
    "http://purl.org/rss/1.0/modules/content/": "content",
    "http://purl.org/dc/elements/1.1/": "dc",
}

# The fields of an item, and what they are called in RSS and in Atom.
FIELDS = ["title", "link", "guid", "whole", "short", "published", "updated", "author", "creator"]
RSS = {
    "title": "title", "link": "link", "guid": "guid", "content:encoded": "whole", "description": "short",
    "pubDate": "published", "dc:date": "updated", "author": "author", "dc:creator": "creator",
}
ATOM = {"title": "title", "link": "link", "content": "whole", "summary": "short", "published": "published", "updated": "updated"}
FEED = f"title string, items array<struct<{', '.join(f'{f}: string' for f in FIELDS)}>>"

# Possessive loops that stop at the next "<": no byte is looked at again.
_TAG = re.compile(r"""<(/?)([A-Za-z_][\w.:-]*+)((?:\s(?:[^<>"']|"[^"<]*+"|'[^'<]*+')*+)?+/?+)>""")
_ATTRIBUTE = re.compile(r"""([\w.:-]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)')""")
_REFERENCE = re.compile(r"&(?:#(\d{1,7})|#[xX]([0-9A-Fa-f]{1,6})|([A-Za-z][A-Za-z0-9]*+));")
_SECTIONS = (("<![CDATA[", "]]>"), ("<!--", "-->"), ("<?", "?>"), ("<!", ">"))
_BLANK = "".join(map(chr, range(33)))
_XML_NAMES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


def decoded(text: str) -> str:
    """Character references become characters; what is none stays as it is."""
    return _REFERENCE.sub(_character, text) if "&" in text else text


def _character(found: re.Match) -> str:
    decimal, hexadecimal, name = found.groups()
    if name:
        return _XML_NAMES.get(name) or (chr(name2codepoint[name]) if name in name2codepoint else found[0])
    code = int(decimal) if decimal else int(hexadecimal, 16)
    return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else found[0]


def tokens(text: str) -> Iterator[tuple]:
    """("text", decoded), ("open", name, attributes as text, closed), ("close", name), each with its source last."""
    at, size, ended = 0, len(text), set()
    while at < size:
        mark = text.find("<", at)
        if mark < 0:
            mark = size
        if mark > at:
            yield "text", decoded(text[at:mark]), text[at:mark]
        if mark == size:
            return
        at = mark
        section = next((s for s in _SECTIONS if text.startswith(s[0], at)), None) if text[at + 1 : at + 2] in ("!", "?") else None
        if section:
            first, last = section
            # an end that was missed once is not looked for again
            end = -1 if last in ended else text.find(last, at + len(first))
            if end >= 0:
                if first == "<![CDATA[":
                    yield "text", text[at + 9 : end], text[at : end + 3]
                at = end + len(last)
                continue
            ended.add(last)
        found = _TAG.match(text, at)
        if found:
            closing, name, rest = found.groups()
            yield ("close", name, found[0]) if closing else ("open", name, rest, rest.endswith("/"), found[0])
            at = found.end()
        else:
            yield "text", "<", "<"
            at += 1


def attributes(text: str) -> dict[str, str]:
    return {name: decoded(a or b) for name, a, b in _ATTRIBUTE.findall(text)}


class _Path(list):
    """Names of open elements; whether one is open is known without a search."""

    def __init__(self):
        super().__init__()
        self.open = Counter()

    def append(self, name: str) -> None:
        super().append(name)
        self.open[name] += 1

    def pop(self) -> str:
        name = super().pop()
        self.open[name] -= 1
        return name


class _Item:
    """The open item: its fields, and the open field's path and text."""

    def __init__(self, atom: bool):
        self.atom, self.values, self.path, self.parts, self.permalink = atom, {}, _Path(), [], True

    def open(self, name: str, rest: str, closed: bool, source: str) -> None:
        if not self.path:
            self.parts = []
            if self.atom and name == "link":
                given = attributes(rest)
                if given.get("rel", "alternate") == "alternate" and given.get("href"):
                    self.values.setdefault("link", given["href"].strip(_BLANK))
            elif name == "guid":
                self.permalink = attributes(rest).get("isPermaLink", "true") == "true"
        elif self.path[0] != "author" or not self.atom:
            self.parts.append(source)
        elif name == "name":
            self.parts = []
        if not closed:
            self.path.append(name)

    def close(self, name: str, source: str) -> None:
        if not self.path.open[name]:
            return
        while self.path:
            last = self.path.pop()
            if self.atom and last == "name" and self.path == ["author"]:
                self._put("author")
            if not self.path:
                self._put((ATOM if self.atom else RSS).get(last) if not (self.atom and last == "link") else None)
            elif self.path[0] != "author" or not self.atom:
                self.parts.append(source)
            if last == name:
                return

    def _put(self, field: str | None) -> None:
        value = "".join(self.parts).strip(_BLANK)
        self.parts = []
        if field and value and (field != "guid" or self.permalink):
            self.values.setdefault(field, value)

    def end(self) -> dict[str, str]:
        if self.path:
            self.close(self.path[0], "")
        return self.values


def read_feed(text: str | None) -> dict | None:
    """The title and the whole items of a feed; null if it has none."""
    text = (text or "").replace("\r\n", "\n").replace("\r", "\n")
    names, root, stack, parts = {}, None, _Path(), []
    title, items, item = None, [], None

    def plain(name: str) -> str:
        """A name without the prefix of its own document, others by what their prefix stands for."""
        prefix, colon, local = name.rpartition(":")
        known = names.get(prefix) if colon else ""
        if known is None:
            known = "" if prefix == root else prefix
        return f"{known}:{local}" if known else local

    for kind, first, *more in tokens(text):
        if kind == "text":
            if item:
                if item.path:
                    item.parts.append(first)
            elif stack and stack[-1] == "title":
                parts.append(first)
            continue
        if kind == "open":
            rest, closed, source = more
            if root is None:
                root = first.rpartition(":")[0]
            if "xmlns:" in rest:
                names |= {n[6:]: NAMESPACES[v] for n, v in attributes(rest).items() if n.startswith("xmlns:") and v in NAMESPACES}
            name = plain(first)
            if name in ("item", "entry", "atom:entry"):
                item = None if closed else _Item(name != "item")
            elif item:
                item.open(name.removeprefix("atom:") if item.atom else name, rest, closed, source)
            elif not closed:
                stack.append(name.removeprefix("atom:"))
                parts = []
            continue
        name = plain(first)
        if item and name in ("item", "entry", "atom:entry"):
            if item.atom == (name != "item"):
                items.append({f: None for f in FIELDS} | item.end())
                item = None
        elif item:
            item.close(name.removeprefix("atom:") if item.atom else name, more[0])
        else:
            name = name.removeprefix("atom:")
            if name == "title" and stack[-2:-1] in (["channel"], ["feed"]) and title is None:
                title = "".join(parts).strip(_BLANK) or None
            while stack.open[name] and stack.pop() != name:
                pass
    return {"title": title, "items": items} if items else None


def feed_of(value: Column | str) -> Column:
    """``read_feed`` of landed feeds, as a column."""

    @F.arrow_udf(FEED)
    def run(values: pa.Array) -> pa.Array:
        item = pa.struct([(f, pa.string()) for f in FIELDS])
        kind = pa.struct([("title", pa.string()), ("items", pa.list_(item))])
        return pa.array([read_feed(v.as_py()) for v in values], kind)

    return run.asNondeterministic()(value)
