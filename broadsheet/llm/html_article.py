"""The main text of web pages by tag-path ratios.

A page is read into blocks of text, each at the end of a path of block elements from the
root. Over all blocks of one path, text length, punctuation and link text are added up; the
ratios per block say what a path carries. A path's fused score is smoothed with the best
path that stands directly in one of the elements around it, so that titles, lists and
short notes inside the article rise with its paragraphs while what stands outside
does not. Paths above a share of the best score are content, and all their blocks are kept.

Elements and class names that state what they are (menus, footers, adverts, ...) weigh
nothing, and those that state the article weigh more. A name that says it among other words
(``post-header``, ``notice-period``) halves a path's own score only, and one that says what an
element has or lacks (``has-sidebar``) says nothing. A name, or a form, around the article
or around most of the page's text is no such statement: the ratios decide there.

Paths are numbers in a tree of steps, so a page takes time in proportion to its length,
however deep, broken or hostile it is.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SHARE = 0.25
LINKS = 0.7
ARTICLE_WEIGHT = 8.0

# Names of the markup language.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = "script|style|noscript|template|textarea|iframe|svg|title"
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr br".split()
)
# A start tag of the left ends an open element of the right.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}

# Words by which markup names what is no article, and what is.
_BOILERPLATE_TAGS = set("head nav footer aside form button select option dialog menu".split())
_BOILERPLATE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices newsletter subscribe subscription signup login sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer "
    "header masthead topbar toolbar comment comments disqus respond reply share sharing social related recommended popup modal overlay "
    "widget pagination pager".split()
)
# Words beside those that leave them what they are, and words that turn them into a property.
_COMPANIONS = set(
    "site page main top bottom left right inner outer box bar bars slot unit container wrapper wrap section block area list item items "
    "body text form link links button buttons icon icons posts articles stories thread author meta primary secondary global fixed sticky".split()
)
_PROPERTY = {"has", "no", "not", "non", "with", "without"}
_ARTICLE_TAGS = {"article", "main"}
# An element with this share of a page's text outside links is no boilerplate for its name.
MOST = 0.8

_TOKEN = re.compile(
    # a self-closed svg is empty and is tried first; behind a raw element's name its tag goes on or ends; quotes count behind = only
    rf"<!--.*?(?:-->|\Z)|<svg(?=[\s/])(?:[^\"'>/]|/(?!>)|\"[^\"]*+\"|'[^']*+')*+/>|<({_RAW})(?=[\s/>])[^>]*+>.*?(?:</\1\s*+>|\Z)"
    rf"|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>",
    re.S | re.I,
)
_NAMES = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")


_ORDINARY, _WEAK, _NAMED, _FORM, _STRONG = range(5)


class Paths:
    """The tree of a page's paths: node 0 is the empty path, a node's parent has a smaller number."""

    def __init__(self):
        self.numbers: dict[tuple[int, str], int] = {}
        self.parent, self.step, self.tag, self.kind, self.inside = [0], [""], [""], [_ORDINARY], [False]

    def below(self, parent: int, tag: str, attributes: str) -> int:
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)).lower() if "=" in attributes else ""
        step = f"{tag}.{names}" if names else tag
        node = self.numbers.setdefault((parent, step), len(self.parent))
        if node == len(self.parent):
            # a header inside the article is the article's own
            kind = _kind(tag, names, self.inside[parent])
            self.parent.append(parent)
            self.step.append(step)
            self.tag.append(tag)
            self.kind.append(kind)
            self.inside.append(self.inside[parent] or tag in _ARTICLE_TAGS and kind != _NAMED)
        return node

    def weights(self, text: list[int]) -> list[float]:
        """Every path's weight, given the text outside links directly at each."""
        n = len(self.parent)
        total, article, prose = text[:], [False] * n, [False] * n
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            total[up] += total[i]
            article[up] |= article[i] or self.inside[i] and not self.inside[up]
            prose[up] |= prose[i] or self.tag[i] in ("p", "h1")
        out = [1.0] * n
        for i in range(1, n):
            kind, most = self.kind[i], total[i] > 0 and total[i] >= MOST * total[0]
            lifted = kind == _NAMED and (most or article[i]) or kind == _FORM and (most and prose[i] or article[i])
            named_main = "main" in _WORDS.findall(self.step[i].partition(".")[2])
            if kind >= _NAMED and not lifted:
                out[i] = 0.0
            elif self.tag[i] in _ARTICLE_TAGS or named_main:
                out[i] = out[self.parent[i]] and ARTICLE_WEIGHT
            else:
                out[i] = out[self.parent[i]]
        return out


def _kind(tag: str, names: str, inside: bool) -> int:
    """What an element's tag and names state about it."""
    if tag in ("html", "body", "main"):
        return _ORDINARY
    if tag == "form":
        return _FORM
    if tag in _BOILERPLATE_TAGS or (tag == "header" and not inside):
        return _STRONG
    if tag == "header":
        return _ORDINARY
    found = _ORDINARY
    for name in names.split():
        words = set(_WORDS.findall(name))
        if words & _BOILERPLATE_WORDS and not words & _PROPERTY:
            if words <= _BOILERPLATE_WORDS | _COMPANIONS:
                return _NAMED
            found = _WEAK
    return found


class _Block:
    __slots__ = ("path", "parts", "text", "links")

    def __init__(self, path: int):
        self.path, self.parts, self.text, self.links = path, [], "", 0


def blocks_of(page: str) -> tuple[list[_Block], Paths]:
    """The blocks with text, in page order, and their paths. Markup is read leniently and never fails."""
    paths = Paths()
    stack: list[tuple[str, int]] = []  # tag, path
    places: dict[str, list[int]] = {}  # where a tag is open
    done: list[_Block] = []
    block: _Block | None = None

    def close() -> None:
        nonlocal block
        if block is not None:
            block.text = " ".join("".join(block.parts).split())
            if block.text:
                done.append(block)
            block = None

    def add(text: str) -> None:
        nonlocal block
        if not text:
            return
        if block is None:
            if text.isspace():
                return
            block = _Block(stack[-1][1] if stack else 0)
        text = html.unescape(text)
        block.parts.append(text)
        if places.get("a"):
            block.links += len(text)

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    def pop_to(tags, until=()) -> None:
        at = last(tags)
        if at > last(until):
            while len(stack) > at:
                places[stack.pop()[0]].pop()

    # nothing behind the last > is a tag
    at, end = 0, page.rfind(">") + 1
    for token in _TOKEN.finditer(page, 0, end):
        add(page[at : token.start()])
        at = token.end()
        if not token[3]:
            if at == end and (token[0].startswith("<!--") and not token[0].endswith("-->") or token[1] and not re.search(r"</[a-z]+\s*>\Z", token[0][-99:], re.I)):
                at = len(page)  # open to the end of the page
            continue
        tag = token[3].lower()
        inline = tag in _INLINE
        if not inline:
            close()
        if token[2]:
            pop_to((tag,))
            continue
        if tag == "br":
            add(" ")
        if not inline:
            pop_to(("p",), ("table", "td", "th", "button"))
            if tag in _ENDS:
                pop_to(_ENDS[tag], _HOLDS[tag])
        if tag not in _VOID:
            above = stack[-1][1] if stack else 0
            places.setdefault(tag, []).append(len(stack))
            stack.append((tag, above if inline else paths.below(above, tag, token[4])))
    rest = page[at:]
    opened = re.search(r"<[!?]", rest)
    add(rest[: opened.start()] if opened else rest)
    close()
    return done, paths


def path_scores(blocks: list[_Block], paths: Paths, links: float = LINKS) -> dict[int, float]:
    """The smoothed score of every path that has text."""
    n = len(paths.parent)
    sums: dict[int, list[int]] = {}
    text = [0] * n
    for b in blocks:
        own = sums.setdefault(b.path, [0, 0, 0, 0])
        own[0] += 1
        own[1] += len(b.text)
        own[2] += len(_PUNCTUATION.findall(b.text))
        own[3] += min(b.links, len(b.text))
        text[b.path] += len(b.text) - min(b.links, len(b.text))
    weights = paths.weights(text)
    score, best_in = {}, [0.0] * n
    for path, (count, length, marks, linked) in sums.items():
        weak = 0.5 if paths.kind[path] == _WEAK else 1.0
        score[path] = weak * weights[path] * (length - linked) / count * (1 + marks / count)
        up = paths.parent[path]
        best_in[up] = max(best_in[up], score[path])
    # the best of what stands directly in an element or in one around it, the page itself apart
    around = [0.0] * n
    for i in range(1, n):
        around[i] = max(around[paths.parent[i]], 0.0 if paths.step[i] in ("html", "body") else best_in[i])
    smooth = {}
    for path, (_, length, _, linked) in sums.items():
        near = max(best_in[paths.parent[path]], around[paths.parent[path]]) if path else 0.0
        smooth[path] = (score[path] + near) / 2 if weights[path] and linked <= links * length else 0.0
    return smooth


def main_text(page: str, share: float = SHARE, links: float = LINKS) -> str:
    """The article's blocks, joined by line ends; empty if the page has no text."""
    blocks, paths = blocks_of(page)
    smooth = path_scores(blocks, paths, links)
    top = max(smooth.values(), default=0.0)
    return "\n".join(b.text for b in blocks if smooth[b.path] >= share * top > 0)


def article_text(page: Column | str, share: float = SHARE, links: float = LINKS) -> Column:
    """The main text of each page. A null or empty page, or one without text, gives ''."""

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py() or "", share, links) for p in pages], pa.string())

    return run.asNondeterministic()(page)
