"""Pages as trees of elements and text runs, read in one tolerant pass over the markup.

A node is an element that breaks lines, an inline element whose class or id names something (an advert, a share
link), or a run of text. A run's block is what stands between two line breaks of the layout; runs of one block that
lie in different nodes are judged apart and joined again.

Tags that are left open end where the next block or the parent's end demands; ends without a start are passed over;
an unclosed comment, script or style reaches to the end of the page. Depth is bounded by memory alone. Time is linear
in the page, also where quotes, tags or elements are never closed.
"""

from __future__ import annotations

import html
import re
from array import array
from bisect import bisect_left

import numpy as np

_ATTRIBUTES = r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+"""
#: Elements whose inside is no markup, or never shown.
_RAW = "script|style|textarea|title|iframe|noembed|noframes|noscript|xmp|template|svg|math|object|select|canvas|video|audio"
_TOKEN = re.compile(rf"<(?:!--.*?(?:-->|\Z)|(?P<tag>/?[A-Za-z][^\s/>]*+{_ATTRIBUTES})>|[!?/][^>]*+>)", re.S)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I) for tag in _RAW.split("|")}
_QUOTED = re.compile(r"""=\s*+(["'])""")
_NAME = re.compile(r"/?[A-Za-z][^\s/>]*")
_NAMING = re.compile(r"""\b(class|id|role|aria-label|itemprop|data-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""\shidden(?=[\s=>]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none|visibility\s*:\s*hidden""", re.I)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_LABEL = re.compile(r"""\bdata-content\s*=\s*["']?([01])""", re.I)

#: Groups of tags, in the order of their numbers from 1; 0 is any other tag, the last a run of text.
GROUPS = ("html body", "article main", "nav menu", "header", "footer", "aside", "form fieldset label button input legend", "h1 h2 h3 h4 h5 h6", "p", "ul ol dl", "li dt dd", "table tbody thead tfoot tr", "td th", "blockquote pre figure figcaption", "div section center details", "a span b i em strong small ins u font time cite")
GROUP = {tag: k for k, tags in enumerate(GROUPS, 1) for tag in tags.split()}
LEAF = len(GROUPS) + 1
#: What words of a class, id or role hint at, a bit each.
HINTS = (
    "nav navbar navigation menu menus breadcrumb breadcrumbs toolbar tabs pagination pager",
    "header masthead topbar banner logo branding site tagline",
    "footer copyright colophon legal bottom contentinfo",
    "sidebar aside widget widgets rail secondary complementary related recommended recommendations popular trending teaser teasers",
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion adsbygoogle adbox adslot dfp",
    "cookie cookies consent notice notices alert gdpr popup modal overlay warning disclaimer paywall newsletter subscribe signup",
    "comment comments commentlist reply replies respond discussion disqus responses",
    "share sharing social follow tweet like bookmark",
    "form search login signin register feedback",
    "content article post entry story main text prose articlebody",
)
_HINT = {word: 1 << k for k, words in enumerate(HINTS) for word in words.split()}
HIDDEN = 1 << len(HINTS)
N_HINTS = len(HINTS) + 1
_GOOD = 1 << (len(HINTS) - 1)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br wbr img button".split())
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: An open element of the first kind ends at the start of any of the second, unless one of the third stands between.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}

_SEEN: dict[str, tuple[str, int, int]] = {}


def _closing(page: str):
    """A function that tells whether a tag that is open at a place is closed: whether a > comes outside the quoted values that begin from there."""
    ends = [i for i, c in enumerate(page) if c == ">"]
    quotes = {q: [i for i, c in enumerate(page) if c == q] for q in "\"'"}
    values = []  # (where a value's = stands, where the value ends)
    for m in _QUOTED.finditer(page):
        of = quotes[m[1]]
        k = bisect_left(of, m.end())
        if k < len(of):
            values.append((m.start(), of[k] + 1))
    starts = [v for v, _ in values]
    closed = [False] * (len(values) + 1)

    def from_(at: int) -> bool:
        k, e = bisect_left(starts, at), bisect_left(ends, at)
        if k == len(starts):
            return e < len(ends)
        return e < len(ends) and ends[e] < starts[k] or closed[k]

    for k in range(len(values) - 1, -1, -1):
        closed[k] = from_(values[k][1])
    return from_


def _tokens(page: str):
    """(start, end, inside of the tag or None) of comments, raw elements, declarations and tags, in order."""
    last, at, closed = page.rfind(">"), page.find("<"), None
    while at >= 0:
        if at > last:  # no tag closes any more
            at = page.find("<!--", at)
            if at >= 0:
                yield at, len(page), None
            return
        open_ = page[at + 1 : at + 3]
        if closed is not None and open_.lstrip("/")[:1].isalpha() and not closed(at + 1):
            if open_[0] != "/":
                at = page.find("<", at + 1)
                continue
            end = page.index(">", at) + 1  # an end tag is passed over as far as the next >
            yield at, end, None
            at = page.find("<", end)
            continue
        m = _TOKEN.match(page, at)
        if m is None:
            if closed is None:
                closed = _closing(page)
            at = page.find("<", at + 1)
            continue
        inside, end = m["tag"], m.end()
        shut = inside and _RAW_END.get(_NAME.match(inside)[0].lower())
        if shut:  # an element whose inside is no markup, to its end or that of the page
            inside, found = None, shut.search(page, end, last + 1)
            end = found.end() if found else len(page)
        yield at, end, inside
        at = page.find("<", end)


def _tag(raw: str) -> tuple[str, int, int]:
    """Name (with its slash), hints, and 1 or 2 for a label of 0 or 1, of the inside of a tag."""
    found = _SEEN.get(raw)
    if found is None:
        name = _NAME.match(raw)[0].lower()
        hints = label = 0
        if len(name) < len(raw):
            for _, value in _NAMING.findall(raw):
                for word in _WORD.findall(value):
                    hints |= _HINT.get(word.lower(), 0)
            if _HIDDEN.search(raw):
                hints |= HIDDEN
            if (m := _LABEL.search(raw)) is not None:
                label = 1 + int(m[1])
        found = (name, hints, label)
        if len(raw) < 200:
            if len(_SEEN) > 20_000:
                _SEEN.clear()
            _SEEN[raw] = found
    return found


class Trees:
    """The nodes of some pages end to end, parents before children; texts of the runs aside."""

    def __init__(self) -> None:
        self.parent, self.group, self.hints, self.label = array("q"), array("q"), array("q"), array("q")
        self.depth, self.link, self.page = array("q"), array("q"), array("q")
        self.texts: dict[int, str] = {}
        self.block: dict[int, int] = {}
        self.n_pages = 0

    def _node(self, parent: int, group: int, hints: int, label: int) -> int:
        self.parent.append(parent)
        self.group.append(group)
        self.hints.append(hints)
        self.label.append(label or (self.label[parent] if parent >= 0 else 0))
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.link.append(0)
        self.page.append(self.n_pages)
        return len(self.parent) - 1

    def add(self, page: str | None) -> None:
        page = page or ""
        root = self._node(-1, 0, 0, 0)
        names, nodes = ["#root"], [root]  # the open elements, and the node that text in each belongs to
        opened: dict[str, int] = {}  # how many elements of each name are open
        links, block = 0, 0
        leaf, parts, leaf_of = -1, [], -1

        def close() -> None:
            nonlocal leaf, parts
            if leaf >= 0:
                whole = "".join(parts)
                self.texts[leaf] = html.unescape(whole) if "&" in whole else whole
                leaf, parts = -1, []

        def text(raw: str) -> None:
            nonlocal leaf, leaf_of
            if leaf < 0 or leaf_of != nodes[-1]:
                if raw.isspace() and leaf < 0:
                    return
                close()
                leaf_of = nodes[-1]
                leaf = self._node(leaf_of, LEAF, 0, 0)
                self.block[leaf] = block
            parts.append(raw)
            if links:
                self.link[leaf] += len(raw)

        def pop_to(k: int) -> None:
            nonlocal links
            for name in names[k:]:
                links -= name == "a"
                opened[name] -= 1
            del names[k:], nodes[k:]

        def implied(kinds, stops) -> None:
            """Ends the innermost element of these kinds if it stands above the stops."""
            if not any(opened.get(x) for x in kinds):
                return
            for k in range(len(names) - 1, 0, -1):
                if names[k] in kinds:
                    pop_to(k)
                    if names[-1] in kinds:
                        implied(kinds, stops)
                    return
                if names[k] in stops:
                    return

        at = 0
        for start, end, raw in _tokens(page):
            if start > at:
                text(page[at:start])
            at = end
            if raw is None:
                continue
            name, hints, label = _tag(raw)
            if name[0] == "/":
                name = name[1:]
                if name in INLINE:
                    if not opened.get(name):
                        continue
                    # an inline end is heeded inside its own block only
                    for k in range(len(names) - 1, 0, -1):
                        if names[k] == name:
                            pop_to(k)
                            break
                        if names[k] not in INLINE:
                            break
                    continue
                close()
                block += 1
                if opened.get(name):
                    k = len(names) - 1
                    while names[k] != name:
                        k -= 1
                    if k:
                        pop_to(k)
                continue
            if name in INLINE:
                if name == "br":
                    text(" ")
                elif name not in VOID:
                    if name == "a" and links:  # a link ends the one before
                        implied({"a"}, ())
                    names.append(name)
                    opened[name] = opened.get(name, 0) + 1
                    links += name == "a"
                    nodes.append(self._node(nodes[-1], GROUP.get(name, 0), hints, label) if hints & ~_GOOD or label or name == "button" or name == "label" else nodes[-1])
                continue
            close()
            block += 1
            if name in ("html", "body"):  # once each; the root stands in for what is missing
                if opened.get(name):
                    continue
            if opened.get("p") and name in _CLOSES_P:
                implied({"p"}, {"button", "table", "td", "th", "object"})
            elif name in _ENDS:
                implied(*_ENDS[name])
            if name in VOID:
                continue
            names.append(name)
            opened[name] = opened.get(name, 0) + 1
            nodes.append(self._node(nodes[-1], GROUP.get(name, 0), hints, label))
        if at < len(page):
            rest = page[at:]
            # a tag that the page's end cuts off is no text
            cut = re.search(r"<[!/?A-Za-z][^<]*\Z", rest)
            text(rest[: cut.start()] if cut else rest)
        close()
        self.n_pages += 1

    def arrays(self) -> dict[str, np.ndarray]:
        return {k: np.frombuffer(getattr(self, k), "i8") if len(getattr(self, k)) else np.zeros(0, "i8") for k in ("parent", "group", "hints", "label", "depth", "link", "page")}
