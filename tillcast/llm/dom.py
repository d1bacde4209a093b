"""A tolerant reader of HTML into blocks and runs of text, and what can be measured on them.

Plain Python for use inside tasks. Blocks are the elements that break a line; what lies directly in a
block between two others is a run of text, whatever inline elements it is marked with. Scripts, styles
and the like leave nothing. Missing and stray end tags are handled as browsers do in the usual cases.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape
from math import log1p

# Element names with a part in the structure of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style noscript template head title textarea select svg iframe canvas button "
    "datalist annotation annotation-xml".split()
)
RAW = frozenset("script style textarea title iframe noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var nobr audio object video "
    "math menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow "
    "ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul li dd dt".split()
)
# By element, what an element of that kind ends when it starts, and what it never ends beyond.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
NAMES = re.compile(
    r"(?:^|\s)(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
UNSEEN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
TOKEN = re.compile(r"[a-z]+", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# Groups of words in attributes.
GROUPS = {
    "main": "article articlebody body content entry hentry main page post single story text",
    "menu": "breadcrumb breadcrumbs crumbs dropdown menu menubar nav navbar navigation pager pagination "
    "skip tabs toc toolbar topbar",
    "advert": "ad ads adsense advert advertisement advertorial adslot banner dfp doubleclick outbrain partner "
    "promo promoted promotion sponsor sponsored taboola",
    "side": "aside complementary latest more morelinks popular recent recommended related sidebar side "
    "teaser trending widget widgets rail",
    "comment": "comment comments commentlist discussion disqus feedback replies reply respond reviews "
    "responses thread",
    "edge": "bottom colophon contentinfo copyright footer foot header head imprint legal logo masthead "
    "site",
    "notice": "alert consent cookie cookies disclaimer gdpr message modal newsletter notice notification "
    "overlay paywall popup privacy signup subscribe subscription toast warning",
    "share": "author bio byline follow like meta share sharing social tag tags tweet",
    "form": "button captcha field form input login password register search submit",
}
WORD_GROUP = {}
for _name, _words in GROUPS.items():
    for _word in _words.split():
        WORD_GROUP.setdefault(_word, []).append(list(GROUPS).index(_name))
KINDS = (
    "article main",
    "section",
    "div",
    "p",
    "h1",
    "h2 h3 h4 h5 h6",
    "ul ol menu dl",
    "li dt dd",
    "table tbody thead tfoot tr td th",
    "blockquote pre figure figcaption",
    "header",
    "footer",
    "nav",
    "aside",
    "form fieldset",
    "body html",
    "dialog details summary address",
)
KIND = {tag: i for i, tags in enumerate(KINDS) for tag in tags.split()}


@dataclass
class Node:
    """A block, or a run of text (tag ``""``)."""

    tag: str
    parent: int
    depth: int
    names: str = ""
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


class Open:
    """Open elements, each with the block it is in; what is asked of them is counted as they come and go.

    Every question takes a time that doesn't depend on how many are open. The root is in no count.
    """

    def __init__(self):
        self.stack: list[tuple[str, int]] = [("html", 0)]
        self.places: dict[str, list[int]] = {}  # by name, where it is open
        self.inline: list[dict[str, int]] = [{}]  # by open block, the inline elements open right in it
        self.silent = 0  # open elements inside which text is no text
        self.links = 0

    def push(self, name: str, block: int) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, block))
        plain = name.lstrip("!")
        if plain in INLINE:
            self.inline[-1][plain] = self.inline[-1].get(plain, 0) + 1
        else:
            self.inline.append({})
        self.silent += name in SILENT or name.startswith("!")
        self.links += name == "a"

    def pop(self) -> str:
        name, _ = self.stack.pop()
        self.places[name].pop()
        plain = name.lstrip("!")
        if plain in INLINE:
            self.inline[-1][plain] -= 1
        else:
            self.inline.pop()
        self.silent -= name in SILENT or name.startswith("!")
        self.links -= name == "a"
        return name

    def cut(self, size: int) -> None:
        while len(self.stack) > size:
            self.pop()

    def last(self, names) -> int:
        """Where the innermost element of these names is, 0 if none is open."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def close(self, ended: frozenset, beyond: frozenset, run):
        """End the innermost open element of ``ended`` unless one of ``beyond`` lies between."""
        found = self.last(ended)
        if found > self.last(beyond - ended):
            self.cut(found)
            return None
        return run


def parse(html: str) -> list[Node]:
    """The blocks and runs of a page in document order, parents before children; the root is first."""
    nodes = [Node("html", -1, 0)]
    opened = Open()
    stack = opened.stack
    run: Node | None = None
    at, end = 0, len(html)
    while at < end:
        mark = html.find("<", at)
        found = MARKUP.match(html, mark) if mark >= 0 else None
        stop = mark if found else (end if mark < 0 else mark + 1)
        if stop > at and not opened.silent:
            piece = unescape(html[at:stop]) if "&" in html[at:stop] else html[at:stop]
            if run is None and not piece.isspace():
                block = stack[-1][1]
                run = Node("", block, nodes[block].depth + 1)
                nodes.append(run)
            if run is not None:
                run.parts.append(piece)
                if opened.links:
                    run.linked += len(piece)
        at = stop
        if not found:
            continue
        at = found.end()
        tag = found[2] or found[5]
        if tag is None:
            continue
        tag = tag.lower()
        closing = found[1] or found[4]
        attributes = found[3] if found[2] else found[6]
        if closing:
            if not opened.last((tag, "!" + tag)):
                if tag == "p" or tag not in INLINE:
                    run = None
                elif tag == "br" and run is not None:
                    run.parts.append(" ")
                continue
            if tag in INLINE and not opened.inline[-1].get(tag):
                continue  # an inline end tag doesn't leave the block
            while True:
                name = opened.pop()
                if name not in INLINE:
                    run = None
                if name.lstrip("!") == tag:
                    break
            continue
        if tag == "br" or tag == "wbr":
            if run is not None and tag == "br":
                run.parts.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                run = None
            continue
        if tag in ("html", "body"):
            if tag == "body":
                nodes[0].names += " " + _names(attributes)
                opened.cut(1)
                run = None
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            at = close.end() if close else end
            continue
        if tag in ENDS_P:
            run = opened.close(frozenset(["p"]), CONTAINERS, run)
        if tag in ENDS:
            run = opened.close(*ENDS[tag], run)
        if tag[0] == "h" and tag in KINDS[5] + " h1" and stack[-1][0] in HEADINGS:
            opened.pop()
            run = None
        if attributes.rstrip().endswith("/") and tag in SILENT:
            continue
        if _hidden(attributes):
            tag = "!" + tag
        block = stack[-1][1]
        if tag in INLINE or tag.startswith("!") or tag in SILENT:
            opened.push(tag, block)
            if tag not in INLINE and tag.lstrip("!") not in INLINE:
                run = None
            continue
        run = None
        nodes.append(Node(tag, block, nodes[block].depth + 1, _names(attributes)))
        opened.push(tag, len(nodes) - 1)
    for node in nodes:
        if not node.tag:
            node.text = " ".join("".join(node.parts).split())
    return [node for node in _kept(nodes)]


HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("article aside main section div td th table form body html nav header footer".split())


def _hidden(attributes: str) -> bool:
    """Whether an attribute says so: ``hidden``, ``aria-hidden`` or the style, by its own value."""
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), unescape("".join(values)).strip()
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and UNSEEN.search(value):
            return True
    return False


def _names(attributes: str) -> str:
    return " ".join("".join(m) for m in NAMES.findall(attributes))


def _kept(nodes: list[Node]) -> list[Node]:
    """Without runs that turned out empty; nothing names a run as its parent."""
    if all(node.tag or node.text for node in nodes):
        return nodes
    place, kept = {}, []
    for i, node in enumerate(nodes):
        if node.tag or node.text:
            place[i] = len(kept)
            kept.append(node)
    for node in kept:
        node.parent = place.get(node.parent, -1)
    return kept


def groups_of(names: str) -> list[float]:
    found = [0.0] * len(GROUPS)
    for word in TOKEN.findall(CAMEL.sub(" ", names)):
        for group in WORD_GROUP.get(word.lower(), ()):
            found[group] += 1
    return found


def measured(nodes: list[Node]) -> list[list[float]]:
    """One row of numbers for each node: kind, attribute words of itself and of its ancestors, depth,
    place, density of text and links in its subtree, and how it compares with its siblings."""
    n = len(nodes)
    chars, linked, words, stops, runs, blocks, paragraphs = ([0.0] * n for _ in range(7))
    children: list[list[int]] = [[] for _ in range(n)]
    start, total, place_of = [0.0] * n, 0.0, [0] * n
    for i, node in enumerate(nodes):
        if node.parent >= 0:
            place_of[i] = len(children[node.parent])
            children[node.parent].append(i)
        start[i] = total
        if not node.tag:
            chars[i] = len(node.text)
            linked[i] = min(node.linked, len(node.text))
            words[i] = node.text.count(" ") + 1
            stops[i] = sum(map(node.text.count, ".,;:!?"))
            runs[i] = 1
            total += chars[i]
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        for column in (chars, linked, words, stops, runs, blocks, paragraphs):
            column[p] += column[i]
        blocks[p] += bool(nodes[i].tag)
        paragraphs[p] += nodes[i].tag == "p"
    total = max(total, 1.0)
    same = [Counter(nodes[c].tag for c in of) for of in children]
    own = [groups_of(node.names) if node.names else [0.0] * len(GROUPS) for node in nodes]
    above: list[list[float]] = []
    inside: list[list[float]] = []  # kinds among the ancestors
    rows = []
    for i, node in enumerate(nodes):
        p = node.parent
        if p < 0:
            above.append([0.0] * len(GROUPS))
            inside.append([0.0] * len(KINDS))
            siblings = [i]
        else:
            above.append([a + b for a, b in zip(above[p], own[p])])
            kinds = inside[p]
            if nodes[p].tag in KIND:
                kinds = list(kinds)
                kinds[KIND[nodes[p].tag]] += 1
            inside.append(kinds)
            siblings = children[p]
        kind = [0.0] * (len(KINDS) + 1)
        if node.tag:
            kind[KIND.get(node.tag, len(KINDS))] = 1.0
        place = place_of[i]
        before = chars[siblings[place - 1]] if place else 0.0
        after = chars[siblings[place + 1]] if place + 1 < len(siblings) else 0.0
        around = (chars[p] if p >= 0 else total) or 1.0
        c = chars[i] or 1.0
        rows.append(
            [
                float(not node.tag),
                *kind,
                *own[i],
                *above[i],
                *inside[i],
                float(node.depth),
                log1p(chars[i]),
                log1p(words[i]),
                linked[i] / c,
                stops[i] / max(words[i], 1.0),
                (blocks[i] + 1) / c * 100,
                c / max(runs[i], 1.0),
                paragraphs[i] / max(blocks[i], 1.0),
                chars[i] / total,
                start[i] / total,
                chars[i] / around,
                (linked[p] / around) if p >= 0 else 0.0,
                float(len(siblings)),
                place / len(siblings),
                log1p(before),
                log1p(after),
                same[p][node.tag] / len(siblings) if p >= 0 else 1.0,
                float("©" in node.text),
                float(node.text.endswith((".", "!", "?", ":", '"', "”"))),
            ]
        )
    return rows
