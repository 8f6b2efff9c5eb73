"""Pages as trees of blocks: elements that lay out blocks, and the runs of text inside them."""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field
from html import unescape
from html.parser import HTMLParser

# Fixed values of HTML: elements without end tag, elements that start a block, and elements whose
# content is no text of the page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot"
    " th thead tr ul".split()
)
NEVER_TEXT = frozenset(
    "head title script style template noframes iframe object svg canvas audio video map select option optgroup"
    " datalist button textarea input form dialog".split()
)
#: Start tags that end an open element of the second set, unless one of the third stands between.
_ENDS = {
    **{tag: (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])) for tag in ["li"]},
    **{tag: (frozenset(["dd", "dt"]), frozenset(["dl"])) for tag in ["dd", "dt"]},
    **{tag: (frozenset(["td", "th"]), frozenset(["table"])) for tag in ["td", "th"]},
    **{tag: (frozenset(["tr"]), frozenset(["table"])) for tag in ["tr"]},
}
_LINKS = frozenset(["a"])
_SECTION_END = re.compile(r"\]\s*+>")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Node:
    """An element (``text`` is None) or a run of text; ``parent`` is a place before this one."""

    parent: int
    tag: str
    names: frozenset[str] = frozenset()
    text: str | None = None
    linked: int = 0
    never: bool = False
    label: int | None = None
    hidden: bool = False


@dataclass(slots=True)
class _Open:
    tag: str
    node: int
    never: bool
    link: bool
    label: int | None


@dataclass(slots=True)
class _Run:
    parts: list[str] = field(default_factory=list)
    linked: int = 0


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node(-1, "html")]
        self.stack = [_Open("html", 0, False, False, None)]
        #: Places in the stack of the open elements of each tag, and of all blocks.
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self.run = _Run()

    def _push(self, one: _Open) -> None:
        self.places[one.tag].append(len(self.stack))
        if one.tag in BLOCKS:
            self.blocks.append(len(self.stack))
        self.stack.append(one)

    def _cut(self, place: int) -> None:
        """Close the element at a place of the stack and what is open inside it."""
        for one in self.stack[place:]:
            self.places[one.tag].pop()
        while self.blocks and self.blocks[-1] >= place:
            self.blocks.pop()
        del self.stack[place:]

    def _innermost(self, tags: frozenset[str]) -> int:
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=0)

    def _end_run(self) -> None:
        """Make a node of the text gathered since the last start or end of a block."""
        text = " ".join("".join(self.run.parts).split())
        if text:
            top = self.stack[-1]
            node = Node(top.node, "#text", text=text, linked=self.run.linked, never=top.never, label=top.label)
            self.nodes.append(node)
        self.run = _Run()

    def _close(self, tags: frozenset[str], within: frozenset[str] = frozenset()) -> None:
        """Close the innermost open element of ``tags`` and what is open inside it."""
        place = self._innermost(tags)
        if place > self._innermost(within):
            self._end_run()
            self._cut(place)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br" or tag == "hr":
            self.run.parts.append(" ")
        if tag in VOID:
            return
        if tag in BLOCKS:
            self._close(frozenset(["p"]), frozenset(["table", "td", "th", "button", "object"]))
            if tag in _ENDS:
                self._close(*_ENDS[tag])
        top = self.stack[-1]
        starts = tag in BLOCKS or (tag in NEVER_TEXT) != top.never
        given = dict(attrs)
        label = int(given["data-content"]) if given.get("data-content") in ("0", "1") else top.label
        never, link = top.never or tag in NEVER_TEXT, top.link or tag in _LINKS
        if not starts and never == top.never:
            self._push(_Open(tag, top.node, never, link, label))
            return
        self._end_run()
        names = " ".join(given.get(a) or "" for a in ("class", "id", "role", "itemprop"))
        parts = frozenset(part.lower() for part in _NAME_PARTS.findall(names))
        hidden = tag == "noscript" or given.get("hidden", "no") != "no" or given.get("aria-hidden") == "true"
        self.nodes.append(Node(top.node, tag, parts, never=never, label=label, hidden=hidden))
        self._push(_Open(tag, len(self.nodes) - 1, never, link, label))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        # A slash at the end of a start tag means nothing but on void elements.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        place = self.places[tag][-1] if self.places.get(tag) else 0
        # An inline end tag reaches no further than its block.
        if not place or (tag not in BLOCKS and self.blocks and self.blocks[-1] > place):
            return
        if any(one.node != self.stack[place - 1].node for one in self.stack[place:]):
            self._end_run()
        self._cut(place)

    def handle_data(self, data: str) -> None:
        self.run.parts.append(data)
        if self.stack[-1].link:
            self.run.linked += len("".join(data.split()))

    def unknown_decl(self, data: str) -> None:
        """A marked section (CDATA) is no text of a page."""


def _closed_only(html: str) -> tuple[str, str]:
    """The page up to its last tag, and the text after that.

    The parser looks for the end of a comment, a marked section or a tag from each of its starts. What
    never ends is made text first, so that it looks for none in vain.
    """
    last = html.rfind("-->") + 3 if "-->" in html else 0
    html = html[:last] + html[last:].replace("<!--", "&lt;!--")
    last = max((m.end() for m in _SECTION_END.finditer(html)), default=0)
    html = html[:last] + html[last:].replace("<![", "&lt;![")
    end = html.rfind(">") + 1
    return html[:end], unescape(html[end:])


def parse(html: str) -> list[Node]:
    """The page's blocks in page order, each after its parent; the first is the root.

    Character references are decoded, white space inside a block is one space, and blocks are
    trimmed. Unclosed and misplaced tags are closed as browsers do for the common cases; a tag or comment
    that the page ends in is text. The time is in proportion to the page's length.
    """
    builder = _Builder()
    tags, rest = _closed_only(html)
    builder.feed(tags)
    builder.close()
    if rest:
        builder.handle_data(rest)
    builder._end_run()
    return builder.nodes
