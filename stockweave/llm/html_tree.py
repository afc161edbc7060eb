"""A page as a flat tree of blocks, and the features of each block."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from html.parser import HTMLParser
from zlib import crc32

import numpy as np

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset(
    "script style template noscript svg math iframe object canvas audio video head title select datalist button textarea".split()
)
#: What may stand in a head; all else ends it.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
BLOCKS = frozenset(
    "html body main article section nav aside header footer div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead "
    "tbody tfoot tr td th blockquote pre figure figcaption form fieldset legend address details summary center dialog "
    "hgroup menu search label".split()
)
#: Which open blocks a start tag ends, and the blocks behind which that does not reach.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "caption"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "thead": (frozenset(["caption"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "caption"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "caption"]), frozenset(["table"])),
}
PARAGRAPH_SCOPE = frozenset(["td", "th", "table", "caption", "html"])
LABEL = "data-main"  # marks the blocks of training pages; not a feature


@dataclass
class Block:
    """An element, or a run of text beside other blocks (tag ``#text``)."""

    tag: str
    parent: int
    tokens: frozenset = frozenset()
    main: bool | None = None
    pieces: list[str] = field(default_factory=list)
    link_chars: int = 0
    controls: int = 0
    images: int = 0

    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


WORDS = re.compile(r"[a-z]+|[A-Z][a-z]+|[A-Z]+")


class PageTree(HTMLParser):
    """Blocks of a page in page order; each comes after its parent."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.blocks = [Block("body", -1)]
        self.open = [0]  # places of the open blocks
        self.levels: dict[str, list[int]] = defaultdict(list)  # where in ``open`` those of a tag stand
        self.silent: list[str] = []  # open elements without text
        self.inner = Counter()  # blocks open in those
        self.links = 0
        self.has_children = {0: False}
        self.run: int | None = None  # the block that takes the next text
        self.feed(html)
        self.close()

    def unknown_decl(self, data):
        """Declarations say nothing."""

    def handle_starttag(self, tag, attrs):
        if self.silent == ["head"]:
            if tag in IN_HEAD:
                if tag in NO_TEXT and tag != "head":
                    self.silent.append(tag)
                return
            self.silent.clear()
        if self.silent:
            if tag not in VOID and tag == self.silent[-1] and tag not in ("script", "style"):
                self.silent.append(tag)
            self.inner[tag] += tag in BLOCKS
            return
        if tag in VOID:
            if tag in ("br", "hr", "wbr"):
                if tag != "wbr":
                    self._add(" ", False)
            else:
                block = self.blocks[self.open[-1]]
                block.controls += tag == "input"
                block.images += tag == "img"
            return
        if tag in NO_TEXT:
            self.blocks[self.open[-1]].controls += tag in ("button", "select", "textarea")
            self.silent.append(tag)
            return
        if tag == "a":
            self.links += 1
        if tag not in BLOCKS or tag == "html":
            return
        if tag == "body":
            self.blocks[0].tokens = _tokens(attrs)
            return
        if tag in ENDS:
            self._end(*ENDS[tag])
        elif tag not in ("label",):
            self._end(frozenset(["p"]), PARAGRAPH_SCOPE)
        parent = self.open[-1]
        marked = dict(attrs).get(LABEL)
        self.blocks.append(Block(tag, parent, _tokens(attrs), None if marked is None else marked == "1"))
        self.levels[tag].append(len(self.open))
        self.open.append(len(self.blocks) - 1)
        self.has_children[parent], self.has_children[self.open[-1]] = True, False
        self.run = None

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag):
        if self.silent:
            if tag == self.silent[-1]:
                self.silent.pop()
                if not self.silent or self.silent == ["head"]:
                    self.inner.clear()
                return
            if self.inner[tag]:
                self.inner[tag] -= 1
                return
            if tag not in ("head", "body", "html") and not self.levels[tag]:
                return
            self.silent.clear()  # left open in a block that ends here
        if tag == "a":
            self.links = max(0, self.links - 1)
        elif tag in BLOCKS and tag not in ("html", "body"):
            self._end(frozenset([tag]), frozenset(["html"]) if tag != "p" else PARAGRAPH_SCOPE)

    def handle_data(self, data):
        if self.silent == ["head"] and data.strip():
            self.silent.clear()
        if not self.silent:
            self._add(data, self.links > 0)

    def _end(self, tags: frozenset, scope: frozenset) -> None:
        """Close the innermost open block of these tags, and all in it, unless it lies behind the scope."""
        level, border = (
            max((self.levels[tag][-1] for tag in some if self.levels[tag]), default=0) for some in (tags, scope)
        )
        if level <= border:
            return
        for place in self.open[level:]:
            self.levels[self.blocks[place].tag].pop()
        del self.open[level:]
        self.run, self.links = None, 0

    def _add(self, text: str, linked: bool) -> None:
        if self.run is None:
            here = self.open[-1]
            if here == 0 or self.has_children[here]:
                if not text.strip():
                    return
                self.blocks.append(Block("#text", here))
                self.has_children[here] = True
                self.run = len(self.blocks) - 1
            else:
                self.run = here
        block = self.blocks[self.run]
        block.pieces.append(text)
        if linked:
            block.link_chars += len(text.strip())


def _tokens(attrs) -> frozenset:
    """Words of the class, id and role of an element."""
    named = " ".join(value for name, value in attrs if name in ("class", "id", "role", "itemprop") and value)
    return frozenset(word.lower() for word in WORDS.findall(named)) if named else frozenset()


TAGS = (
    "#text body main article section nav aside header footer div p h1 h2 h3 ul ol li dl table tr td blockquote pre figure "
    "figcaption form address label"
).split()
REGIONS = "main article section nav aside header footer form table ul".split()
BUCKETS = 256
NUMBERS = 24
WIDTH = NUMBERS + len(TAGS) + len(REGIONS) + 2 * BUCKETS
_TAG_PLACE = {tag: NUMBERS + i for i, tag in enumerate(TAGS)}
_REGION_PLACE = {tag: NUMBERS + len(TAGS) + i for i, tag in enumerate(REGIONS)}
_TOKENS_AT = NUMBERS + len(TAGS) + len(REGIONS)


def features(blocks: list[Block], texts: list[str]) -> np.ndarray:
    """A row of features for each block of a page."""
    n = len(blocks)
    parent = np.array([b.parent for b in blocks])
    own = np.array([len(t) for t in texts], dtype=np.float64)
    sums = np.zeros((n, 9))  # chars, link chars, blocks, paragraphs, marks, controls, images, items, headings
    for i, (block, text) in enumerate(zip(blocks, texts)):
        sums[i] = (
            len(text), min(block.link_chars, len(text)), 1, block.tag == "p", text.count(",") + text.count(". "),
            block.controls, block.images, block.tag == "li", block.tag in ("h1", "h2", "h3"),
        )
    before = np.cumsum(own) - own
    for i in range(n - 1, 0, -1):  # children come after their parents
        sums[parent[i]] += sums[i]
    chars, total = sums[:, 0], max(sums[0, 0], 1.0)
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        children[parent[i]].append(i)
    found = np.zeros((n, WIDTH), dtype=np.float32)
    depth = np.zeros(n)
    headed = 0.0
    for i, block in enumerate(blocks):
        row = found[i]
        if i:
            up = parent[i]
            depth[i] = depth[up] + 1
            siblings = children[up]
            row[NUMBERS + len(TAGS) : _TOKENS_AT] = found[up][NUMBERS + len(TAGS) : _TOKENS_AT]
            row[_TOKENS_AT + BUCKETS :] = found[up][_TOKENS_AT + BUCKETS :]
            row[1] = len(siblings)
            row[17] = chars[up] / total
        if block.tag in _TAG_PLACE:
            row[_TAG_PLACE[block.tag]] = 1
        if block.tag in _REGION_PLACE:
            row[_REGION_PLACE[block.tag]] = 1
        for token in block.tokens:
            at = crc32(token.encode()) % BUCKETS
            row[_TOKENS_AT + at] = row[_TOKENS_AT + BUCKETS + at] = 1
        row[22] = headed
        headed = 1.0 if block.tag == "h1" else headed
    for siblings in children:
        size = len(siblings)
        if not size:
            continue
        tags = Counter(blocks[i].tag for i in siblings)
        for place, i in enumerate(siblings):
            found[i, 2] = place / size
            found[i, 3] = tags[blocks[i].tag] / size
            found[i, 18] = np.log1p(chars[siblings[place - 1]]) if place else 0
            found[i, 19] = np.log1p(chars[siblings[place + 1]]) if place + 1 < size else 0
    found[:, 0] = depth
    found[:, 4], found[:, 5] = np.log1p(chars), np.log1p(own)
    found[:, 6] = sums[:, 1] / np.maximum(chars, 1)
    found[:, 7] = chars / total
    found[:, 8] = np.log1p(sums[:, 2])
    found[:, 9] = np.log1p(chars / sums[:, 2])
    found[:, 10] = np.log1p(sums[:, 3])
    found[:, 11], found[:, 12] = before / total, (before + chars) / total
    found[:, 13] = 100 * sums[:, 4] / np.maximum(chars, 50)
    found[:, 14], found[:, 15] = np.log1p(sums[:, 5]), np.log1p(sums[:, 6])
    found[:, 16] = sums[:, 7] / sums[:, 2]
    found[:, 20], found[:, 21] = np.log1p(total), np.log1p(sums[:, 8])
    found[:, 23] = np.log1p(n)
    return found
