"""Made-up pages with marked main text, from which the block classifier learns.

A page takes its frame, the order of its parts, the names of its classes and the lengths of its
texts from a seeded generator; no page of a table is used.
"""

from __future__ import annotations

import random

SYLLABLES = "ba ke lo mi nu ra se ti vo da en ir os ul an re th al ne".split()
NAMES = {  # common class names of the parts of pages
    "main": "content main-content article-body post post-content entry-content story article text page-content body-text",
    "header": "header site-header top masthead page-header banner-top topbar",
    "menu": "nav menu navbar main-menu navigation breadcrumb breadcrumbs topnav links",
    "side": "sidebar side widget secondary rail related most-read popular tags archive",
    "ad": "ad ads advert advertisement banner promo sponsored sponsor adsbox",
    "notice": "notice cookie cookie-notice consent gdpr alert popup newsletter subscribe message paywall",
    "comments": "comments comment-list commentlist discussion responses replies reader-comments",
    "share": "share social share-bar social-links tools meta byline",
    "footer": "footer site-footer bottom copyright legal page-footer colophon",
}
NAMES = {part: names.split() for part, names in NAMES.items()}


class PageMaker:
    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def word(self) -> str:
        return "".join(self.random.choices(SYLLABLES, k=self.random.randint(1, 4)))

    def prose(self, low: int, high: int) -> str:
        words = [self.word() for _ in range(self.random.randint(low, high))]
        for i in range(len(words)):
            if self.random.random() < 0.1:
                words[i] += self.random.choice([",", ",", ".", "!", "?"])
        return " ".join(words).capitalize() + self.random.choice([".", ".", ""])

    def pick(self, *options):
        return self.random.choice(options)

    def chance(self, share: float) -> bool:
        return self.random.random() < share

    def named(self, part: str) -> str:
        kind = self.random.random()
        if kind < 0.15:
            return ""
        if kind < 0.25:
            return f' class="{self.word()}"'
        return f' {self.pick("class", "class", "id")}="{self.pick(*NAMES[part])}"'

    def box(self, part: str, inner: str, *tags: str) -> str:
        tag = self.pick(*tags)
        return f'<{tag}{self.named(part)} data-main="0">{inner}</{tag}>'

    def block(self, tag: str, main: bool, inner: str, closed: bool = True) -> str:
        return f'<{tag} data-main="{int(main)}">{inner}' + (f"</{tag}>" if closed else "")

    def link(self, words: int = 3) -> str:
        return f'<a href="/{self.word()}">{self.prose(1, words)}</a>'

    def link_list(self) -> str:
        items = "".join(self.block("li", False, self.link()) for _ in range(self.random.randint(2, 12)))
        return self.block("ul", False, items)

    def small(self, part: str) -> str:
        """Prose, links or a form, as boxes beside the text have them."""
        kind = self.random.random()
        if kind < 0.35:
            return self.prose(2, 50)
        if kind < 0.6:
            return "".join(self.block("p", False, self.prose(3, 40)) for _ in range(self.random.randint(1, 3)))
        if kind < 0.85:
            return (self.block("h3", False, self.prose(1, 4)) if self.chance(0.5) else "") + self.link_list()
        return self.form() + self.prose(1, 15)

    def form(self) -> str:
        inner = self.block("label", False, self.prose(1, 3)) + '<input type="text">' + "<button>ok</button>"
        return self.box("notice", inner + (self.block("p", False, self.prose(2, 15)) if self.chance(0.4) else ""), "form")

    def inline(self, text: str) -> str:
        if self.chance(0.25):
            words = text.split()
            at = self.random.randrange(len(words))
            words[at] = self.pick("<b>{}</b>", "<i>{}</i>", '<a href="/x">{}</a>', "<b>{}", "<em>{}</em>", "{}<br>").format(words[at])
            text = " ".join(words)
        return text

    def main_part(self) -> str:
        kind = self.random.random()
        if kind < 0.72:
            # paragraphs are often left open, and may start with an open inline element
            return self.block("p", True, self.inline(self.prose(1, self.pick(8, 30, 120, 250))), self.chance(0.8))
        if kind < 0.8:
            return self.block(self.pick("h2", "h3"), True, self.prose(1, 8))
        if kind < 0.87:
            return self.block(self.pick("ul", "ol"), True, "".join(
                self.block("li", True, self.inline(self.prose(1, 25)), self.chance(0.8)) for _ in range(self.random.randint(1, 8))))
        if kind < 0.91:
            return self.block("blockquote", True, self.block("p", True, self.prose(5, 60)))
        if kind < 0.94:
            cells = lambda: "".join(self.block("td", True, self.prose(1, 4)) for _ in range(3))
            return self.block("table", True, "".join(self.block("tr", True, cells()) for _ in range(self.random.randint(1, 5))))
        if kind < 0.96:
            return self.block("pre", True, self.prose(3, 30))
        return self.block("div", True, self.inline(self.prose(3, 80)))

    def inset(self) -> str:
        """What stands among the paragraphs but does not belong to the text."""
        if self.chance(0.2):
            return self.form()
        part = self.pick("ad", "ad", "ad", "share", "side", "notice")
        inner = self.link_list() if part == "share" else self.small(part)
        return self.box(part, inner, "div", "div", "aside")

    def article(self) -> str:
        parts = [self.block("h1", True, self.prose(1, 14))] if self.chance(0.8) else []
        plain = self.chance(0.1)  # one block of bare text
        for _ in range(1 if plain else self.pick(1, 1, 2, 4, 8, 15)):
            parts.append(self.block("div", True, self.prose(20, 300)) if plain else self.main_part())
            if self.chance(0.12):
                parts.append(self.inset())
        if self.chance(0.25):
            parts.append(self.comments())
        inner = "".join(parts)
        tag = self.pick("article", "article", "article", "main", "div", "div", "section")
        made = f'<{tag}{self.named("main") if tag == "div" or self.chance(0.4) else ""} data-main="1">{inner}</{tag}>'
        for _ in range(self.pick(0, 0, 1, 2)):
            made = f'<{self.pick("div", "main", "section")}{self.named("main")} data-main="1">{made}' + "</div>"
        return made

    def comments(self) -> str:
        def comment():
            author = self.block(self.pick("p", "div", "h4"), False, self.pick(self.prose(1, 2), self.link(2)))
            text = self.block("p", False, self.prose(2, 70))
            return self.box("comments", author + text, "div", "li", "article")

        inner = "".join(comment() for _ in range(self.random.randint(1, 6)))
        title = self.block("h3", False, self.prose(1, 3)) if self.chance(0.6) else ""
        return self.box("comments", title + inner + (self.form() if self.chance(0.3) else ""), "section", "div", "ol", "div")

    def page(self) -> str:
        parts = []
        if self.chance(0.3):
            parts.append(self.box("notice", self.small("notice"), "div", "section", "aside"))
        if self.chance(0.5):
            logo = self.block("p", False, self.link()) if self.chance(0.5) else self.prose(1, 5)
            parts.append(self.box("header", logo + (self.form() if self.chance(0.3) else ""), "header", "div"))
        if self.chance(0.8):
            parts.append(self.box("menu", self.link_list(), "nav", "nav", "div"))
        if self.chance(0.5):
            parts.append(self.box("ad", self.small("ad"), "div", "div", "aside"))
        side = self.box("side", "".join(self.small("side") for _ in range(self.random.randint(1, 3))), "aside", "div", "section")
        where = self.random.random()
        parts.append((side if where < 0.15 else "") + self.article() + (side if where > 0.65 else ""))
        if self.chance(0.2):
            parts.append(self.comments())
        if self.chance(0.3):
            parts.append(self.box(self.pick("ad", "notice", "share"), self.small("ad"), "div", "aside"))
        if self.chance(0.85):
            foot = self.pick("&copy; ", "") + self.pick(self.prose(2, 40), self.link_list() + self.prose(2, 12))
            parts.append(self.box("footer", foot, "footer", "footer", "div"))
        head = f"<head><title>{self.prose(1, 8)}</title><script>var a = '<p>';</script></head>"
        return f'<!DOCTYPE html><html>{head}<body data-main="1">{"".join(parts)}</body></html>'


def pages(count: int, seed: int) -> list[str]:
    return [PageMaker(seed * 1_000_003 + i).page() for i in range(count)]
