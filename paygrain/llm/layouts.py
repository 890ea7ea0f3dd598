"""Labelled training pages: texts of given pages in many layouts, main text and the rest known."""

from __future__ import annotations

import html
from collections.abc import Sequence

import numpy as np

WORDS = (
    "time year people way day man thing woman life child world school state family student group country problem "
    "hand part place case week company system program question work number night point home water room mother area "
    "money story fact month lot right study book eye job word business issue side kind head house service friend"
).split()
MAIN = (
    "article", "main", "section", "div.article", "div.content", "div#content", "div.post", "div.entry", "div.story",
    "div.post-content", "div.article-body", "div.main-content", "div#main", "div.entry-content", "div.text", "div.body",
    "section.article", "div.markdown", "div.prose", "div.page-content", "td.content", "div#article", "div.blog-post", "div",
)
WRAP = ("div", "div.container", "div.wrapper", "div#page", "div.row", "section", "div.layout", "div.inner", "main", "")
MENU = (
    "nav", "nav.menu", "div.nav", "div.menu", "div#menu", "ul.navbar", "div.navigation", "div.breadcrumbs",
    "div.breadcrumb", "div.navbar", "ul.nav", "div.pagination", "div.tags", "menu", "div.toc", "div.sitemap", "div.topbar",
)
HEADER = ("header", "div.header", "div#header", "div.masthead", "div.top", "header.site-header", "div.site-header", "div.branding")
FOOTER = ("footer", "div.footer", "div#footer", "div.copyright", "div.legal", "div.bottom", "footer.site-footer", "div.colophon")
SIDE = (
    "aside", "div.sidebar", "div#sidebar", "aside.sidebar", "div.widget", "div.related", "div.recommended", "div.aside",
    "div.trending", "div.popular", "div.more", "section.related", "div.rail", "aside.related", "div.author-box",
)
ADVERT = (
    "div.ad", "div.ads", "div.advert", "div.advertisement", "div.sponsor", "div.sponsored", "div.promo", "div#ad",
    "div.banner", "aside.ad", "div.ad-slot", "div.adbox", "section.promo", "p.ad", "div.promotion",
)
NOTICE = (
    "div.cookie", "div.notice", "div.consent", "div.alert", "div.popup", "div.modal", "div.cookie-notice", "div.gdpr",
    "div#cookie-banner", "section.notice", "div.warning", "div.newsletter", "div.subscribe", "div.paywall", "dialog",
    "aside.notice", "div.disclaimer", "div.cookies", "div.message", "p.notice",
)
FORM = ("form", "div.login", "div.signup", "form.search", "div.search", "form#subscribe", "fieldset", "div.form", "form.contact")
COMMENTS = (
    "section.comments", "div.comments", "div#comments", "ol.comment-list", "div.comment", "div.replies", "div.discussion",
    "div.responses", "section#comments", "ul.comments", "div.comment-thread", "div.reader-comments", "div.feedback",
)
SHARE = ("div.share", "div.social", "ul.share", "div.sharing", "div.byline-tools", "div.toolbar")
REST = {
    "menu": MENU, "header": HEADER, "footer": FOOTER, "side": SIDE, "advert": ADVERT, "notice": NOTICE, "form": FORM,
    "comments": COMMENTS, "share": SHARE,
}


class Layouts:
    """Pages with random layouts from one generator; ``texts`` are blocks of any kind."""

    def __init__(self, texts: Sequence[str], seed: int) -> None:
        self.rng = np.random.default_rng(seed)
        self.texts = [t for t in texts if t]

    def pick(self, names: Sequence[str]) -> str:
        return names[int(self.rng.integers(len(names)))]

    def words(self, least: int, most: int) -> str:
        size = int(self.rng.integers(least, most + 1))
        if self.texts and self.rng.random() < 0.8:
            words = self.pick(self.texts).split()
            start = int(self.rng.integers(max(1, len(words) - size)))
            words = words[start : start + size]
        else:
            words = [self.pick(WORDS) for _ in range(size)]
        return html.escape(" ".join(words) or self.pick(WORDS))

    def prose(self) -> str:
        kind = self.rng.random()
        text = self.words(1, 8) if kind < 0.15 else self.words(8, 40) if kind < 0.5 else self.words(40, 160)
        if self.rng.random() < 0.2:
            text = f"<a href='/x'>{self.words(1, 4)}</a> {text}"
        return f"<b>{text}</b>" if self.rng.random() < 0.05 else text

    def inside(self, element: str, content: str) -> str:
        if not element:
            return content
        name = element.replace("#", ".").split(".")[0]
        given = element[len(name) + 1 :]
        attribute = f' {"id" if "#" in element else "class"}="{given}"' if given else ""
        if given and self.rng.random() < 0.3:
            attribute += f' data-k="{self.rng.integers(99)}"'
        return f"<{name}{attribute}>{content}</{name}>"

    def article(self) -> list[tuple[str, int]]:
        parts: list[tuple[str, int]] = []
        if self.rng.random() < 0.85:
            heading = f"<h1>{self.words(2, 12)}</h1>"
            parts.append((f"<header>{heading}</header>" if self.rng.random() < 0.1 else heading, 1))
        for _ in range(int(self.rng.integers(1, 14))):
            kind = self.rng.random()
            if kind < 0.75:
                parts.append((f"<p>{self.prose()}" + "</p>" * (self.rng.random() < 0.9), 1))
            elif kind < 0.82:
                parts.append((f"<{(h := self.pick(('h2', 'h3')))}>{self.words(1, 8)}</{h}>", 1))
            elif kind < 0.88:
                size = int(self.rng.integers(2, 5))
                items = [f"<li>{self.words(3, 25)}</li>" for _ in range(size)]
                parts += [("<ul>" + items[0], 1), *((i, 1) for i in items[1:-1]), (items[-1] + "</ul>", 1)]
            elif kind < 0.91:
                parts.append((f"<blockquote>{self.prose()}</blockquote>", 1))
            elif kind < 0.93:
                parts.append((f"<div>{self.prose()}</div>", 1))
            elif kind < 0.95:
                parts.append((f"<figure><img src='x'><figcaption>{self.words(3, 15)}</figcaption></figure>", 1))
            else:
                parts += self.rest(self.pick(("advert", "side", "share", "notice", "form", "menu", "comments")))
        return parts

    def rest(self, kind: str) -> list[tuple[str, int]]:
        element = self.pick(REST[kind])
        if kind in ("menu", "share") or kind in ("header", "footer", "side") and self.rng.random() < 0.5:
            size = int(self.rng.integers(1, 9))
            items = [f'<li><a href="/{i}">{self.words(1, 4)}</a></li>' for i in range(size)]
            items[0], items[-1] = "<ul>" + items[0], items[-1] + "</ul>"
        elif kind == "form":
            items = [f"<label>{self.words(1, 3)}</label>", f"<button>{self.words(1, 2)}</button>"]
        elif kind == "comments":
            size = int(self.rng.integers(1, 5))
            wrap = self.pick(("p", "div.comment", "li", "article.comment", "div"))
            items = [self.inside(wrap, self.prose()) for _ in range(size)]
        else:
            size = int(self.rng.integers(1, 4))
            items = [f"<p>{self.words(3, 45)}</p>" for _ in range(size)]
        if kind not in ("menu", "share") and self.rng.random() < 0.35:
            items.insert(0, f"<{(h := self.pick(('h1', 'h2', 'h3', 'h4')))}>{self.words(1, 6)}</{h}>")
        if kind == "footer" and self.rng.random() < 0.7:
            items.append(f"<p>&copy; {self.words(1, 6)}</p>")
        if len(items) == 1 and self.rng.random() < 0.5:
            items = [self.words(3, 30)]
        if element.startswith(("ul", "ol")) and not any(i.startswith("<ul>") for i in items):
            items = [f"<li>{i}</li>" for i in items]
        whole = self.inside(element, "\0".join(items)).split("\0")
        return [(w, 0) for w in whole]

    def page(self) -> tuple[str, list[int]]:
        """HTML and a label per block: 1 for main text."""
        before = [k for k in ("notice", "header", "menu", "advert", "form", "menu", "side") if self.rng.random() < 0.45]
        after = [k for k in ("share", "side", "comments", "advert", "form", "footer", "notice") if self.rng.random() < 0.45]
        if self.rng.random() < 0.3:
            self.rng.shuffle(before)
            self.rng.shuffle(after)
        parts = [p for k in before for p in self.rest(k)]
        body = self.article()
        outer, inner = self.pick(WRAP), self.pick(MAIN)
        whole = self.inside(outer, self.inside(inner, "\0".join(p[0] for p in body))).split("\0")
        parts += [(w, label) for w, (_, label) in zip(whole, body, strict=True)]
        parts += [p for k in after for p in self.rest(k)]
        gap = self.pick(("", "\n", "<script>var a='<p>x</p>';</script>", "<!-- x -->"))
        return f"<html><head><title>{self.words(1, 8)}</title></head><body>{gap.join(p[0] for p in parts)}</body></html>", [
            p[1] for p in parts
        ]
