"""HTML pages as sequences of text blocks with the path of elements above them.

A block is the text between two tags of block elements; inline tags leave it in one piece and
line breaks are white space. Character references are decoded, white space is one space. Scripts,
styles and other raw text give none, up to the end of the page where their end tag is missing.
Templates and ``noscript`` give none if they are closed; where no end tag follows, the page goes on
after the start tag. Formulas, drawings and what embedded media hold are text of the block they
stand in. Open elements are closed where the end tag is missing, as far as paths need it.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>",
    re.S,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
PARTS = re.compile(r"[a-z]+")
RAW = frozenset("script style textarea title iframe".split())
HIDDEN = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in (*RAW, "template", "noscript")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option "
    "p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that end an open one of the given names, unless one of the barriers lies between.
IMPLIED = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "optgroup": ("option", "optgroup"),
}
BARRIER = frozenset("ul ol menu dl table select article section div nav aside body".split())


@dataclass
class Block:
    """Text, the names on its path from the root, and the characters of it that are links."""

    text: str
    path: tuple[tuple[str, ...], ...]
    linked: int


def names_of(tag: str, attributes: str) -> tuple[str, ...]:
    """The element's name, then the letters in its class, id and role as ``.word``."""
    if "=" not in attributes:
        return (tag,)
    found = " ".join("".join(m) for m in NAMES.findall(attributes)).lower()
    return (tag, *dict.fromkeys("." + part for part in PARTS.findall(found)))


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    found: list[Block] = []
    path: list[tuple[str, ...]] = []
    texts: list[str] = []
    links: list[int] = []
    endless: set[str] = set()  # hidden elements of which no end tag follows
    in_link, at = False, 0

    def close_block() -> None:
        nonlocal in_link
        if texts:
            text = " ".join(html.unescape("".join(texts)).split())
            if text:
                found.append(Block(text, tuple(path), min(sum(links), len(text))))
            texts.clear()
            links.clear()
        in_link = False

    def close(names: tuple[str, ...]) -> None:
        for i in range(len(path) - 1, -1, -1):
            if path[i][0] in names:
                del path[i:]
                return
            if path[i][0] in BARRIER:
                return

    for match in iter(lambda: TAG.search(page, at), None):
        start, end = match.span()
        if start > at:
            texts.append(page[at:start])
            if in_link:
                links.append(start - at)
        at = end
        if match[2] is None:
            continue
        tag = match[2].lower()
        if match[1]:
            if tag in BLOCK:
                close_block()
                for i in range(len(path) - 1, -1, -1):
                    if path[i][0] == tag:
                        del path[i:]
                        break
            elif tag == "a":
                in_link = False
        elif tag in HIDDEN:
            if tag not in endless and (not match[3].endswith("/") or tag in ("script", "style")):
                ending = HIDDEN[tag].search(page, at)
                if ending:
                    at = ending.start()
                elif tag in RAW:
                    at = len(page)
                else:
                    endless.add(tag)
        elif tag in BLOCK:
            close_block()
            if tag not in VOID:
                if path and path[-1][0] == "p":
                    path.pop()
                if tag in IMPLIED:
                    close(IMPLIED[tag])
                path.append(names_of(tag, match[3]))
        elif tag == "br":
            texts.append(" ")
        elif tag == "a":
            in_link = True
    if at < len(page):
        texts.append(page[at:])
    close_block()
    return found
