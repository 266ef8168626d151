"""Leaf blocks of a page: the runs of text between block boundaries, with what stands around them.

Tolerant of markup as it is found: unclosed and misnested elements, stray end tags, tags cut off at
the end of the page, elements nobody knows (they are taken as part of the running text).

Around a block stand its landmarks (article, nav, form and the like) and the names of classes and ids that
mean something, both from the nearest outwards. An element that holds the page's heading and more than half
of its text is the page and tells nothing about a block; neither does a form of that size, html or body.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from functools import lru_cache

# --- fixed values: names of HTML elements ---------------------------------------
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Their inside is text up to their end tag and never shown as part of the page.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
#: Their inside is markup that is not shown, or not as text of the page.
UNSHOWN = frozenset("select svg template object noscript audio video canvas datalist head".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup "
    "option p plaintext pre search section summary table tbody td tfoot th thead tr ul".split()
)
# --- end of the fixed values ------------------------------------------------------

LANDMARKS = frozenset("article aside details dialog fieldset footer form header main nav search section".split())
#: Elements that a block may stand in, whatever stands between.
PLACES = frozenset("blockquote dl figure li menu ol pre table ul".split())

#: What names of classes and ids are made of: parts of them that begin so, or are so where a $ follows.
STEMS = {
    "advert": ("ad$", "ads$", "adver", "sponsor", "promo", "banner", "dfp", "werb", "anzeige", "publicid", "publicit"),
    "comment": ("comment", "disqus", "respond", "repl", "discuss", "feedback", "komment", "comentari", "reacti"),
    "menu": ("menu", "nav", "breadcrumb", "pagination", "pager", "tabs", "toolbar"),
    "head": ("header", "masthead", "topbar", "logo", "brand", "kopf"),
    "foot": ("footer", "foot", "copyright", "colophon", "legal", "fuss", "pied"),
    "side": ("sidebar", "aside", "rail", "widget", "seitenleiste", "barra"),
    "notice": ("cookie", "notice", "consent", "gdpr", "alert", "popup", "modal", "overlay", "toast", "paywall", "hinweis"),
    "form": ("form", "signup", "subscri", "newsletter", "login", "search"),
    "more": ("related", "recommend", "share", "social", "trending", "popular", "teaser", "tags", "author", "byline"),
    "main": ("content", "article", "main", "post", "entry", "story", "body", "text", "artikel", "inhalt"),
}

#: A new element of a kind ends an open one of the same kind, but not beyond its container.
_SIBLINGS = {
    "li": ("ul", "ol", "menu"),
    "dt": ("dl",),
    "dd": ("dl",),
    "tr": ("table",),
    "td": ("tr", "table"),
    "th": ("tr", "table"),
    "option": ("select",),
}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?>[^>\"']+|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?P<close>>|\Z)",
    re.DOTALL,
)
_NAMES = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[a-z]+")

#: Of the landmarks and names around a block so many tell, the nearest.
_NEAREST = 3


@dataclass(slots=True)
class Block:
    tag: str
    text: str
    link_chars: int
    places: frozenset[str]
    landmarks: tuple[str, ...]
    named: tuple[tuple[str, ...], ...]


class _Open:
    """An element that is open, and what stands around its inside."""

    __slots__ = ("chars", "heading", "landmarks", "named", "places", "tag")

    def __init__(self, tag: str, stems: tuple[str, ...], outer: _Open | None) -> None:
        self.tag, self.chars, self.heading = tag, 0, tag in ("h1", "main")
        self.landmarks: tuple[_Open, ...] = outer.landmarks if outer else ()
        self.named: tuple[tuple[tuple[str, ...], _Open], ...] = outer.named if outer else ()
        self.places: frozenset[str] = outer.places if outer else frozenset()
        if tag in LANDMARKS:
            self.landmarks = (self, *self.landmarks)[: _NEAREST + 1]
        if stems and tag not in ("html", "body"):
            self.named = ((stems, self), *self.named)[: _NEAREST + 1]
        if tag in PLACES:
            self.places |= {tag}


@lru_cache(maxsize=50_000)
def _stems(rest: str) -> tuple[str, ...]:
    """What the names in a start tag mean."""
    parts = {p for _, *values in _NAMES.findall(rest) for p in _PART.findall("".join(values).lower())}
    return tuple(
        stem
        for stem, beginnings in STEMS.items()
        if any(f"{p}$".startswith(b) for p in parts for b in beginnings)
    )


def leaf_blocks(page: str) -> list[Block]:
    """The blocks in page order. Markup, scripts, styles, titles and comments of the markup have
    none.
    """
    found_blocks: list[tuple[_Open, str, str, int]] = []
    root = _Open("", (), None)
    stack = [root]
    text: list[str] = []
    links = link_chars = unshown = 0

    def flush() -> None:
        nonlocal link_chars
        if text:
            words = " ".join("".join(text).split())
            if words:
                owner = next((o.tag for o in reversed(stack) if o.tag in BLOCKS), "")
                found_blocks.append((stack[-1], owner, words, min(link_chars, len(words))))
                stack[-1].chars += len(words)
            text.clear()
        link_chars = 0

    def leave(count: int) -> None:
        """Leave elements; what they hold counts for those around them."""
        nonlocal links, unshown
        for _ in range(count):
            o = stack.pop()
            links -= o.tag == "a"
            unshown -= o.tag in UNSHOWN
            stack[-1].chars += o.chars
            stack[-1].heading |= o.heading

    def close(tag: str, within: tuple[str, ...] = ()) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == tag:
                leave(len(stack) - i)
                return
            if stack[i].tag in within:
                return

    place = 0
    size = len(page)
    while place < size:
        found = _MARKUP.search(page, place)
        stop = found.start() if found else size
        if stop > place and not unshown:
            chunk = html.unescape(page[place:stop])
            text.append(chunk)
            if links:
                link_chars += len(chunk.strip())
        if not found:
            break
        place = found.end()
        tag = found["tag"] or found["tag2"]
        if tag is None or found["close"] == "":
            continue
        tag = tag.lower()
        rest = found["rest"] or found["rest2"] or ""
        if found["end"] or found["end2"]:
            if tag in BLOCKS:
                flush()
                close(tag)
            else:
                close(tag, ("p", "li", "td", "div"))
            continue
        if tag in RAW:
            if not rest.endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, place)
                place = end.end() if end else size
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            if unshown and tag not in ("option", "optgroup"):
                # Text blocks stand in no list of options, and end a drawing; a head ends where text begins.
                for open_ in ("select", "svg", "head", "datalist"):
                    close(open_, tuple(UNSHOWN - {open_}))
            close("p", ("div", "td", "li", "article", "section", "blockquote", "main", "body", "template", "object"))
            if tag in _SIBLINGS:
                close(tag, _SIBLINGS[tag])
        if tag in VOID:
            continue
        links += tag == "a"
        unshown += tag in UNSHOWN
        if not (rest.endswith("/") and (unshown or tag == "svg")):
            stack.append(_Open(tag, _stems(rest) if "=" in rest else (), stack[-1]))
        else:
            unshown -= tag in UNSHOWN
            links -= tag == "a"
    flush()
    leave(len(stack) - 1)

    def tells(o: _Open) -> bool:
        whole = (o.heading or o.tag == "form") and 2 * o.chars > root.chars
        return not whole or o.tag in ("article", "main")

    return [
        Block(
            tag,
            words,
            linked,
            o.places,
            tuple(mark.tag for mark in o.landmarks if tells(mark))[:_NEAREST],
            tuple(stems for stems, owner in o.named if tells(owner))[:_NEAREST],
        )
        for o, tag, words, linked in found_blocks
    ]
