"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

Each leaf block is main text or not. Its features are the elements and names around it and the shape
of its text; two labels that follow each other add a weight of their own. The weights maximize the
conditional likelihood of labelled pages, by forward-backward; pages are decoded by Viterbi. What stands
around a block tells by its distance: the nearest landmark and the nearest name that means something, those
next to them, and those beyond.

The labelled pages are drawn up here, in many layouts, with a known label for each block; their
number is a parameter. The words play no part beyond their shape, so the model does not depend on a
language.

Defined results: a NULL, empty or text-free page has the empty text; repeated rows give repeated
results; other columns are left alone. Nothing is shuffled.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import pieces_of
from .html_blocks import Block, leaf_blocks

TRAINING_PAGES = 1200
ROUNDS = 300
SEED = 7
PIECE_CHARS = 1 << 20

_ENDING = re.compile(r"[.!?…:;。！？][\"'”’»)\]]*$")
_RIGHTS = re.compile(r"©|\(c\)|copyright|all rights reserved", re.I)


_HOW_FAR = ("near", "next", "far")


def features(block: Block, place: int, number: int) -> list[str]:
    text = block.text
    n_words = text.count(" ") + 1
    share = block.link_chars / len(text)
    out = [
        "any",
        f"tag:{block.tag}",
        f"words:{min(n_words, 80).bit_length()}",
        f"links:{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.8 else 3}",
        f"ending:{bool(_ENDING.search(text))}",
        f"commas:{min(text.count(','), 2)}",
        f"place:{0 if place == 0 else 2 if place == number - 1 else 1}",
        *(f"in:{p}" for p in block.places),
        *(f"{_HOW_FAR[n]}:{mark}" for n, mark in enumerate(block.landmarks)),
        *(f"{_HOW_FAR[n]}-named:{stem}" for n, stems in enumerate(block.named) for stem in stems),
    ]
    if block.landmarks:
        # A heading within an article's header is another thing than one within the page's.
        inner, outer = (*block.landmarks, "")[:2]
        out += [f"{inner}<{outer}", f"{inner}<{outer}:{block.tag}"]
    if _RIGHTS.search(text):
        out += ["rights", f"rights:{block.landmarks[0] if block.landmarks else ''}"]
    return out


# --- labelled pages ----------------------------------------------------------


class _Writer:
    """A page under construction, and the label of each of its blocks."""

    def __init__(self, seed: str) -> None:
        self.random = random.Random(seed)
        self.parts: list[str] = []
        self.labels: list[int] = []
        self.wrapped_whole = self.own_header = False
        letters = self.random.choice(("etaoinshrdlu", "enisratdhulcgm", "éàesaitnrulo", "aeosrnidlctu"))
        self.words = [
            "".join(self.random.choices(letters, k=self.random.randint(2, 11))) for _ in range(80)
        ]

    def pick(self, *options):
        return self.random.choice(options)

    def chance(self, p: float) -> bool:
        return self.random.random() < p

    def prose(self, low: int, high: int) -> str:
        words = self.random.choices(self.words, k=self.random.randint(low, high))
        for i in range(self.random.randint(4, 12), len(words), self.random.randint(5, 14)):
            words[i] += self.pick(",", ".", ".")
        return " ".join(words).capitalize() + ("." if self.chance(0.9) else "")

    def phrase(self, low: int = 1, high: int = 5) -> str:
        return " ".join(self.random.choices(self.words, k=self.random.randint(low, high))).capitalize()

    def block(self, label: int, tag: str, text: str, attributes: str = "") -> None:
        end = "" if tag in ("p", "li") and self.chance(0.1) else f"</{tag}>"
        if self.chance(0.1):
            text = f"<b>{text}</b>"
        if label and tag == "p" and self.chance(0.2):
            text += f' <a href="#">{self.phrase(1, 3)}</a> {self.phrase(2, 8)}.'
        self.parts.append(f"<{tag}{attributes}>{text}{end}")
        self.labels.append(label)

    def named(self, *names: str) -> str:
        return self.pick(f' class="{self.pick(*names)}"', f' id="{self.pick(*names)}"', f' class="x{self.random.randint(0, 99)} {self.pick(*names)}"')

    def wrapped(self, tag: str, attributes: str, body, bare: bool = False) -> None:
        """An element around what body writes. A bare one may hold its text without any element
        between.
        """
        if bare and self.chance(0.35):
            self.block(0, tag, self.pick("", "", "&copy; ") + self.prose(2, 30), attributes)
            return
        self.parts.append(f"<{tag}{attributes}>")
        body()
        self.parts.append(f"</{tag}>")

    # boilerplate

    def links(self, low: int = 2, high: int = 9) -> None:
        def body() -> None:
            for _ in range(self.random.randint(low, high)):
                self.block(0, "li", f'<a href="/x">{self.phrase(1, 6)}</a>')

        self.wrapped("ul", "", body)

    def menu(self) -> None:
        self.wrapped(*self.pick(("nav", ""), ("div", self.named("menu", "nav", "main-nav", "breadcrumbs"))), self.links)

    def header(self) -> None:
        def body() -> None:
            self.block(0, self.pick("div", "h1", "p", "h2"), self.phrase(1, 4))
            if self.chance(0.5):
                self.block(0, "p", self.prose(3, 14))

        self.wrapped(*self.pick(("header", ""), ("div", self.named("header", "masthead", "site-header", "topbar", "kopfzeile"))), body, bare=True)

    def footer(self) -> None:
        def body() -> None:
            if self.chance(0.4):
                self.links()
            self.block(0, self.pick("p", "div"), self.pick("&copy; ", "Copyright 2020 ", "") + self.prose(3, 30))

        self.wrapped(*self.pick(("footer", ""), ("div", self.named("footer", "site-footer", "colophon", "fusszeile"))), body, bare=True)

    def advert(self) -> None:
        text = self.prose(2, 45)
        where = self.named("ad", "ads", "advert", "ad-slot", "advertisement", "sponsored", "promo", "banner", "werbung", "anzeige", "publicidad")
        if self.chance(0.5):
            self.block(0, self.pick("div", "p", "aside"), text, where)
        else:
            self.wrapped("div", where, lambda: self.block(0, "p", text))

    def notice(self) -> None:
        where = self.named("cookie-notice", "notice", "consent", "alert", "gdpr-banner", "popup", "modal", "paywall", "hinweis", "toast")

        def body() -> None:
            self.block(0, "p", self.prose(6, 40))
            if self.chance(0.5):
                self.block(0, "div", f"<button>{self.phrase(1, 2)}</button>")

        self.wrapped(self.pick("div", "section", "aside"), where, body, bare=True)

    def side(self) -> None:
        def body() -> None:
            self.block(0, self.pick("h3", "h2", "h4"), self.phrase(1, 4))
            if self.chance(0.6):
                self.links()
            if self.chance(0.6):
                self.block(0, "p", self.prose(5, 50))

        self.wrapped(*self.pick(("aside", ""), ("div", self.named("sidebar", "side", "right-rail", "widget-area", "sidebar-left"))), body, bare=True)

    def form(self) -> None:
        def body() -> None:
            self.block(0, self.pick("p", "div", "h3"), self.prose(2, 20))
            label = f"<label>{self.phrase(1, 3)}</label>" if self.chance(0.5) else ""
            asked = f'{label}<input type="text"><textarea>x</textarea><button>{self.phrase(1, 2)}</button>'
            self.block(0, self.pick("div", "fieldset"), asked)

        names = self.named("newsletter", "subscribe", "login-form", "search", "signup")
        self.wrapped(*self.pick(("form", ""), ("form", names), ("div", names)), body, bare=True)

    def comments(self) -> None:
        where = self.named("comments", "comment-list", "disqus_thread", "responses", "replies", "discussion", "kommentare", "comentarios")
        tag = self.pick("div", "section", "ol")

        def body() -> None:
            if self.chance(0.6):
                self.block(0, self.pick("h2", "h3", "h4"), self.phrase(1, 3))
            for _ in range(self.random.randint(1, 7)):
                inner = self.pick("", ' class="comment"', ' class="comment-body"')
                self.wrapped(
                    "li" if tag == "ol" else self.pick("div", "article"),
                    inner,
                    lambda: [
                        self.chance(0.4) and self.block(0, "div", self.phrase(1, 2)),
                        self.block(0, "p", self.prose(3, 80)),
                    ],
                )

        self.wrapped(tag, where, body)

    def more(self) -> None:
        where = self.named("related", "share", "social", "recommended", "trending", "tags")
        self.wrapped(self.pick("div", "section", "aside"), where, self.links)

    # main text

    def story(self) -> None:
        if self.wrapped_whole or self.chance(0.9):
            title = "h1" if self.wrapped_whole else self.pick("h1", "h1", "h1", "h2")
            if self.own_header and self.chance(0.4):
                # The article's own header.
                self.wrapped("header", self.pick("", "", self.named("entry-header", "post-header")), lambda: self.block(1, title, self.phrase(2, 14)))
            else:
                self.block(1, title, self.phrase(2, 14))
        for _ in range(self.random.randint(1, 9)):
            kind = self.random.random()
            if kind < 0.03:
                # Text that is quoted with its licence.
                self.block(1, "p", self.pick("All rights reserved.", f"Copyright {self.phrase()}", f"&copy; {self.prose(3, 20)}"))
            elif kind < 0.58:
                self.block(1, "p", self.prose(*self.pick((1, 8), (8, 40), (30, 160))))
            elif kind < 0.66:
                self.block(1, self.pick("h2", "h3"), self.phrase(1, 8))
            elif kind < 0.72:
                self.wrapped(self.pick("ul", "ol"), "", lambda: [self.block(1, "li", self.prose(1, 20)) for _ in range(self.random.randint(2, 5))])
            elif kind < 0.76:
                self.wrapped("blockquote", "", lambda: self.block(1, "p", self.prose(5, 50)))
            elif kind < 0.79:
                self.block(1, self.pick("pre", "div"), self.prose(4, 40))
            else:
                self.pick(self.advert, self.advert, self.advert, self.side, self.more, self.form, self.notice, self.notice, self.links, self.comments)()
                # The text goes on, sometimes with a few words only.
                self.block(1, "p", self.prose(*self.pick((1, 6), (2, 12), (20, 60))))

    def inside(self, depth: int, body) -> None:
        """Some elements without a meaning of their own around what body writes."""
        if not depth:
            return body()
        self.wrapped("div", self.pick("", ' class="row"', ' class="col-8 x"', ' id="w1"', ' class="inner"'), lambda: self.inside(depth - 1, body))

    #: Names on what holds the whole page, which speak of its parts.
    SPEAKING = ("comments-open", "no-sidebar", "has-ads", "header-fixed", "with-sidebar", "no-comments", "has-cookie-notice", "single-post", "menu-open", "search-enabled")

    def about(self) -> str:
        return f' class="{" ".join(self.random.sample(self.SPEAKING, self.random.randint(1, 3)))}"'

    def page(self) -> None:
        before = [self.header, self.menu, self.notice, self.advert, self.side, self.form]
        after = [self.comments, self.side, self.more, self.form, self.advert, self.footer, self.notice]
        for part in self.random.sample(before, self.random.randint(0, 4)):
            self.inside(self.random.randint(0, 2), part)
        container = self.pick(
            ("article", ""),
            ("main", ""),
            ("article", self.named("post", "story", "entry", "artikel")),
            ("div", self.named("content", "article", "post-body", "entry-content", "main", "story", "inhalt")),
            ("section", self.named("article-body", "content", "text")),
            ("div", ""),
            ("td", ""),
            None,
        )
        outer = self.pick(None, None, ("main", ""), ("section", ""), ("div", self.named("content", "main", "site-content")))
        self.own_header = bool(container) and container[0] in ("article", "main")
        last = [self.comments, self.more, self.advert, None, None, None, None]

        def whole() -> None:
            self.inside(self.random.randint(0, 2), self.story)
            part = self.pick(*last)
            if part and container:
                part()

        if container and self.chance(0.08):
            # Lines of text without elements of their own.
            lines = self.pick("<br>", "<br><br>").join(self.prose(8, 60) for _ in range(self.random.randint(1, 5)))
            self.block(1, container[0], lines, container[1])
        elif container and outer:
            self.wrapped(*outer, lambda: self.wrapped(*container, whole))
        elif container:
            self.wrapped(*container, whole)
        else:
            whole()
        for part in self.random.sample(after, self.random.randint(0, 5)):
            self.inside(self.random.randint(0, 2), part)

    def write(self) -> tuple[str, list[int]]:
        body = self.about() if self.chance(0.5) else ""
        self.parts.append(f"<!DOCTYPE html><html><head><title>x</title><style>p{{}}</style></head><body{body}>")
        around = self.random.random()
        self.wrapped_whole = around < 0.4
        if around < 0.15:
            self.wrapped("form", self.pick("", ' id="aspnetForm"'), self.page)
        elif around < 0.4:
            self.wrapped("div", self.about(), self.page)
        else:
            self.page()
        self.parts.append("<script>x()</script></body></html>" if self.chance(0.8) else "")
        return "".join(self.parts), self.labels


def labelled_pages(number: int, seed: int = SEED) -> list[tuple[str, list[int]]]:
    """Pages in many layouts, with the label of each leaf block."""
    return [_Writer(f"{seed}:{i}").write() for i in range(number)]


# --- the field ---------------------------------------------------------------


class Field:
    """Weights of a trained field: of (feature, main text or not), and of a label after a label."""

    def __init__(self, weights: dict[str, float], steps: np.ndarray, start: np.ndarray) -> None:
        self.weights = weights
        (self.stay0, self.enter), (self.leave, self.stay1) = steps.tolist()
        self.start0, self.start1 = start.tolist()

    def decode(self, blocks: list[Block]) -> list[int]:
        """The most likely labels (Viterbi)."""
        if not blocks:
            return []
        get, n = self.weights.get, len(blocks)
        back: list[tuple[int, int]] = []
        zero, one = self.start0, self.start1
        for i, block in enumerate(blocks):
            if i:
                from0, from1 = (zero + self.stay0, one + self.leave), (zero + self.enter, one + self.stay1)
                back.append((int(from0[1] > from0[0]), int(from1[1] > from1[0])))
                zero, one = max(from0), max(from1)
            one += sum(get(f, 0.0) for f in features(block, i, n))
        label = int(one > zero)
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]


class Problem:
    """The conditional log-likelihood of labelled chains, and its gradient, for all chains side by side.

    The weights are those of the features, the four steps (from * 2 + to) and the two starts.
    """

    def __init__(self, chains: list[tuple[list[list[str]], list[int]]]) -> None:
        # The longest first, so that those that reach a place are the first so many.
        chains = sorted(chains, key=lambda chain: -len(chain[1]))
        self.numbers: dict[str, int] = {}
        self.longest = max(len(labels) for _, labels in chains)
        shape = self.shape = (len(chains), self.longest)
        self.there, self.gold = np.zeros(shape, bool), np.zeros(shape, np.int64)
        cells, which = [], []
        for c, (found, labels) in enumerate(chains):
            self.there[c, : len(labels)] = True
            self.gold[c, : len(labels)] = labels
            for i, names in enumerate(found):
                cells += [c * self.longest + i] * len(names)
                which += [self.numbers.setdefault(f, len(self.numbers)) for f in names]
        self.cells, self.which = np.array(cells), np.array(which)
        self.size = len(self.numbers) + 6
        self.blocks = int(self.there.sum())
        self.lengths = self.there.sum(1)
        self.reach = self.there.sum(0).tolist()
        self.later = np.nonzero(self.there[:, 1:])
        steps = self.gold[:, :-1] * 2 + self.gold[:, 1:]
        self.steps = np.bincount(steps[self.there[:, 1:]], minlength=4)
        self.starts = np.bincount(self.gold[:, 0], minlength=2)

    def value_and_gradient(self, weights: np.ndarray) -> tuple[float, np.ndarray]:
        n = len(self.numbers)
        steps, start = weights[n : n + 4].reshape(2, 2), weights[-2:]
        score = np.zeros((*self.shape, 2))
        held = np.bincount(self.cells, weights[self.which], minlength=self.there.size)
        score[..., 1] = held.reshape(self.shape)
        forward, backward = np.zeros((*self.shape, 2)), np.zeros((*self.shape, 2))
        forward[:, 0] = score[:, 0] + start
        for i in range(1, self.longest):
            k = self.reach[i]
            forward[:k, i] = np.logaddexp.reduce(forward[:k, i - 1, :, None] + steps, axis=1) + score[:k, i]
        for i in range(self.longest - 1, 0, -1):
            k = self.reach[i]
            behind = score[:k, i] + backward[:k, i]
            backward[:k, i - 1] = np.logaddexp.reduce(steps + behind[:, None, :], axis=2)
        total = np.logaddexp.reduce(forward[np.arange(self.shape[0]), self.lengths - 1], axis=1)
        marginal = np.exp(forward + backward - total[:, None, None])
        c, i = self.later
        behind = score[c, i + 1] + backward[c, i + 1] - total[c, None]
        pair = np.exp(forward[c, i][:, :, None] + steps + behind[:, None, :])
        gradient = np.zeros(self.size)
        surprise = np.where(self.there, self.gold - marginal[..., 1], 0.0).reshape(-1)
        gradient[:n] = np.bincount(self.which, surprise[self.cells], minlength=n)
        gradient[n : n + 4] = self.steps - pair.sum(0).reshape(-1)
        gradient[-2:] = self.starts - marginal[:, 0].sum(0)
        reached = (score[..., 1] * self.gold)[self.there].sum()
        reached += (self.steps * steps.reshape(-1)).sum() + (self.starts * start).sum()
        return float(reached - total.sum()), gradient


def train(pages: list[tuple[str, list[int]]], rounds: int = ROUNDS, penalty: float = 1e-4) -> Field:
    """Fit by gradient ascent (Adam) on the conditional log-likelihood."""
    chains = []
    for page, labels in pages:
        blocks = leaf_blocks(page)
        if len(blocks) != len(labels):
            raise ValueError("a labelled page has another number of blocks than labels")
        if blocks:
            chains.append(([features(b, i, len(blocks)) for i, b in enumerate(blocks)], labels))
    problem = Problem(chains)
    weights = np.zeros(problem.size)
    m = np.zeros_like(weights)
    v = np.zeros_like(weights)
    for t in range(1, rounds + 1):
        gradient = problem.value_and_gradient(weights)[1] / problem.blocks - penalty * weights
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        weights = weights + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    n = len(problem.numbers)
    named = {f: float(weights[i]) for f, i in problem.numbers.items()}
    return Field(named, weights[n : n + 4].reshape(2, 2), weights[-2:])


@lru_cache(maxsize=4)
def trained(number: int = TRAINING_PAGES, seed: int = SEED) -> Field:
    return train(labelled_pages(number, seed))


def main_text(page: str | None, field: Field) -> tuple[str, int, int]:
    """The main text, its number of blocks, and that of all blocks."""
    blocks = leaf_blocks(page or "")
    kept = [b.text for b, label in zip(blocks, field.decode(blocks)) if label]
    return "\n".join(kept), len(kept), len(blocks)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page, and the numbers of its blocks."""
    field = field or trained()
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    schema = T.StructType(
        [
            rows.schema["page_id"],
            rows.schema["url"],
            *T.StructType()
            .add("text", "string")
            .add("n_chars", "long")
            .add("n_main_blocks", "long")
            .add("n_blocks", "long"),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces_of(batches, "html", PIECE_CHARS):
            found = [main_text(page, field) for page in piece.column("html").to_pylist()]
            columns = [
                pa.array([t for t, _, _ in found], pa.string()),
                *(pa.array(c, pa.int64()) for c in zip(*((len(t), k, n) for t, k, n in found))),
            ]
            yield pa.RecordBatch.from_arrays(
                [piece.column("page_id"), piece.column("url"), *columns], schema=arrow
            )

    return rows.mapInArrow(run, schema)
