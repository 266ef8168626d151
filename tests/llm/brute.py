"""Plain versions of the corpus operators, to hold the queries against."""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np

from shelflake.llm import secrets


class Classes:
    """Union-find."""

    def __init__(self, items) -> None:
        self.up = {i: i for i in items}

    def top(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, a, b) -> None:
        self.up[self.top(a)] = self.top(b)


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def near_lines(lines: list[str], edits: int) -> list[tuple[str, str]]:
    """Pairs of different lines within an edit for every ten characters of the shorter, at most so many; bags of
    characters rule most pairs out.
    """
    bags = {line: Counter(line) for line in lines}
    by_length = defaultdict(list)
    for line in lines:
        by_length[len(line)].append(line)
    return [
        (a, b)
        for n in sorted(by_length)
        for allowed in [min(edits, n // 10)]
        if allowed
        for a in by_length[n]
        for more in range(allowed + 1)
        for b in by_length.get(n + more, ())
        if (more or a < b)
        and sum((bags[a] - bags[b]).values()) <= allowed
        and edit_distance(a, b) <= allowed
    ]


def line_report(docs: list[tuple[int, str]], edits: int = 2) -> dict:
    """(doc_id, line_no) -> (class_doc_id, class_line_no, n_links, kept)."""
    rows = [(i, k, line) for i, text in docs for k, line in enumerate((text or "").split("\n"))]
    first = {}
    for i, k, line in rows:
        if line.strip(" \t\n\v\f\r"):
            first[line] = min(first.get(line, (i, k)), (i, k))
    classes, degree = Classes(first), Counter()
    for a, b in near_lines(list(first), edits):
        classes.join(a, b)
        degree.update((a, b))
    of_class = {}
    for line, place in first.items():
        top = classes.top(line)
        of_class[top] = min(of_class.get(top, place), place)
    out = {}
    for i, k, line in rows:
        place = of_class[classes.top(line)] if line in first else (i, k)
        out[i, k] = (*place, degree[line], place == (i, k) or len(line) < 20)
    return out


def without_lines(docs: list[tuple[int, str]]) -> list[tuple[int, str]]:
    kept = line_report(docs)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        left = [line for k, line in enumerate(lines) if kept[i, k][3]]
        whole = "\n".join(left)
        if len(left) == len(lines) or (whole.strip(" \t\n\v\f\r") and 10 * len(whole) >= len(text)):
            out.append((i, whole))
    return out


def shingles(text: str | None) -> Counter:
    words = re.findall(r"[^ \t\n\v\f\r]+", text or "")
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def probability_jaccard(a: Counter, b: Counter) -> float:
    u, v = ({k: 1 + math.log(n) for k, n in c.items()} for c in (a, b))
    every = set(u) | set(v)
    return sum(
        1 / sum(max(u.get(k, 0) / u[i], v.get(k, 0) / v[i]) for k in every) for i in set(u) & set(v)
    )


def near_classes(docs: list[tuple[int, str]], threshold: float = 0.8) -> dict[int, int]:
    """doc_id -> least doc_id of its class, by all pairs that share a shingle."""
    found = {i: shingles(t) for i, t in docs}
    holders = defaultdict(list)
    for i, s in found.items():
        for shingle in s:
            holders[shingle].append(i)
    pairs = {(a, b) for h in holders.values() for n, a in enumerate(h) for b in h[n + 1 :]}
    classes = Classes(found)
    for a, b in pairs:
        # No more than the share of common shingles can come of it, up to the weights of repeats.
        common = len(found[a].keys() & found[b].keys())
        if common * 2 > max(len(found[a]), len(found[b])):
            if probability_jaccard(found[a], found[b]) >= threshold - 1e-9:
                classes.join(a, b)
    least = {}
    for i in found:
        least[classes.top(i)] = min(least.get(classes.top(i), i), i)
    return {i: least[classes.top(i)] for i in found}


def lowered_words(text: str | None) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def contamination(docs, items, window: int = 10) -> list[tuple]:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each document."""
    windows = defaultdict(set)
    for item, text in items:
        words = lowered_words(text)
        for p in range(max(1, len(words) - window + 1)):
            if words and item is not None:
                windows[tuple(words[p : p + window])].add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for i, text in docs:
        words, hit, found = lowered_words(text), set(), set()
        for n in lengths:
            for p in range(len(words) - n + 1):
                if tuple(words[p : p + n]) in windows:
                    hit.update(range(p, p + n))
                    found |= windows[tuple(words[p : p + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(found), digest, bool(hit)))
    return out


ASSIGN = re.compile(
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
    r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def suspect_runs(run: str) -> list[tuple[int, str]]:
    """(place, run) of what is left of a run without the pieces that a harmless string stands in."""
    if not re.search("[0-9]", run):
        return []
    # The allow list is searched in the whole run, and takes every piece that a match of it touches.
    harmless = re.compile(rf"(?<![^/_=-])[^/_=-]*(?:{{}})[^/_=-]*".format(secrets.ALLOWED.removeprefix("(?i)")), re.I)
    left, at = [], 0
    for m in [*harmless.finditer(run), None]:
        end = m.start() if m else len(run)
        left.append((at, run[at:end]))
        at = m.end() if m else end
    return [(at, r) for at, r in left if len(r) >= 20 and re.search("[0-9]", r)]


def secret_spans(text: str | None) -> tuple[list, list]:
    """Spans found by form, and all spans: (start, rank, end)."""
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    hot, w = [], secrets.WINDOW
    for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text):
        for at, run in suspect_runs(m[0]):
            bits = next(c[2] for c in secrets.CLASSES if re.search(c[1], run))
            places = [
                k
                for k in range(len(run) - w + 1)
                if -sum(n / w * math.log2(n / w) for n in Counter(run[k : k + w]).values()) >= bits - 1e-6
            ]
            if places:
                start, end = m.start() + at + places[0], m.start() + at + places[-1] + w
                told = {p for b in base for p in range(b[0], b[2])}
                if not told.issuperset(range(start, end)):
                    hot.append((start, 3, end))
    return sorted(base), sorted(base + hot)


def spans_text(spans) -> str:
    return ",".join(f"{secrets.KINDS[rank]}:{start}:{end}" for start, rank, end in spans)


def rule_measures(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    triples = Counter(zip(words, words[1:], words[2:]))
    inside = {
        j for i in range(len(words) - 2) if triples[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)
    }
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(line in lines[:n] for n, line in enumerate(lines)),
        len(inside),
    )


def archive_rows(pages: list[tuple]) -> list[tuple]:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each page."""
    least = {}
    payloads = [(i, (html or "").encode()) for i, html in pages]
    for i, p in payloads:
        if i is not None:
            least[p] = min(least.get(p, i), i)
    often = Counter(p for _, p in payloads)
    out = []
    for i, p in payloads:
        revisit = often[p] > 1 and i != least.get(p)
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), digest, "revisit" if revisit else "response", least[p] if revisit else None))
    return out


def chats(rows: list[tuple]) -> dict:
    """conv_id -> text of the conversations that stay."""
    turns = defaultdict(set)
    for conv, turn, role, text in rows:
        turns[conv].add((turn, role, text))
    whole = {c: tuple((r, t) for _, r, t in sorted(v)) for c, v in turns.items()}
    inner = {w[:k] for w in whole.values() for k in range(1, len(w))}
    stays = {}
    for c, w in whole.items():
        if w not in inner:
            stays[w] = min(stays.get(w, c), c)
    return {c: "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in w) for w, c in stays.items()}


def check_packing(rows, texts: dict[int, str], encode, capacity: int = 1024) -> int:
    """Holds the pieces of all documents against their tokens; gives the number of sequences."""
    import zlib

    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_document[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_document) == set(texts)
    for i, pieces in by_document.items():
        ids = np.array([*encode(texts[i] or ""), 2], "<u4")
        pieces.sort(key=lambda r: r["piece"])
        at = 0
        for n, r in enumerate(pieces):
            assert (r["piece"], r["start"]) == (n, at)
            assert r["length"] <= capacity if n == 0 else r["length"] == capacity
            assert len(ids) > capacity or len(pieces) == 1
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def fill_in_middle(docs: list[tuple]) -> list[tuple]:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of each document."""
    out = []
    for i, text in docs:
        text = text or ""
        units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
        digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in range(0, 32, 8))
        a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
        if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
            out.append((i, len(units), "plain", None, None, text))
        elif h4 % 100 < 20:
            out.append((i, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"))
        else:
            out.append((i, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"))
    return out


def whitened(rows: list[tuple], components: int = 16) -> tuple:
    """Per row (vec_id, deviation, whitened), the share of each component, and n, by eigh."""
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in usable]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    off = [[n * a - s for a, s in zip(v, sums)] for v in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    share = values / values.sum()
    white = np.array(off, float) / n @ vectors[:, :components] / np.sqrt(values[:components])
    return (
        [(i, sum(a * a for a in o), w) for (i, _), o, w in zip(usable, off, white)],
        share[:components],
        n,
    )
