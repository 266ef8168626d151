"""Secret scans in DataFrame expressions only.

Three kinds are found by their form: assignments, access key ids and hexadecimal runs. The fourth is
found by disorder: a window slides over each candidate string, the counts of its characters are kept
up as one character enters and one leaves, and the Shannon entropy that follows from them is held
against the threshold of the string's character class. Known harmless strings are suppressed,
but only the pieces of a string (parted by / _ = -) that they stand in.

Positions are code points, ends exclusive. Defined results: a NULL text is empty; repeated rows give
repeated results; other columns are left alone. Nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: the kinds found by form -------------------------------------
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"(AKIA[A-Z0-9]+)()"
HEX = r"([0-9a-f]{24,})()"
KINDS = ("assign", "access", "hex", "entropy")
# --- end of the fixed values ---------------------------------------------------

#: What a text must hold for the search to be worth its while. Each is implied by a span of its kind.
HINTS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}",
    "entropy": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20}",
}

#: Runs of 20 or more that hold a digit; shorter ones are too short for their entropy to mean much. A run is
#: looked through for its digit once, from where it begins.
CANDIDATE = r"((?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,})()"
WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

#: Character classes, tried in order, with the bits a character that a window must reach.
CLASSES = (
    ("digits", r"^[0-9=_/+-]+$", 99.0),
    ("hex", r"^[0-9a-fA-F-]+$", 3.0),
    ("letters", r"^(?:[a-z0-9_/=-]+|[A-Z0-9_/=-]+)$", 3.9),
    ("base64", r"", 3.9),
)

#: Harmless strings: placeholders, UUIDs, runs in order.
ALLOWED = (
    r"(?i)example|sample|dummy|placeholder|change_?me|your[_-]|x{6}|0123456789|abcdefgh"
    r"|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
)


@dataclass(frozen=True)
class Settings:
    window: int = WINDOW
    classes: tuple[tuple[str, str, float], ...] = CLASSES
    allowed: str = ALLOWED


_BLOCK = 64
_PARTING = "/_=-"


def _harmless(settings: Settings) -> str:
    """The pieces of a run, as parted by _PARTING, that a harmless string stands in."""
    return rf"(?<![^{_PARTING}])[^{_PARTING}]*(?:{settings.allowed})[^{_PARTING}]*"


def _suspect(s: Column, settings: Settings) -> Column:
    """What is left of a candidate without its harmless pieces: (start, rank, value) of each run."""
    harmless = F.lit(_harmless(settings))
    runs = F.split(s["value"], harmless, -1)
    cut = F.regexp_extract_all(s["value"], harmless, F.lit(0))

    def placed(run: Column, i: Column) -> Column:
        before = F.aggregate(
            F.concat(F.slice(runs, F.lit(1), i), F.slice(cut, F.lit(1), i)),
            s["start"],
            lambda total, part: total + F.char_length(part),
        )
        found = F.struct(before.alias("start"), s["rank"].alias("rank"), run.alias("value"))
        return F.when(F.rlike(run, F.lit(HINTS["entropy"])), found)

    whole = F.array(F.struct(s["start"], s["rank"], s["value"]))
    left = F.array_compact(F.transform(runs, placed))
    return F.when(F.rlike(s["value"], F.lit(settings.allowed)), left).otherwise(whole)


def _pieces(kind: str, pattern: str) -> Column:
    r"""All matches in order: gap (characters since the last match), len, value, inner (length of
    group 2).

    \G ties each search to the end of the last, so that a text is walked through once.
    """
    text, tied = F.col("text"), F.lit(rf"\G(?s:(.*?)){pattern}")
    groups = (F.regexp_extract_all(text, tied, F.lit(n)) for n in (1, 2, 3))
    found = F.transform(
        F.arrays_zip(*(g.alias(n) for g, n in zip(groups, ("gap", "value", "inner")))),
        lambda p: F.struct(
            F.char_length(p["gap"]).alias("gap"),
            F.char_length(p["value"]).alias("len"),
            p["value"].alias("value"),
            F.char_length(p["inner"]).alias("inner"),
        ),
    )
    return F.when(F.rlike(text, F.lit(HINTS[kind])), found)


def _total(pieces: Column) -> Column:
    return F.aggregate(pieces, F.lit(0), lambda total, p: total + p["gap"] + p["len"])


def _before(parts: Column, total: Callable[[Column], Column], sums: list[Column], i: Column) -> Column:
    """The sum of the first i parts: of whole blocks, of whole blocks of blocks, and of the rest."""
    if not sums:
        return total(F.slice(parts, F.lit(1), i))
    block = F.floor(i / _BLOCK).cast("int")
    rest = total(F.slice(parts, block * _BLOCK + 1, i % _BLOCK))
    return _before(sums[0], _sum, sums[1:], block) + rest


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda total, n: total + n)


def _spans(kind: str, holds: Callable[[Column], Column]) -> Column:
    """The pieces with their places, those that hold only. Needs the sums of _block_sums.

    A place is the sum of all lengths before it.
    """
    pieces, sums = F.col(kind), [F.col(f"{kind}_sums"), F.col(f"{kind}_sums2")]

    def placed(p: Column, i: Column) -> Column:
        return F.transform(F.array(_before(pieces, _total, sums, i)), lambda before: span(p, before))[0]

    def span(p: Column, before: Column) -> Column:
        return F.struct(
            (before + p["gap"]).alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            (before + p["gap"] + p["len"]).alias("end"),
            p["value"].alias("value"),
            p["len"].alias("len"),
            p["inner"].alias("inner"),
        )

    return F.filter(F.transform(pieces, placed), holds)


def _block_sums(parts: str, total: Callable[[Column], Column]) -> Column:
    """The sum of each block of parts."""
    column = F.col(parts)
    blocks = F.sequence(F.lit(0), F.floor((F.size(column) - 1) / _BLOCK).cast("int"))
    sums = F.transform(blocks, lambda c: total(F.slice(column, c * _BLOCK + 1, F.lit(_BLOCK))))
    return F.when(F.size(column) > 0, sums)


def _hot_part(value: Column, settings: Settings) -> Column:
    """The part (first, last) of a candidate that lies in windows at or above the threshold, or
    NULL.

    The state of the walk is the count of each character in the window and the sum of n*log2(n) over
    them, in millionths so that steps add up without drift. A window's entropy is log2(w) - sum / w.
    """
    w = settings.window
    weight = F.array(
        *(F.lit(round(1e6 * n * math.log2(n)) if n else 0).cast("bigint") for n in range(w + 2))
    )
    # The largest sum at which the entropy still reaches the threshold of the class.
    bound = F.lit(-1).cast("bigint")
    for _, pattern, bits in reversed(settings.classes):
        limit = F.lit(math.floor(1e6 * w * (math.log2(w) - bits) + 0.5)).cast("bigint")
        bound = F.when(F.rlike(value, F.lit(pattern)), limit).otherwise(bound)

    # Each step: the place, the character that enters the window there, and the one that leaves (0: none yet).
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))

    def steps(codes: Column) -> Column:
        gone = F.concat(F.array_repeat(F.lit(0), w), F.slice(codes, F.lit(1), F.size(codes) - w))
        places = F.sequence(F.lit(1), F.size(codes))
        return F.arrays_zip(places.alias("k"), codes.alias("enters"), gone.alias("leaves"))

    def put(counts: Column, place: Column, n: Column) -> Column:
        size = F.lit(len(ALPHABET))
        return F.concat(F.slice(counts, F.lit(1), place - 1), F.array(n), F.slice(counts, place + 1, size))

    def step(state: Column, m: Column) -> Column:
        n_in = F.element_at(state["counts"], m["enters"])
        gained = F.get(weight, n_in + 1) - F.get(weight, n_in)
        entered = put(state["counts"], m["enters"], n_in + 1)
        return F.transform(F.array(entered), lambda counts: left(state, m, counts, state["sum"] + gained))[0]

    def left(state: Column, m: Column, counts: Column, total: Column) -> Column:
        some = m["leaves"] > 0
        n_out = F.element_at(counts, F.greatest(m["leaves"], F.lit(1)))
        lost = F.get(weight, n_out) - F.get(weight, n_out - 1)
        kept = F.when(some, put(counts, F.greatest(m["leaves"], F.lit(1)), n_out - 1)).otherwise(counts)
        rest = F.when(some, total - lost).otherwise(total)
        return F.transform(F.array(rest), lambda total: moved(state, m["k"], kept, total))[0]

    def moved(state: Column, k: Column, counts: Column, total: Column) -> Column:
        hot = (k >= w) & (total <= state["bound"])
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            F.when(hot & (state["first"] == 0), k - (w - 1)).otherwise(state["first"]).alias("first"),
            F.when(hot, k).otherwise(state["last"]).alias("last"),
            state["bound"].alias("bound"),
        )

    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
        F.lit(0).cast("bigint").alias("sum"),
        F.lit(0).alias("first"),
        F.lit(0).alias("last"),
        bound.alias("bound"),
    )
    return F.aggregate(
        F.transform(F.array(codes), steps)[0],
        start,
        step,
        lambda s: F.when(s["first"] > 0, F.struct(s["first"].alias("first"), s["last"].alias("last"))),
    )


def _place(start: Column, rank: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), rank.alias("rank"), end.alias("end"))


def _first(spans: Column, holds: Callable[[Column], Column]) -> Column:
    """The number of the first span that holds, where all behind it do too; by bisection."""
    low, high = F.lit(0).alias("low"), F.size(spans).alias("high")

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        return F.transform(F.array(middle), lambda m: narrowed(state, m))[0]

    def narrowed(state: Column, middle: Column) -> Column:
        # Behind the last span nothing is asked.
        left = F.coalesce(holds(F.get(spans, middle)), F.lit(True))
        still = state["low"] < state["high"]
        return F.struct(
            F.when(still & ~left, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(still & left, middle).otherwise(state["high"]).alias("high"),
        )

    turns = F.sequence(F.lit(0), F.floor(F.log2(F.size(spans) + 1)).cast("int"))
    return F.aggregate(turns, F.struct(low, high), halve, lambda s: s["low"])


def _touching(h: Column) -> Column:
    """The base spans that overlap a span, in order. Those of one kind stand in order, apart from each other."""

    def of_kind(kind: str) -> Column:
        spans = F.col(f"{kind}_spans")
        first = _first(spans, lambda b: b["end"] > h["start"])
        end = _first(spans, lambda b: b["start"] >= h["end"])
        return F.slice(spans, first + 1, F.greatest(end - first, F.lit(0)))

    return F.array_sort(F.concat(*(of_kind(k) for k in KINDS[:3])))


def _told(h: Column) -> Column:
    """How far from its start base spans tell a span without a gap."""
    return F.aggregate(
        _touching(h),
        h["start"],
        lambda told, b: F.when(b["start"] <= told, F.greatest(told, b["end"])).otherwise(told),
    )


_SPANS = "array<struct<start:int,rank:int,end:int>>"


def scan(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id and its spans: arrays of (start, rank of the kind, end), in order.

    base holds the kinds found by form; spans holds them and what the entropy adds: all spans that base does
    not tell from end to end.
    """
    patterns = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, CANDIDATE)))
    holds = {
        "assign": lambda s: s["inner"] >= 6,
        "access": lambda s: s["len"] >= 20,
        "hex": lambda s: s["len"] >= 24,
        "entropy": lambda s: F.lit(True),
    }
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", *(_pieces(k, patterns[k]).alias(k) for k in KINDS))
    rows = rows.select("*", *(_block_sums(k, _total).alias(f"{k}_sums") for k in KINDS))
    rows = rows.select("*", *(_block_sums(f"{k}_sums", _sum).alias(f"{k}_sums2") for k in KINDS))
    none = F.array().cast(_SPANS)

    def hot(s: Column) -> Column:
        part = F.array(_hot_part(s["value"], settings))
        return F.transform(
            part,
            lambda h: F.when(
                h.isNotNull(), _place(s["start"] + h["first"] - 1, s["rank"], s["start"] + h["last"])
            ),
        )[0]

    suspects = F.flatten(F.transform(_spans("entropy", holds["entropy"]), lambda s: _suspect(s, settings)))
    rows = rows.select(
        "doc_id",
        *(
            F.coalesce(
                F.transform(_spans(k, holds[k]), lambda s: _place(s["start"], s["rank"], s["end"])), none
            ).alias(f"{k}_spans")
            for k in KINDS[:3]
        ),
        F.array_compact(F.coalesce(F.transform(suspects, hot), none)).alias("hot"),
    )
    rows = rows.select("*", F.array_sort(F.concat(*(f"{k}_spans" for k in KINDS[:3]))).alias("base"))
    news = F.filter("hot", lambda h: _told(h) < h["end"])
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", news)).alias("spans"))


def _written(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ","
    )


def report(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Counts of the kinds found by form, a digest of their spans, and all spans as text."""

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == KINDS.index(kind))).cast("bigint")

    return scan(docs, settings).select(
        "doc_id",
        *(number(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(_written("base").cast("binary"), 256).alias("base_sha256"),
        _written("spans").alias("spans"),
    )


def redacted(docs: DataFrame, settings: Settings = Settings(), mark: str = "[secret]") -> DataFrame:
    """doc_id and text with each found stretch replaced by a mark; overlapping spans are one stretch."""
    whole = docs.select(F.struct("doc_id", "text").alias("doc_id"), "text")
    text = F.col("row.text")

    def take(state: Column, span: Column) -> Column:
        between = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.when(span["start"] >= state["at"], F.concat(state["text"], between, F.lit(mark)))
            .otherwise(state["text"])
            .alias("text"),
            F.greatest(state["at"], span["end"]).alias("at"),
        )

    clean = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("text"), F.lit(0).alias("at")),
        take,
        lambda s: F.concat(s["text"], F.substring(text, s["at"] + 1, F.char_length(text))),
    )
    return scan(whole, settings).withColumnRenamed("doc_id", "row").select(
        "row.doc_id",
        F.when(F.size("spans") == 0, text).otherwise(clean).alias("text"),
    )
