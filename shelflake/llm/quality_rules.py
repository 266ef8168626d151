"""Quality rules as a ledger of failure bits.

Every rule is measured once per document. The ledger keeps the measurements and one integer
whose bit i says that rule i failed. A policy is a set of rules with a version, so applying it, or
an older one, is a bitwise AND, and what each rule does on its own is an aggregation of bits.

Defined results: a NULL or empty text has no words, and no document of the ledger is ever dropped;
repeated rows give repeated ledger rows. Other columns are left alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import pieces_of

PIECE_CHARS = 1 << 20

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_letter_words", "n_capital_words")


@dataclass(frozen=True)
class Rule:
    """A rule fails where its condition over the measurements holds."""

    name: str
    failed: str


#: The place of a rule is its bit. Rules are added at the end and never removed.
RULES = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_phrases", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    # One or two repeats say little about a short text.
    Rule("repeated_lines", "n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule("few_letter_words", "10 * n_letter_words < 7 * n_words"),
    Rule("shouting", "2 * n_capital_words > n_words"),
)
BITS = {rule.name: 1 << i for i, rule in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[name] for name in self.rules)


BASE = Policy("base", ("too_few_words", "repeated_phrases"))
POLICIES = (
    BASE,
    Policy("2024-1", (*BASE.rules, "many_symbols", "short_words", "long_words", "repeated_lines")),
    Policy("2024-2", tuple(BITS)),
)
CURRENT = POLICIES[-1]

_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\v\f\r"
_CONTINUATION = bytes(range(0x80, 0xC0))
_DROP_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))


def measure(text: str | None) -> tuple[int, ...]:
    """One text, in the order of MEASURES. Words are parted by ASCII white space only."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()  # of bytes: ASCII white space and nothing else
    n_symbols = len(data) - len(data.translate(None, _SYMBOLS))
    word_chars = len(data.translate(None, _SPACE + _CONTINUATION))
    lines = [line for line in data.split(b"\n") if line.strip()]
    letter = capital = 0
    for word in set(words):
        # Distinct words first; most texts repeat few of them.
        if len(word.translate(None, _DROP_LETTERS)) < len(word):
            letter += 1
            if len(word) > 1 and word.isupper():
                capital += 1
    if len(set(words)) != len(words):
        letter = capital = 0
        for word, n in Counter(words).items():
            if len(word.translate(None, _DROP_LETTERS)) < len(word):
                letter += n
                if len(word) > 1 and word.isupper():
                    capital += n
    return (
        len(words),
        word_chars,
        n_symbols,
        len(lines) - len(set(lines)),
        len(lines),
        _repeated(words),
        letter,
        capital,
    )


def _repeated(words: list[bytes]) -> int:
    """Words inside three-word windows that the text holds more than once."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    total = reach = 0
    for i, window in enumerate(windows):
        if often[window] > 1:
            total += i + 3 - max(i, reach)
            reach = i + 3
    return total


def measured(docs: DataFrame, piece_chars: int = PIECE_CHARS) -> DataFrame:
    rows = docs.select("doc_id", "text")
    schema = T.StructType([rows.schema["doc_id"]])
    for name in MEASURES:
        schema.add(name, "long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces_of(batches, "text", piece_chars):
            found = [measure(t) for t in piece.column("text").to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *columns], schema=arrow)

    return rows.mapInArrow(run, schema)


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: the measurements and failures, a bit for each rule."""
    bits = [F.when(F.expr(r.failed), F.lit(BITS[r.name])).otherwise(F.lit(0)) for r in RULES]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured(docs).withColumn("failures", total.cast("bigint"))


def passes(policy: Policy, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(policy.mask)) == 0


def ablations(rows: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """For each rule of a policy: the documents that fail it, and those only it keeps out.

    One pass over the ledger, summed before its single small shuffle.
    """
    hit = F.col("failures").bitwiseAND(F.lit(policy.mask))
    sums = rows.agg(
        F.count("*").alias("n_documents"),
        F.count_if(hit == 0).alias("n_kept"),
        *(F.count_if(hit.bitwiseAND(F.lit(BITS[n])) != 0).alias(f"failed_{n}") for n in policy.rules),
        *(F.count_if(hit == F.lit(BITS[n])).alias(f"alone_{n}") for n in policy.rules),
    )
    return sums.select(
        F.lit(policy.version).alias("policy"),
        "n_documents",
        "n_kept",
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(n).alias("rule"),
                        F.col(f"failed_{n}").alias("n_failed"),
                        F.col(f"alone_{n}").alias("n_failed_alone"),
                        (F.col("n_kept") + F.col(f"alone_{n}")).alias("n_kept_without"),
                    )
                    for n in policy.rules
                )
            )
        ).alias("r"),
    ).select("policy", "n_documents", "n_kept", "r.*")


def report(docs: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The ledger with the verdict of a policy and of the base rules."""
    rows = ledger(docs)
    return rows.withColumns(
        {"base_failed": ~passes(BASE), "kept": passes(BASE) & passes(policy)}
    )
