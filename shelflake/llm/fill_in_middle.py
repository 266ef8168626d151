"""Fill-in-middle: texts cut in three at token borders, with the middle moved to the end.

A token is a run of letters A to Z or a to z, or any other single character. Each character has a class: a
letter within a run, a letter that begins one, another ASCII sign, or a sign beyond ASCII. All but the
first begin a token. A wavelet matrix over the classes of a batch of texts, end to end, answers how
often a class comes before a place (rank); summed over the classes that begin a token, ranks count
the borders before it. The number of tokens of each text are two such counts, and a cut after k
tokens is found by bisection on them, for all texts and both cuts at once.

What a text is cut into depends on its id and the seed alone, so a task that is run again gives the
same, and repeated rows get the same cuts. Texts are never shuffled.

Defined results: a NULL text is the empty one, and is left plain, as is a text that holds one of the
marks; a NULL id counts as an empty string; an empty table gives no rows. Other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import pieces_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
#: Of a hundred texts that can be cut, so many are; of a hundred of those, so many begin with the suffix.
CUT_SHARE, SUFFIX_FIRST_SHARE = 90, 20
PIECE_CHARS = 1 << 20

# --- rank queries --------------------------------------------------------------

#: Classes of characters.
WITHIN, FIRST, SIGN, BEYOND = range(4)
BEGINNERS = (FIRST, SIGN, BEYOND)


class Bits:
    """A bit vector that tells the number of ones before a place: packed words and their running counts."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        octets = np.packbits(bits, bitorder="little")
        packed[: len(octets)] = octets
        self.words = packed.view("<u8")
        ones = np.bitwise_count(self.words)
        self.before = np.zeros(len(ones), np.int64)
        np.cumsum(ones[:-1], out=self.before[1:])

    def ones(self, places: np.ndarray) -> np.ndarray:
        word, bit = places >> 6, (places & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Ranks of small symbols. A level for each bit of them, highest first; each level moves the
    symbols without its bit before those with it, and keeps their order otherwise.
    """

    def __init__(self, symbols: np.ndarray, levels: int) -> None:
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in reversed(range(levels)):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append((bit, Bits(ones), len(ones) - int(ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        origin = np.zeros(1, np.int64)
        self.starts = [int(self._moved(symbol, origin)[0]) for symbol in range(1 << levels)]

    def _moved(self, symbol: int, places: np.ndarray) -> np.ndarray:
        for bit, bits, zeros in self.levels:
            ones = bits.ones(places)
            places = zeros + ones if symbol >> bit & 1 else places - ones
        return places

    def rank(self, symbol: int, places: np.ndarray) -> np.ndarray:
        """How often the symbol comes before each place."""
        return self._moved(symbol, places) - self.starts[symbol]


def classes(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """The class of each code point of texts that stand end to end."""
    lower = points | 32
    letter = (lower >= ord("a")) & (lower <= ord("z")) & (points < 128)
    after_letter = np.zeros(len(points), bool)
    after_letter[1:] = letter[:-1]
    after_letter[text_starts[text_starts < len(points)]] = False
    sign = np.where(points < 128, SIGN, BEYOND)
    return np.where(letter, np.where(after_letter, WITHIN, FIRST), sign).astype(np.uint8)


class Borders:
    """Counts and places of the token borders of some texts."""

    def __init__(self, texts: list[str]) -> None:
        lengths = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        self.matrix = WaveletMatrix(classes(points, self.starts), 2)
        self.before = self._begun(self.starts)

    def _begun(self, places: np.ndarray) -> np.ndarray:
        """Tokens that begin before each place."""
        return sum(self.matrix.rank(symbol, places) for symbol in BEGINNERS)

    def tokens(self) -> np.ndarray:
        return self._begun(self.ends) - self.before

    def places(self, units: np.ndarray) -> np.ndarray:
        """Where in its text each text's first so many tokens end, in code points."""
        low, high = self.starts.copy(), self.ends.copy()
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            beyond = self._begun(np.minimum(middle + 1, self.ends)) - self.before > units
            high = np.where(open_ & beyond, middle, high)
            low = np.where(open_ & ~beyond, middle + 1, low)
        return low - self.starts


# --- cutting ---------------------------------------------------------------------


def draws(doc_id: object, seed: int = SEED) -> tuple[int, ...]:
    """Four numbers of 32 bits for a document."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(key.encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def cut(doc_ids: list[object], texts: list[str], seed: int = SEED) -> list[tuple]:
    """(n, form, prefix_chars, middle_chars, output) of each text."""
    borders = Borders(texts)
    counts = borders.tokens()
    drawn = np.array([draws(i, seed) for i in doc_ids], np.int64).reshape(-1, 4)
    ends = np.sort(drawn[:, :2] % (counts[:, None] + 1), axis=1)
    firsts, seconds = (borders.places(ends[:, i]).tolist() for i in range(2))
    rows = []
    for text, n, a, b, (_, _, h3, h4) in zip(texts, counts.tolist(), firsts, seconds, drawn.tolist()):
        if not text or h3 % 100 >= CUT_SHARE or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
            rows.append((n, "plain", None, None, text))
            continue
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h4 % 100 < SUFFIX_FIRST_SHARE:
            form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
        else:
            form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
        rows.append((n, form, a, b - a, output))
    return rows


_CUT = (
    T.StructType()
    .add("n", "long")
    .add("form", "string")
    .add("prefix_chars", "long")
    .add("middle_chars", "long")
    .add("output", "string")
)


def transformed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n tokens, form, prefix_chars, middle_chars and the output text of each document."""
    rows = docs.select("doc_id", "text")
    schema = T.StructType([rows.schema["doc_id"], *_CUT])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", PIECE_CHARS):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            found = zip(*cut(batch.column("doc_id").to_pylist(), texts, seed))
            columns = [pa.array(c, f.type) for c, f in zip(found, list(arrow)[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema=arrow)

    return rows.mapInArrow(run, schema)


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made of. Each mark stands in it once."""
    before, after = F.substring_index(output, SUFFIX, 1), F.substring_index(output, SUFFIX, -1)
    suffix, middle = F.substring_index(after, MIDDLE, 1), F.substring_index(after, MIDDLE, -1)
    prefix_first = F.concat(F.replace(before, F.lit(PREFIX), F.lit("")), middle, suffix)
    front, back = F.substring_index(after, PREFIX, 1), F.substring_index(after, PREFIX, -1)
    suffix_first = F.concat(F.replace(back, F.lit(MIDDLE), F.lit("")), front)
    return F.when(form == "psm", prefix_first).when(form == "spm", suffix_first).otherwise(output)


def report(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The cuts of each document, with digests of the output and of the text rebuilt from it."""
    text = restored(F.col("form"), F.col("output"))
    return transformed(docs, seed).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(text.cast("binary"), 256).alias("restored_sha256"),
    )
