"""SentencePiece text encoding and decoding, by rounds of merges over flat arrays.

A text is one word after another, parted before each run of blanks; no piece spans such a place.
Words that come again are looked up. The new ones of a batch stand end to end in one array of
symbols, cut further where two neighbours stand side by side in no piece. Each round finds, in every
segment, the best rank that two neighbours could be merged to, and merges all pairs of that rank that
do not overlap, leftmost first; then the array is closed up and looked through again, until no pair is
left. A merge after which a pair of the same or a better rank stands there ends its segment's
round, so the order is the library's: best score first, and of equal scores the leftmost.

A run of more than ``QUEUE_FROM`` symbols without any such border (a long line of blanks or of
digits) would need as many rounds as it has ranks, each over all of it. Its pairs come from a
priority queue instead, which gives the same merges one at a time.

Only the file's vocabulary is used. Models with user-defined or unused pieces, with a normalization table or
with blanks at word ends are refused, as are those that remove blanks.

Defined results: a NULL text is the empty one and has the end mark alone; repeated rows are encoded as
often as they come; an empty table gives no rows. Other columns are left alone, and texts are never
shuffled. A very long text is taken in stretches of words.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import pieces_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PIECE_CHARS = 1 << 20
#: Symbols of an unbroken run beyond which its pairs are queued.
QUEUE_FROM = 512
#: Words whose ids a worker remembers, and words that are looked through at once.
KNOWN_WORDS, WORDS_AT_ONCE = 1 << 18, 1 << 18

BLANK = "▁"
_WORD = re.compile(f"{BLANK}*[^{BLANK}]*")

# --- the model file ------------------------------------------------------------

# Numbers of the fields in the file, and the kinds of pieces: fixed values of the format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_TEXT, _SCORE, _KIND = 1, 2, 3
_MODEL_TYPE, _BLANK_AT_END, _BYTE_FALLBACK, _UNKNOWN_SURFACE = 3, 24, 35, 44
_TABLE, _DUMMY_PREFIX, _REMOVE_BLANKS, _ESCAPE_BLANKS = 2, 3, 4, 5
_BPE = 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        if data[at] < 128:
            return value, at + 1
        at, shift = at + 1, shift + 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a message."""
    at = 0
    while at < len(data):
        key, at = _number(data, at)
        if key & 7 == 0:
            value, at = _number(data, at)
        else:
            size, at = _number(data, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class Model:
    """Pieces, their scores and kinds, as the file has them."""

    def __init__(self, path: str) -> None:
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores, trainer, normalizer = [], {}, {}
        with open(path, "rb") as file:
            data = file.read()
        for number, value in _fields(data):
            if number == _PIECES:
                piece = dict(_fields(value))
                self.pieces.append(piece[_TEXT].decode())
                scores.append(piece.get(_SCORE, b"\0\0\0\0"))
                self.kinds.append(piece.get(_KIND, NORMAL))
            elif number == _TRAINER:
                trainer = dict(_fields(value))
            elif number == _NORMALIZER:
                normalizer = dict(_fields(value))
        self.scores = np.frombuffer(b"".join(scores), "<f4")
        self.unknown_surface = trainer.get(_UNKNOWN_SURFACE, " ⁇ ".encode())
        as_needed = (
            trainer.get(_MODEL_TYPE) == _BPE
            and trainer.get(_BYTE_FALLBACK) == 1
            and not trainer.get(_BLANK_AT_END)
            and not normalizer.get(_TABLE)
            and normalizer.get(_DUMMY_PREFIX, 1) == 1
            and normalizer.get(_REMOVE_BLANKS, 1) == 0
            and normalizer.get(_ESCAPE_BLANKS, 1) == 1
            and not {USER_DEFINED, UNUSED} & set(self.kinds)
        )
        if not as_needed:
            raise ValueError(f"{path} is not a plain byte-fallback BPE model")

    def of_kind(self, kind: int) -> list[int]:
        return [i for i, k in enumerate(self.kinds) if k == kind]


# --- encoding ----------------------------------------------------------------------

_NONE = np.iinfo(np.int64).max


class Table:
    """Numbers by whole-number keys, looked up for an array of keys at a time: open addressing, at most a
    quarter full.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int64)
        slots = self._slots(keys)
        while len(keys):
            _, first = np.unique(slots, return_index=True)
            placed = np.zeros(len(keys), bool)
            placed[first] = self.keys[slots[first]] < 0
            self.keys[slots[placed]], self.values[slots[placed]] = keys[placed], values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where there is none."""
        slots = self._slots(keys)
        there = self.keys[slots]
        found = np.where(there == keys, self.values[slots], -1)
        place = np.flatnonzero((there != keys) & (there >= 0))
        keys, slots = keys[place], slots[place]
        while len(place):
            slots = (slots + 1) & self.mask
            there = self.keys[slots]
            found[place] = np.where(there == keys, self.values[slots], -1)
            further = (there != keys) & (there >= 0)
            place, keys, slots = place[further], keys[further], slots[further]
        return found


class Coder:
    """Ids of texts, and texts of ids.

    A symbol is a piece's id, or a number above all ids for a character that is no piece.
    """

    def __init__(self, path: str) -> None:
        model = Model(path)
        size = len(model.pieces)
        normal = model.of_kind(NORMAL)
        ids = {model.pieces[i]: i for i in normal}
        self.end_id = model.pieces.index("</s>")
        self.byte_ids = [i for _, i in sorted((int(model.pieces[i][3:5], 16), i) for i in model.of_kind(BYTE))]
        # Equal scores have equal ranks.
        _, ranks = np.unique(-model.scores, return_inverse=True)
        self.ranks = ranks

        # Characters that stand in pieces of several, and which of them stand side by side there.
        several = [p for p in ids if len(p) > 1]
        letters = {c: n for n, c in enumerate(sorted(set(chain.from_iterable(several))), 1)}
        self.symbols = {chr(b): i for b, i in enumerate(self.byte_ids[:128])}
        self.symbols |= {c: ids.get(c, size + n) for c, n in letters.items()}
        self.symbols |= {p: i for p, i in ids.items() if len(p) == 1}
        #: Stands for all other characters that no piece holds.
        self.other = size + len(letters) + 1
        width = self.other + 1
        side_by_side = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        keys, merged = [], []
        for piece in several:
            for left, right in zip(piece, piece[1:]):
                side_by_side[letters[left], letters[right]] = True
            for cut in range(1, len(piece)):
                left, right = (
                    self.symbols.get(p) if len(p) == 1 else ids.get(p) for p in (piece[:cut], piece[cut:])
                )
                if left is not None and right is not None:
                    keys.append(left * width + right)
                    merged.append(ids[piece])
        self.width = width
        self.pairs = Table(np.array(keys, np.int64), np.array(merged, np.int64))
        self.side_by_side = side_by_side
        points = sorted(self.symbols)
        self.points = np.array([ord(c) for c in points], np.int64)
        self.point_symbols = np.array([self.symbols[c] for c in points], np.int64)
        self.point_letters = np.array([letters.get(c, 0) for c in points], np.int64)
        #: No piece has a blank behind another character, so that words can be parted there.
        self.words_part = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in several)
        self._forget()

        self.hidden = np.array([k == CONTROL for k in model.kinds])
        self.blank_first = np.array([k == NORMAL and p[0] == BLANK for p, k in zip(model.pieces, model.kinds)])
        shown = [self._shown(p, k, model.unknown_surface) for p, k in zip(model.pieces, model.kinds)]
        self.shown = Strings(shown)
        self.decimals = Strings([b"%d " % i for i in range(size)])

    def _forget(self) -> None:
        """Words seen are numbered; the ids of word n are known_ids[bounds[n] : bounds[n + 1]]."""
        self.known: dict[str, int] = {}
        self.known_ids = np.zeros(0, np.int32)
        self.bounds = np.zeros(1, np.int64)

    @staticmethod
    def _shown(piece: str, kind: int, unknown: bytes) -> bytes:
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return unknown
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        return piece.replace(BLANK, " ").encode()

    # What two neighbours merge to, -1 if to nothing.
    def _merges(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.pairs.find(left * self.width + right)

    def _rank_of(self, merged: np.ndarray) -> np.ndarray:
        return np.where(merged >= 0, self.ranks[merged], _NONE)

    def _symbols_of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The symbol of each character, and its number among the letters of pieces, 0 if it is none."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        there = self.points[at] == points
        return np.where(there, self.point_symbols[at], self.other), np.where(there, self.point_letters[at], 0)

    def _learn(self, words: list[str]) -> None:
        """Encode new words, all at once."""
        text = "".join(words)
        symbols, letters = self._symbols_of(text)
        ends = np.cumsum([len(w) for w in words])
        begins = np.ones(len(symbols), bool)
        begins[1:] = ~self.side_by_side[letters[:-1], letters[1:]]
        begins[ends[:-1]] = True
        firsts = np.flatnonzero(begins)
        sizes = np.diff(np.append(firsts, len(symbols)))
        place = np.arange(len(symbols))
        segment = np.repeat(np.arange(len(firsts)), sizes)

        long = sizes > QUEUE_FROM
        short = ~long[segment]
        done = [self._rounds(place[short], symbols[short], segment[short])]
        for first, size in zip(firsts[long].tolist(), sizes[long].tolist()):
            kept, queued = self._queued(symbols[first : first + size].tolist())
            done.append((np.array(kept) + first, np.array(queued)))
        places = np.concatenate([p for p, _ in done])
        found = np.concatenate([s for _, s in done])
        order = np.argsort(places)
        places, found = places[order], found[order]
        self._remember(words, ends, text, places, found)

    def _remember(self, words, ends, text, places, symbols) -> None:
        bounds = np.searchsorted(places, ends)
        unknown = np.flatnonzero(symbols >= len(self.ranks))
        if len(unknown):
            # Characters that are no piece become the pieces of their bytes.
            spelled = [text[p].encode("utf-8", "surrogatepass") for p in places[unknown].tolist()]
            sizes = np.ones(len(symbols), np.int64)
            sizes[unknown] = [len(b) for b in spelled]
            firsts = np.append(0, np.cumsum(sizes))
            bounds = firsts[bounds]
            symbols = np.repeat(symbols, sizes)
            bytes_ = np.array(self.byte_ids)[np.frombuffer(b"".join(spelled), np.uint8)]
            symbols[symbols >= len(self.ranks)] = bytes_
        known = len(self.known)
        self.known.update(zip(words, range(known, known + len(words))))
        self.bounds = np.concatenate([self.bounds, bounds + self.bounds[-1]])
        self.known_ids = np.concatenate([self.known_ids, symbols.astype(np.int32)])

    def _rounds(self, place, symbols, segment) -> tuple[np.ndarray, np.ndarray]:
        """Merge until no pair is left. Returns the first places and the symbols of what remains."""
        finished = []
        while len(symbols):
            same = segment[1:] == segment[:-1]
            merged = np.full(len(symbols), -1, np.int64)
            merged[:-1] = np.where(same, self._merges(symbols[:-1], symbols[1:]), -1)
            rank = self._rank_of(merged)
            firsts = np.flatnonzero(np.append(True, ~same))
            best = np.minimum.reduceat(rank, firsts)
            sizes = np.diff(np.append(firsts, len(symbols)))
            of = np.repeat(best, sizes)
            settled = of == _NONE
            finished.append((place[settled], symbols[settled]))
            chosen = np.flatnonzero((rank == of) & ~settled)
            if not len(chosen):
                break
            chosen = self._leftmost(chosen)
            chosen = self._in_turn(chosen, symbols, segment, merged, rank)
            symbols = symbols.copy()
            symbols[chosen] = merged[chosen]
            left = ~settled
            left[chosen + 1] = False
            place, symbols, segment = place[left], symbols[left], segment[left]
        return (
            np.concatenate([p for p, _ in finished] or [place]),
            np.concatenate([s for _, s in finished] or [symbols]),
        )

    @staticmethod
    def _leftmost(chosen: np.ndarray) -> np.ndarray:
        """Of pairs that share a symbol, in a row, every second from the left."""
        new_run = np.append(True, np.diff(chosen) != 1)
        run_starts = np.flatnonzero(new_run)
        nth = np.arange(len(chosen)) - np.repeat(run_starts, np.diff(np.append(run_starts, len(chosen))))
        return chosen[nth % 2 == 0]

    def _in_turn(self, chosen, symbols, segment, merged, rank) -> np.ndarray:
        """The merges up to the first of its segment that makes a pair to be merged before the next."""
        made = merged[chosen]
        last = len(symbols) - 1
        behind, before = np.minimum(chosen + 2, last), np.maximum(chosen - 1, 0)
        pair = self._rank_of(self._merges(made, symbols[behind]))
        pair[(chosen + 2 > last) | (segment[behind] != segment[chosen])] = _NONE
        # In front stands the symbol there, or what the merge before has made of it.
        joined = np.append(False, chosen[1:] - chosen[:-1] == 2)
        front = np.where(joined, np.append(-1, made[:-1]), symbols[before])
        other = self._rank_of(self._merges(np.maximum(front, 0), made))
        other[(chosen == 0) | (segment[before] != segment[chosen])] = _NONE
        stops = np.minimum(pair, other) <= rank[chosen]
        stopped = np.cumsum(stops) - stops
        owner = segment[chosen]
        firsts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        base = np.repeat(stopped[firsts], np.diff(np.append(firsts, len(chosen))))
        return chosen[stopped == base]

    def _queued(self, symbols: list[int]) -> tuple[list[int], list[int]]:
        """The same merges, one at a time."""
        size = len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        makes = self._merges(np.array(symbols[:-1]), np.array(symbols[1:]))
        ranks = self._rank_of(makes).tolist()
        queue = [(ranks[i], i, symbols[i], symbols[i + 1], m) for i, m in enumerate(makes.tolist()) if m >= 0]
        heapify(queue)
        pairs = self.pair_ranks

        def offer(left: int, right: int) -> None:
            if left < 0 or right >= size:
                return
            made = pairs.get(symbols[left] * self.width + symbols[right])
            if made is not None:
                heappush(queue, (made[0], left, symbols[left], symbols[right], made[1]))

        while queue:
            _, left, one, two, made = heappop(queue)
            right = after[left]
            if symbols[left] != one or right >= size or symbols[right] != two:
                continue
            symbols[left], symbols[right] = made, -1
            after[left] = following = after[right]
            if following < size:
                before[following] = left
            offer(before[left], left)
            offer(left, following)
        kept = [i for i, s in enumerate(symbols) if s >= 0]
        return kept, [symbols[i] for i in kept]

    @property
    def pair_ranks(self) -> dict[int, tuple[int, int]]:
        """The rank of what each pair is merged to, and that piece."""
        if not hasattr(self, "_pair_ranks"):
            filled = self.pairs.keys >= 0
            merged = self.pairs.values[filled]
            found = zip(self.ranks[merged].tolist(), merged.tolist())
            self._pair_ranks = dict(zip(self.pairs.keys[filled].tolist(), found))
        return self._pair_ranks

    def _words(self, text: str) -> Iterator[list[str]]:
        """The words of a text, in stretches."""
        spaced = BLANK + text.replace(" ", BLANK)
        if not self.words_part:
            yield [spaced]
            return
        start = 0
        while start < len(spaced):
            end = start + PIECE_CHARS
            while 0 <= end < len(spaced) and not (spaced[end] == BLANK and spaced[end - 1] != BLANK):
                end = spaced.find(BLANK, end + 1)
            end = len(spaced) if end < 0 else min(end, len(spaced))
            yield _WORD.findall(spaced, start, end)[:-1]
            start = end

    def encode(self, texts: Sequence[str], end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each has."""
        counts = np.zeros(len(texts), np.int64)
        parts = [np.zeros(0, np.int32)]
        # Short texts wait until there is enough to learn at once.
        waiting, held = [], 0
        for n, text in enumerate(texts):
            for words in self._words(text) if text else ():
                waiting.append((n, words))
                held += len(words)
                if held >= WORDS_AT_ONCE:
                    parts.append(self._spell(waiting, counts))
                    waiting, held = [], 0
        parts.append(self._spell(waiting, counts))
        ids = np.concatenate(parts)
        if end:
            ids, counts = np.insert(ids, np.cumsum(counts), self.end_id), counts + 1
        return ids, counts

    def _spell(self, waiting: list[tuple[int, list[str]]], counts: np.ndarray) -> np.ndarray:
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        new = set(chain.from_iterable(words for _, words in waiting)).difference(self.known)
        if new:
            self._learn(list(new))
        sizes = [len(words) for _, words in waiting]
        every = chain.from_iterable(words for _, words in waiting)
        numbers = np.fromiter(map(self.known.__getitem__, every), np.int64, sum(sizes))
        starts = self.bounds[numbers]
        lengths = self.bounds[numbers + 1] - starts
        ends = np.append(0, np.cumsum(lengths))
        np.add.at(counts, [n for n, _ in waiting], np.diff(ends[np.append(0, np.cumsum(sizes, dtype=np.int64))]))
        return self.known_ids[_runs(starts, lengths)]

    # --- decoding ------------------------------------------------------------------

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of ids that stand one text after another."""
        owner = np.repeat(np.arange(len(counts)), counts)
        # The blank put before a text is taken off its first piece.
        visible = np.flatnonzero(~self.hidden[ids])
        firsts = visible[np.append(True, np.diff(owner[visible]) > 0)[: len(visible)]]
        firsts = firsts[self.blank_first[ids[firsts]]]
        skipped = np.zeros(len(ids), np.int64)
        skipped[firsts] = 1
        data, ends = self.shown.joined(ids, skipped)
        bounds = np.append(0, ends)[np.append(0, np.cumsum(counts))].tolist()
        # Bytes on both sides of a hidden piece make no character together.
        breaks = ends[self.hidden[ids]]
        texts = []
        for a, b in zip(bounds, bounds[1:]):
            inner = breaks[np.searchsorted(breaks, a, "right") : np.searchsorted(breaks, b)].tolist()
            cuts = [a, *inner, b]
            texts.append("".join(data[i:j].decode(errors=_BYTEWISE) for i, j in zip(cuts, cuts[1:])))
        return texts

    def written(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The ids of each text in decimals, a blank between them."""
        data, ends = self.decimals.joined(ids)
        bounds = np.append(0, ends)[np.append(0, np.cumsum(counts))].tolist()
        return [data[a : b - 1] if b > a else b"" for a, b in zip(bounds, bounds[1:])]


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, … of each run, one run after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Strings:
    """Byte strings by number, joined for an array of numbers at a time."""

    def __init__(self, strings: list[bytes]) -> None:
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, numbers: np.ndarray, skipped: np.ndarray | int = 0) -> tuple[bytes, np.ndarray]:
        """All strings, without so many bytes at the beginning of each, and where each ends."""
        lengths = self.lengths[numbers] - skipped
        return self.data[_runs(self.starts[numbers] + skipped, lengths)].tobytes(), np.cumsum(lengths)


#: Names the way of decoding in which each byte that begins no character becomes a replacement mark.
_BYTEWISE = "replace-each-byte"
codecs.register_error(_BYTEWISE, lambda fault: ("�", fault.start + 1))


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)


# --- tables --------------------------------------------------------------------------


def encoded(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and the ids of each document, the end id last."""
    rows = docs.select("doc_id", "text")
    schema = T.StructType([rows.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", PIECE_CHARS):
            ids, counts = coder(model).encode([text or "" for text in batch.column("text").to_pylist()])
            offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids), arrow.field("ids").type)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], schema=arrow)

    return rows.mapInArrow(run, schema)


def decoded(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text of rows with ids. NULL ids have the empty text."""
    rows = rows.select("doc_id", "ids")
    schema = T.StructType([rows.schema["doc_id"], T.StructField("text", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [ids or [] for ids in batch.column("ids").to_pylist()]
            counts = np.array([len(ids) for ids in lists], np.int64)
            ids = np.fromiter(chain.from_iterable(lists), np.int64, counts.sum())
            texts = coder(model).decode(ids, counts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], schema=arrow)

    return rows.mapInArrow(run, schema)


_DIGESTS = T.StructType().add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")


def report(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Number and digest of each document's ids, and the digest of the text they are decoded to.

    One pass; neither ids nor texts leave their task.
    """
    rows = docs.select("doc_id", "text")
    schema = T.StructType([rows.schema["doc_id"], *_DIGESTS])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", PIECE_CHARS):
            code = coder(model)
            ids, counts = code.encode([text or "" for text in batch.column("text").to_pylist()])
            columns = [
                counts,
                [sha256(line).hexdigest() for line in code.written(ids, counts)],
                [sha256(text.encode()).hexdigest() for text in code.decode(ids, counts)],
            ]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], schema=arrow)

    return rows.mapInArrow(run, schema)
