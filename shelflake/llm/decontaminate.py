"""Benchmark decontamination: suffix arrays over shards of the training documents.

A shard is a run of documents inside one task. Its suffix array holds the word positions at which a
test window could begin, ordered by the words that follow. Every window of WINDOW_WORDS words of
every test item (a shorter item is one window) is looked up by binary search, a word at a time. The
longest match is a run of such windows: a shared run shorter than a window is not reported, and of
several longest matches one place of one is. The test set is a stated query set: it goes to the shards in
blocks of a bounded number of words, and no row is shuffled.

Defined results: a NULL or empty text has no words and is clean; repeated rows give repeated
results; items without words, or without an id, match nothing; other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import pieces_of

WINDOW_WORDS = 10
SHARD_CHARS = 1 << 20
BLOCK_WORDS = 1 << 20

# ASCII letters in lower case, digits and everything beyond ASCII make words; the rest parts them.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
# Parts documents within a shard. No word holds it.
_BREAK = b"|"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_WORD_BYTES).split()


@dataclass
class TestBlock:
    """Windows of some test items, as rows of word numbers; zeros fill short rows."""

    vocabulary: dict[bytes, int]
    windows: np.ndarray  # distinct windows x WINDOW_WORDS
    lengths: np.ndarray
    places: list[list[tuple[int, int]]]  # of each window: (item, word position)
    item_ids: list[str]
    first_words: np.ndarray  # packed first two words (or one) of any window, sorted
    depth: int

    __test__ = False


def build_block(items: list[tuple[str, list[bytes]]], window: int) -> TestBlock:
    vocabulary: dict[bytes, int] = {}
    found: dict[tuple[int, ...], list[tuple[int, int]]] = {}
    for n, (_, words) in enumerate(items):
        numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
        for p in range(max(1, len(numbers) - window + 1)):
            found.setdefault(tuple(numbers[p : p + window]), []).append((n, p))
    vocabulary[_BREAK] = -1
    rows = np.zeros((len(found), window), np.int64)
    lengths = np.zeros(len(found), np.int64)
    for i, w in enumerate(found):
        rows[i, : len(w)] = w
        lengths[i] = len(w)
    depth = min(2, int(lengths.min(initial=2)))
    first = rows[:, 0] * (len(vocabulary) + 1) + (rows[:, 1] if depth == 2 else 0)
    return TestBlock(
        vocabulary, rows, lengths, list(found.values()), [i for i, _ in items], np.unique(first), depth
    )


def test_blocks(
    items: DataFrame, window: int = WINDOW_WORDS, block_words: int = BLOCK_WORDS
) -> Iterator[TestBlock]:
    """The test set, a block of items at a time. An item id that comes twice is one item of two
    texts.
    """
    block, held = [], 0
    for row in items.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        words = words_of(row[1])
        if row[0] is None or not words:
            continue
        if held and held + len(words) > block_words:
            yield build_block(block, window)
            block, held = [], 0
        block.append((row[0], words))
        held += len(words)
    if block:
        yield build_block(block, window)


test_blocks.__test__ = False


def _suffix_array(numbers: np.ndarray, block: TestBlock) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may begin, in the order of the words that follow, and those words."""
    window = block.windows.shape[1]
    padded = np.concatenate([numbers, np.full(window, -1, np.int64)])
    at = np.flatnonzero(numbers > 0)
    key = padded[at] * (len(block.vocabulary) + 1)
    if block.depth == 2:
        key += np.where(padded[at + 1] > 0, padded[at + 1], 0)
    slot = np.minimum(np.searchsorted(block.first_words, key), len(block.first_words) - 1)
    at = at[block.first_words[slot] == key]
    following = padded[at[:, None] + np.arange(window)]
    order = np.lexsort(following.T[::-1])
    return at[order], following[order]


def _search(following: np.ndarray, block: TestBlock) -> tuple[np.ndarray, np.ndarray]:
    """For each test window, the range of the suffix array that begins with it."""
    n, base = len(following), len(block.vocabulary) + 2
    low, high = np.zeros(len(block.windows), np.int64), np.zeros(len(block.windows), np.int64)
    rank, alive = np.zeros(n, np.int64), np.arange(len(block.windows))
    wanted = np.zeros(len(alive), np.int64)
    for depth in range(following.shape[1]):
        done = block.lengths[alive] == depth
        low[alive[done]] = np.searchsorted(rank, wanted[done], "left")
        high[alive[done]] = np.searchsorted(rank, wanted[done], "right")
        alive, wanted = alive[~done], wanted[~done]
        if not n or not len(alive):
            return low, high
        key = rank * base + following[:, depth] + 1  # ascending, as the array is in order
        steps = np.concatenate([[True], key[1:] != key[:-1]])
        distinct = key[steps]
        query = wanted * base + block.windows[alive, depth] + 1
        slot = np.searchsorted(distinct, query)
        hit = distinct[np.minimum(slot, len(distinct) - 1)] == query
        alive, wanted = alive[hit], slot[hit]
        rank = np.cumsum(steps) - 1
    low[alive] = np.searchsorted(rank, wanted, "left")
    high[alive] = np.searchsorted(rank, wanted, "right")
    return low, high


def _longest(hits: list[tuple[int, int]], block: TestBlock) -> tuple[int, int, int, int]:
    """The longest run of windows that follow each other in the document and in one item.

    hits: (window, word position). Gives words, item, place in the item, place in the document.
    """
    reach: dict[tuple[int, int], tuple[int, int]] = {}  # diagonal -> (start, end) of its last run
    best = (0, 0, 0, 0)
    for at, w in sorted((at, w) for w, at in hits):
        length = int(block.lengths[w])
        for item, p in block.places[w]:
            start, end = reach.get((item, at - p), (at, at))
            if end < at + length - 1:  # not the next window of the same run
                start = at
            reach[item, at - p] = (start, at + length)
            best = max(best, (at + length - start, -start, -item, -(p - (at - start))))
    return best[0], -best[2], -best[3], -best[1]


_OWN = (
    T.StructType()
    .add("n_words", "long")
    .add("hits", T.ArrayType(T.LongType()))
    .add("items", T.ArrayType(T.StringType()))
    .add("longest_words", "long")
    .add("longest_item", "string")
    .add("longest_item_start", "long")
    .add("longest_start", "long")
)


def _search_shards(block: TestBlock, schema: pa.Schema, shard_chars: int, first: bool):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = block.vocabulary.get
        for shard in pieces_of(batches, "text", shard_chars):
            texts = [
                (t or "").encode("utf-8", "replace").translate(_WORD_BYTES)
                for t in shard.column("text").to_pylist()
            ]
            flat = (b" " + _BREAK + b" ").join(texts).split()
            numbers = np.fromiter(map(get, flat, repeat(0)), np.int64, len(flat))
            del flat
            ends = np.append(np.flatnonzero(numbers == -1), len(numbers))
            starts = np.concatenate([[0], ends[:-1] + 1])
            at, following = _suffix_array(numbers, block)
            low, high = _search(following, block)
            marks = np.zeros(len(numbers) + 1, np.int64)
            by_document: dict[int, list[tuple[int, int]]] = {}
            for w in np.flatnonzero(high > low):
                places = at[low[w] : high[w]]
                np.add.at(marks, places, 1)
                np.add.at(marks, places + block.lengths[w], -1)
                owners = np.searchsorted(starts, places, "right") - 1
                for d, p in zip(owners.tolist(), (places - starts[owners]).tolist()):
                    by_document.setdefault(d, []).append((int(w), p))
            covered = np.cumsum(marks)[:-1] > 0
            before = None if first else shard.select(_OWN.names).to_pylist()
            out: dict[str, list] = {name: [] for name in _OWN.names}
            for d in range(shard.num_rows):
                n = int(ends[d] - starts[d])
                places, items, longest = [], set(), (0, None, None, None)
                if d in by_document:
                    places = np.flatnonzero(covered[starts[d] : ends[d]]).tolist()
                    windows = {w for w, _ in by_document[d]}
                    items = {block.item_ids[i] for w in windows for i, _ in block.places[w]}
                    words, item, item_start, start = _longest(by_document[d], block)
                    longest = (words, block.item_ids[item], item_start, start)
                if before and before[d]["hits"]:
                    old = before[d]
                    places, items = sorted({*places, *old["hits"]}), items | set(old["items"])
                    if old["longest_words"] >= longest[0]:
                        longest = tuple(old[c] for c in _OWN.names[-4:])
                out["n_words"].append(n)
                out["hits"].append(places)
                out["items"].append(sorted(items))
                for name, value in zip(_OWN.names[-4:], longest):
                    out[name].append(value)
            yield _filled(shard, out, schema)

    return search


def _count_words(schema: pa.Schema):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(words_of(t)) for t in batch.column("text").to_pylist()]
            out = dict.fromkeys(_OWN.names, [None] * len(n))
            empty = [[]] * len(n)
            out |= {"n_words": n, "hits": empty, "items": empty, "longest_words": [0] * len(n)}
            yield _filled(batch, out, schema)

    return count


def _filled(batch: pa.RecordBatch, out: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(out[f.name], f.type) if f.name in out else batch.column(f.name) for f in schema],
        schema=schema,
    )


def match_documents(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = WINDOW_WORDS,
    shard_chars: int = SHARD_CHARS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """docs (doc_id, text) with what any item shares with them verbatim.

    Adds n_words, hits (positions of the words inside matches), items (ids, sorted as strings)
    and the longest match: its words, its item, its place there and its place in the document.
    """
    found = docs.select("doc_id", "text")
    schema = T.StructType([*found.schema.fields, *_OWN.fields])
    arrow = to_arrow_schema(schema)
    first = True
    for block in test_blocks(items, window, block_words):
        found = found.mapInArrow(_search_shards(block, arrow, shard_chars, first), schema)
        first = False
    return found.mapInArrow(_count_words(arrow), schema) if first else found


def digest(items: Column) -> Column:
    return F.sha2(F.concat_ws(",", items).cast("binary"), 256)


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per document: how much of it is in the test set, and whether any is."""
    return match_documents(docs, items, **options).select(
        "doc_id",
        "n_words",
        F.size("hits").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        digest(F.col("items")).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        "longest_words",
        "longest_item",
        "longest_item_start",
        "longest_start",
    )


def decontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents, all columns, without those that share a window with the test set."""
    spare = docs.select(
        F.struct(*docs.columns).alias("doc_id"), F.col("text").alias("text")
    )
    return (
        match_documents(spare, items, **options)
        .where(F.size("hits") == 0)
        .select("doc_id.*")
    )
