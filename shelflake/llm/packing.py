"""Best-fit packing of tokenized documents, large items first by matching.

Documents become pieces of at most one sequence. What matters for packing is a piece's length alone,
so the packing is solved on the histogram of lengths: at most `capacity` numbers, whatever the size
of the data. Pieces above a third of the capacity go at most two to a sequence and are matched
greedily: each with the longest partner that fits. The pieces up to a third then go, longest first,
to the sequences with the least room that holds them. Sequences with the same lengths are kept as
one pattern with a count. Each piece finds its place from its rank among the pieces of its length.

Defined results: a NULL or empty text has the end mark alone; repeated rows are packed as often as
they come; an empty table has no pieces. Other columns are left alone. Texts are never shuffled, and
neither are tokens.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from .common import broadcast_if_small, pieces_of, stored

CAPACITY = 1024
END_ID = 2
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_CHARS = 1 << 20

# --- tokens ------------------------------------------------------------------

#: How the vocabulary's own library parts a text before merging bytes.
#: Plain characters are classed alike by every regex engine; other texts are left to that library.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-¬®-ɏ‐-―‘-‟…]*")


class Encoder:
    """Token ids of texts.

    The reference is the tokenizers library with the given file. Texts of plain characters go
    through a faster merge of the same vocabulary, which gives the same ids; those that hold an
    added token, such as <|endoftext|>, have its id there and are left to that library.
    """

    def __init__(self, path: str) -> None:
        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        special = self.exact.get_added_tokens_decoder()
        added = "|".join(re.escape(token.content) for token in special.values())
        self.added = re.compile(added or r"(?!)")
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in token): n for token, n in vocabulary.items() if n not in special
        }
        self.fast = tiktoken.Encoding(
            "vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str) -> np.ndarray:
        if _PLAIN.fullmatch(text) and not self.added.search(text):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.exact.encode(text, add_special_tokens=False).ids
        return np.array(ids, np.int64)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable ones for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of each piece of n ids: all full but the first."""
    first = n % capacity or capacity
    ends = range(min(first, n), n + 1, capacity)
    return [(max(0, end - capacity), end) if i else (0, end) for i, end in enumerate(ends)]


_PIECES = (
    T.StructType().add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
)


def tokenized(
    docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """doc_id, and per piece: piece, start, length, ids_crc32, the task and the nth of its length
    there.
    """
    rows = docs.select("doc_id", "text")
    place = T.StructType().add("task", "integer").add("nth", "long")
    schema = T.StructType([rows.schema["doc_id"], *_PIECES, *place])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64).tolist()
        for batch in pieces_of(batches, "text", PIECE_CHARS):
            owners, found = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(encode(text or ""), end_id).astype("<u4")
                for piece, (start, end) in enumerate(cuts(len(ids), capacity)):
                    owners.append(row)
                    crc = zlib.crc32(ids[start:end].tobytes())
                    found.append((piece, start, end - start, crc, task, seen[end - start]))
                    seen[end - start] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(owners)),
                    *(pa.array(c, f.type) for c, f in zip(zip(*found), list(arrow)[1:])),
                ],
                schema=arrow,
            )

    return rows.mapInArrow(run, schema)


# --- packing of the histogram ------------------------------------------------


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """The sequences, as (lengths of its pieces, number of such sequences).

    counts: pieces of each length. The work depends on the number of distinct lengths, not on the
    counts.
    """
    left = {n: c for n, c in counts.items() if c}
    # Sequences by the room they have left: {room: {pattern: number}}.
    by_room: dict[int, dict[tuple[int, ...], int]] = {}

    def keep(pattern: tuple[int, ...], number: int) -> None:
        of_room = by_room.setdefault(capacity - sum(pattern), {})
        of_room[pattern] = of_room.get(pattern, 0) + number

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        longest = large[-1]
        # The longest partner that fits, the piece's own length included.
        at = bisect_left(large, capacity - longest + 1) - 1
        if at < 0:
            keep((longest,), left.pop(longest))
            large.pop()
            continue
        partner = large[at]
        if partner == longest:
            pairs, odd = divmod(left.pop(longest), 2)
            large.pop()
            if pairs:
                keep((longest, longest), pairs)
            if odd:
                # The last one pairs with the next shorter length.
                if large:
                    shorter = large[-1]
                    keep((longest, shorter), 1)
                    left[shorter] -= 1
                    if not left[shorter]:
                        del left[shorter]
                        large.pop()
                else:
                    keep((longest,), 1)
            continue
        number = min(left[longest], left[partner])
        keep((longest, partner), number)
        for n in (longest, partner):
            left[n] -= number
            if not left[n]:
                del left[n]
                large.remove(n)

    rooms = sorted(by_room)
    for length in sorted(left, reverse=True):
        number = left[length]
        while number:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                full, rest = divmod(number, each)
                new = [((length,) * each, full)] if full else []
                new += [((length,) * rest, 1)] if rest else []
                number = 0
            else:
                room = rooms[at]
                pattern, available = by_room[room].popitem()
                each = min(room // length, number)
                used = min(available, number // each)
                if available > used:
                    by_room[room][pattern] = available - used
                if not by_room[room]:
                    del by_room[room]
                    rooms.pop(at)
                new = [(pattern + (length,) * each, used)]
                number -= each * used
            for pattern, times in new:
                room = capacity - sum(pattern)
                if room not in by_room:
                    insort(rooms, room)
                keep(pattern, times)
    return [(p, n) for room in sorted(by_room) for p, n in by_room[room].items()]


_SLOTS = (
    T.StructType()
    .add("length", "long")
    .add("from_rank", "long")
    .add("to_rank", "long")
    .add("sequence", "long")
    .add("per_sequence", "long")
    .add("offset", "long")
)


def slots(packed: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, ...]]:
    """Where the pieces of each length go, by their rank among them: a row for each length of a
    pattern.

    The pieces of ranks from_rank to to_rank fill the pattern's sequences in order, per_sequence in
    each, side by side from offset.
    """
    rows, used, sequence = [], {}, 0
    for pattern, number in packed:
        offset = 0
        for length in sorted(set(pattern), reverse=True):
            each = pattern.count(length)
            start = used.get(length, 0)
            used[length] = start + each * number
            rows.append((length, start, used[length], sequence, each, offset))
            offset += each * length
        sequence += number
    return rows


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    pieces = stored(spark, tokenized(docs, tokenizer, capacity, end_id), "pieces")
    # At most capacity rows for each task of the first step; at most capacity rows in all.
    tasks = pieces.groupBy("length", "task").count()
    totals = tasks.groupBy("length").agg(F.sum("count").alias("n"))
    counts = {r["length"]: r["n"] for r in totals.collect()}
    places = spark.createDataFrame(slots(patterns(counts, capacity)), _SLOTS)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(
        spark,
        tasks.select("length", "task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")),
        "pieces-before",
    )
    ranked = pieces.join(broadcast_if_small(bases, 32), ["task", "length"]).withColumn(
        "rank", F.col("base") + F.col("nth")
    )
    # A row for each length of a pattern: their number is bounded by the capacity, not by the data.
    rank = F.col("rank")
    found = ranked.join(
        F.broadcast(places.withColumnRenamed("length", "of")),
        (F.col("length") == F.col("of")) & (rank >= F.col("from_rank")) & (rank < F.col("to_rank")),
    )
    nth, each = rank - F.col("from_rank"), F.col("per_sequence")
    return found.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + ((nth - nth % each) / each).cast("bigint")).alias("sequence_id"),
        (F.col("offset") + nth % each * F.col("length")).alias("offset"),
    )
