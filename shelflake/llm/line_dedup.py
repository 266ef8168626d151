"""Line dedup: an edit-distance join by segments.

Lines that differ by few edits are the same line: one edit for every ten characters of the shorter one,
and no more than max_edits. Shorter lines are the same if they are equal. Of each class of lines the first
one stays: the one of the least doc_id, and then the least place in its text. Lines of under
MIN_REMOVED characters always stay; their classes are told all the same.

Two lines within d edits share one of the d + 1 segments of the shorter one, at nearly the same
place. So each line is indexed by its segments, under its length, and probes the indexes of its own
and all shorter lengths that are near enough with the substrings at which a segment could stand.
Candidates are verified by banded bit-parallel edit distance.

Equal lines are one line before any of this, so that a line that is copied everywhere is joined
once. Texts stay where they are: only hashes are shuffled, and the lines of candidates are fetched
from their documents.

Defined results: a NULL or empty text is one blank line; blank lines (of white space only) are of a class
of their own and always stay; repeated rows (of the same id and text) are one document and give
repeated results; rows without id come last. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from xxhash import xxh3_128_digest

from .common import broadcast_if_small, passing_tables, pieces_of, stored
from .components import components

MAX_EDITS = 2
#: Characters of a line for each edit that it may differ by.
CHARS_PER_EDIT = 10
#: Repeats of shorter lines are left in their texts.
MIN_REMOVED = 20
#: A document goes if it had more than so many characters for each one that is left. It was the copy of others.
MOST_LOST = 10
PIECE_CHARS = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

# --- edit distance -----------------------------------------------------------


def budget(lengths: np.ndarray, edits: int) -> np.ndarray:
    """The edits by which lines of these lengths may differ from longer ones."""
    return np.minimum(lengths // CHARS_PER_EDIT, edits)


def near(a: list[str], b: list[str], edits: int) -> np.ndarray:
    """Whether each pair is within the edits that its shorter line allows."""
    allowed = budget(np.array([min(len(x), len(y)) for x, y in zip(a, b)], np.int64), edits)
    result = np.zeros(len(a), bool)
    for limit in range(1, edits + 1):
        rows = np.flatnonzero(allowed == limit)
        result[rows] = within_edits([a[i] for i in rows], [b[i] for i in rows], limit)
    return result


def within_edits(a: list[str], b: list[str], limit: int) -> np.ndarray:
    """Whether the edit distance of each pair is at most limit, for all pairs side by side.

    Each pair has a word of 2 * limit + 1 bits, one for each diagonal of the band; a step takes all
    pairs a column further. Bit k of column j stands for row j - limit + k.
    """
    m, n = np.array([len(s) for s in a]), np.array([len(s) for s in b])
    rows = np.flatnonzero(np.abs(m - n) <= limit)
    result = np.zeros(len(a), bool)
    order = rows[np.argsort(n[rows], kind="stable")]
    for at in range(0, len(order), 2048):
        part = order[at : at + 2048]
        result[part] = _distances([a[i] for i in part], [b[i] for i in part], limit) <= limit
    return result


def _codes(texts: list[str], width: int, left: int, fill: int) -> np.ndarray:
    out = np.full((len(texts), width), fill, np.int64)
    for row, text in zip(out, texts):
        row[left : left + len(text)] = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return out


def _distances(a: list[str], b: list[str], limit: int) -> np.ndarray:
    # A common beginning changes no distance and makes every text longer than the band.
    a, b = [" " * limit + s for s in a], [" " * limit + s for s in b]
    m, n = np.array([len(s) for s in a]), np.array([len(s) for s in b])
    columns, band = int(n.max()), 2 * limit + 1
    x = _codes(a, columns + 2 * band, limit, -1).T.copy()  # row i - 1 of a stands at limit + i - 1
    y = _codes(b, columns, 0, -2).T.copy()
    full = np.uint64((1 << band) - 1)
    one, top = np.uint64(1), np.uint64(1 << (band - 1))
    vp = np.full(len(a), int(full) & ~((1 << limit) - 1), np.uint64)
    vn = np.zeros(len(a), np.uint64)
    distance = np.full(len(a), limit)
    for j in range(1, columns + 1):
        match = np.zeros(len(a), np.uint64)
        for k in range(band):
            match |= (x[j - 1 + k] == y[j - 1]).astype(np.uint64) << np.uint64(k)
        d0 = ((((match & vp) + vp) ^ vp) | match | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        down = j <= m - limit
        along = ~down & (j <= n)
        distance += down & ((d0 & top) == 0)
        place = np.clip(m - j + limit, 0, band).astype(np.uint64)
        distance += np.where(along, (hp >> place) & one, 0).astype(np.int64)
        distance -= np.where(along, (hn >> place) & one, 0).astype(np.int64)
        shifted = d0 >> one
        vp = (hn | ~(shifted | hp)) & full
        vn = shifted & hp
    return distance


# --- segments ----------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Substrings:
    """Hashes of any substrings of some lines, from the hashes of their beginnings. No line is empty."""

    def __init__(self, lines: list[str]) -> None:
        self.length = np.array([len(s) for s in lines], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]]).astype(np.int64)
        codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        self.codes = codes
        powers = np.full(len(codes) + 1, _BASE, np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        self.begun = np.concatenate([[np.uint64(0)], np.cumsum((codes + np.uint64(1)) * powers[:-1])])
        self.undo = np.full(len(codes) + 1, _BASE_INVERSE, np.uint64)
        self.undo[0] = 1
        np.cumprod(self.undo, out=self.undo)

    def sketches(self) -> np.ndarray:
        """64 bits of each line: the parities of how often its characters, and pairs of them, fall
        in 32 buckets each.

        An edit changes two characters at most, and four pairs.
        """
        single = np.uint64(1) << (_mixed(self.codes) & np.uint64(31))
        pair = _mixed(self.codes[:-1] * np.uint64(_BASE) + self.codes[1:])
        pair = np.append(np.uint64(1) << ((pair & np.uint64(31)) + np.uint64(32)), np.uint64(0))
        pair[self.start + self.length - 1] = 0  # reaches into the next line
        return np.bitwise_xor.reduceat(single ^ pair, self.start).view(np.int64)

    def keys(self, which: np.ndarray, place: np.ndarray, size: np.ndarray, of: np.ndarray, nth: int) -> np.ndarray:
        """Of the substrings of `size` at `place`: keys of segment nth of lines of length `of`."""
        begin = self.start[which] + place
        value = (self.begun[begin + size] - self.begun[begin]) * self.undo[begin]
        return _mixed(_mixed(value) + of.astype(np.uint64) * np.uint64(64) + np.uint64(nth)).view(np.int64)


def segments(lengths: np.ndarray, nth: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of segment nth of lines of these lengths: edits + 1 of them, the longer ones
    last.
    """
    size, longer = np.divmod(lengths, edits + 1)
    first_longer = edits + 1 - longer
    start = nth * size + np.maximum(0, nth - first_longer)
    return start, size + (nth >= first_longer)


def index_keys(lines: Substrings, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of the segments of each line."""
    found = []
    for allowed in range(1, edits + 1):
        which = np.flatnonzero(budget(lines.length, edits) == allowed)
        of = lines.length[which]
        for nth in range(allowed + 1):
            start, size = segments(of, nth, allowed)
            found.append((which, lines.keys(which, start, size, of, nth)))
    return tuple(map(np.concatenate, zip(*found)))


def probe_keys(lines: Substrings, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of the substrings at which a segment of a near line, as long or shorter, could stand.

    A segment is moved by no more edits than fit before it, and none more than fit behind it.
    """
    found = []
    for allowed, shorter in ((d, k) for d in range(1, edits + 1) for k in range(d + 1)):
        which = np.flatnonzero(budget(lines.length - shorter, edits) == allowed)
        of = lines.length[which] - shorter
        for nth in range(allowed + 1):
            start, size = segments(of, nth, allowed)
            low = max(-nth, shorter - (allowed - nth))
            high = min(nth, shorter + (allowed - nth))
            for move in range(low, high + 1):
                place = start + move
                fits = (place >= 0) & (place + size <= lines.length[which])
                found.append(
                    (which[fits], lines.keys(which[fits], place[fits], size[fits], of[fits], nth))
                )
    return tuple(map(np.concatenate, zip(*found)))


# --- the join ----------------------------------------------------------------


def _row() -> Column:
    """Names a row by its id and text: 128 bits, so that two rows do not share a name by chance."""
    named = F.coalesce(F.concat(F.col("doc_id").cast("string"), F.lit("\x01")), F.lit("\x02"))
    return F.unhex(F.md5(F.concat(named, F.coalesce(F.concat(F.lit("\x01"), "text"), F.lit("\x02")))))


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and the name of the row."""
    return docs.select("doc_id", "text", _row().alias("row"))


def _lines(text: str | None) -> list[str]:
    return (text or "").split("\n")


_BLANK = " \t\n\v\f\r"


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, row, line_no, chars, hash (node) and the beginning of the hash (line) of each line.

    Blank lines have no hash.
    """
    rows = _rows(docs)
    schema = T.StructType([rows.schema["doc_id"]]).add("row", "binary").add("line_no", "integer")
    schema = schema.add("chars", "integer").add("node", "binary").add("line", "long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces_of(batches, "text", PIECE_CHARS):
            owner, number, chars, node = [], [], [], []
            for i, text in enumerate(piece.column("text").to_pylist()):
                for k, line in enumerate(_lines(text)):
                    owner.append(i)
                    number.append(k)
                    chars.append(len(line))
                    blank = not line.strip(_BLANK)
                    node.append(None if blank else xxh3_128_digest(line.encode("utf-8", "surrogatepass")))
            own = pa.array(owner, pa.int32())
            heads = [None if n is None else int.from_bytes(n[:8], "little", signed=True) for n in node]
            columns = [
                piece.column("doc_id").take(own),
                piece.column("row").take(own),
                *(pa.array(c, f.type) for c, f in zip((number, chars, node, heads), list(arrow)[2:])),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return rows.mapInArrow(run, schema)


def _heads(nodes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(n[:8] for n in nodes), "<i8")


def _with_numbers(docs: DataFrame, numbers: DataFrame, how: str) -> DataFrame:
    """The rows of docs with the line numbers that numbers (row, line_no) has of them."""
    lists = stored(
        docs.sparkSession,
        numbers.groupBy("row").agg(F.collect_set("line_no").alias("numbers")),
        "line-numbers",
    )
    total = lists.agg(F.sum(F.size("numbers"))).first()[0] or 0
    # Ids and numbers together are what a broadcast would hold.
    per_row = 48 + 8 * total // max(1, lists.count())
    return _rows(docs).join(broadcast_if_small(lists, per_row), "row", how)


_KEYED = T.StructType().add("key", "long").add("line", "long").add("sketch", "long")


def _keyed(docs: DataFrame, keys_of, edits: int) -> DataFrame:
    """(key, line, sketch) of the lines of docs (text, numbers: those to leave out). line begins the
    node's hash.
    """
    arrow = to_arrow_schema(_KEYED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces_of(batches, "text", PIECE_CHARS):
            lines = []
            for text, skip in zip(piece.column("text").to_pylist(), piece.column("numbers").to_pylist()):
                skip = set(skip or ())
                lines += [
                    line
                    for k, line in enumerate(_lines(text))
                    if len(line) >= CHARS_PER_EDIT and k not in skip and line.strip(_BLANK)
                ]
            if not lines:
                continue
            names = _heads([xxh3_128_digest(s.encode("utf-8", "surrogatepass")) for s in lines])
            substrings = Substrings(lines)
            which, keys = keys_of(substrings, edits)
            columns = [keys, names[which], substrings.sketches()[which]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), schema=arrow)

    return docs.select("text", "numbers").mapInArrow(run, _KEYED)


_LINE = T.StructType().add("line", "long").add("node", "binary").add("content", "string")


def _contents(docs: DataFrame) -> DataFrame:
    """The lines of docs (text, numbers: those wanted)."""
    arrow = to_arrow_schema(_LINE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces_of(batches, "text", PIECE_CHARS):
            found = []
            for text, numbers in zip(piece.column("text").to_pylist(), piece.column("numbers").to_pylist()):
                lines = _lines(text)
                found += [lines[k] for k in numbers]
            nodes = [xxh3_128_digest(s.encode("utf-8", "surrogatepass")) for s in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_heads(nodes)), pa.array(nodes, pa.binary()), pa.array(found, pa.string())], schema=arrow
            )

    return docs.select("text", "numbers").mapInArrow(run, _LINE)


_LINK = T.StructType().add("a", "binary").add("b", "binary")


def _verified(pairs: DataFrame, edits: int) -> DataFrame:
    arrow = to_arrow_schema(_LINK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces_of(batches, "x", PIECE_CHARS):
            held = pa.array(near(piece.column("x").to_pylist(), piece.column("y").to_pylist(), edits))
            yield pa.RecordBatch.from_arrays(
                [piece.column("a").filter(held), piece.column("b").filter(held)], schema=arrow
            )

    return pairs.select("a", "b", "x", "y").mapInArrow(run, _LINK)


def _place() -> Column:
    """Sorts the occurrences of a line: rows without id last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "line_no")


def line_classes(docs: DataFrame, edits: int = MAX_EDITS) -> tuple[DataFrame, DataFrame]:
    """All occurrences of lines, and for lines that come more than once or have links: first (of the
    class), n_links.
    """
    spark = docs.sparkSession
    found = stored(spark, occurrences(docs), "lines", keep=True)
    with passing_tables(spark):
        classes = stored(spark, _classes(docs, found, edits), "line-classes", keep=True)
    return found, classes


def _classes(docs: DataFrame, found: DataFrame, edits: int) -> DataFrame:
    """(node, class, n_links) of the lines that come more than once or have links."""
    spark = docs.sparkSession
    lines = stored(
        spark,
        found.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.min(_place()).alias("first"), F.first("line").alias("line"), F.count("*").alias("n")),
        "line-firsts",
    )
    repeated = lines.where("n > 1").select("node", "first")
    copies = (
        found.join(broadcast_if_small(stored(spark, repeated, "lines-repeated"), 80), "node")
        .where("row <> first.row OR line_no <> first.line_no")
        .select("row", "line_no")
    )
    once = _with_numbers(docs, copies, "left")
    index = _keyed(once, index_keys, edits).toDF("key", "p", "sketch_p")
    probe = _keyed(once, probe_keys, edits).toDF("key", "q", "sketch_q")
    changed = F.col("sketch_p").bitwiseXOR(F.col("sketch_q"))
    singles = F.bit_count(changed.bitwiseAND(F.lit((1 << 32) - 1)))
    both = F.bit_count(F.shiftrightunsigned(changed, 32))
    pairs = stored(
        spark,
        index.join(probe, "key")
        .where((F.col("p") != F.col("q")) & (singles <= 2 * edits) & (both <= 4 * edits))
        .select(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"))
        .distinct(),
        "line-pairs",
    )
    wanted = stored(spark, pairs.select(F.explode(F.array("p", "q")).alias("line")).distinct(), "lines-wanted")
    located = lines.join(broadcast_if_small(wanted, 16), "line", "left_semi")
    contents = stored(
        spark,
        _contents(_with_numbers(docs, located.select("first.row", "first.line_no"), "inner")).distinct(),
        "line-contents",
    )
    links = stored(
        spark,
        _verified(
            pairs.join(contents.toDF("p", "a", "x"), "p").join(contents.toDF("q", "b", "y"), "q"), edits
        ),
        "line-links",
    )
    labels = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    marked = stored(
        spark,
        labels.join(degree, "node").join(lines.select("node", "first"), "node"),
        "line-labels",
    )
    firsts = marked.groupBy("label").agg(F.min("first").alias("class"))
    linked = marked.join(firsts, "label").select("node", "class", "n_links")
    alone = repeated.join(marked.select("node"), "node", "left_anti").select(
        "node", F.col("first").alias("class"), F.lit(0).cast("bigint").alias("n_links")
    )
    return linked.unionByName(alone)


def _decided(found: DataFrame, classes: DataFrame) -> DataFrame:
    """Each occurrence with the first one of its class."""
    return found.join(broadcast_if_small(classes, 96), "node", "left").select(
        "doc_id",
        "row",
        "line_no",
        F.coalesce("class.doc_id", F.when(F.col("class").isNull(), F.col("doc_id"))).alias("class_doc_id"),
        F.coalesce("class.line_no", "line_no").alias("class_line_no"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce(
            ((F.col("row") == F.col("class.row")) & (F.col("line_no") == F.col("class.line_no")))
            | (F.col("chars") < MIN_REMOVED),
            F.lit(True),
        ).alias("kept"),
    )


def report(docs: DataFrame, **options) -> DataFrame:
    """One row per line: its class, its links, and whether it stays.

    A class is named by its first line, as (class_doc_id, class_line_no). n_links counts the
    different lines near to it.
    """
    return _decided(*line_classes(docs, **options)).drop("row")


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """docs without the lines that do not stay, and without the documents that little remains of.

    A document goes with its lines if it had more than MOST_LOST characters for each that is left, or if blank
    lines only are: what is left of a copy is no document. n_chars, where docs has it, follows the text. Documents that
    lose no line stay.
    """
    found, classes = line_classes(docs, **options)
    gone = _decided(found, classes).where(~F.col("kept")).select("row", "line_no")
    lists = _with_numbers(docs, gone, "inner").select("row", "numbers").distinct()
    lists = stored(docs.sparkSession, lists, "lines-gone")
    total = lists.agg(F.sum(F.size("numbers"))).first()[0] or 0
    per_row = 48 + 8 * total // max(1, lists.count())
    kept = F.array_join(
        F.filter(F.split("text", "\n"), lambda line, k: ~F.array_contains("__numbers", k)), "\n"
    )
    rows = docs.withColumn("__row", _row()).join(
        broadcast_if_small(lists.toDF("__row", "__numbers"), per_row), "__row", "left"
    )
    changed = F.col("__numbers").isNotNull()
    rows = rows.withColumn("__before", F.char_length("text"))
    rows = rows.withColumn("text", F.when(changed, kept).otherwise(F.col("text")))
    enough = F.char_length("text") * MOST_LOST >= F.col("__before")
    rows = rows.where(~changed | (enough & F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))))
    if "n_chars" in docs.columns:
        size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(changed, size).otherwise(F.col("n_chars")))
    return rows.select(docs.columns)
