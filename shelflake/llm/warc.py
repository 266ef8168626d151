"""WARC archives: written by Spark's text sink, read back by boundary-chain verification.

Writing: a record is one string and the sink's line separator is the blank line that ends a record.
Payloads seen before become revisit records, which name the response and hold no payload.

Reading: the text source splits the archives at the magic line, wherever it stands. Each task emits,
for each magic it met, where the record that would begin there would end. Pointer jumping from the start
of each file keeps the records that a chain of ends reaches, so a magic inside a payload is never taken
for a record. Payloads that hold the magic are put together again from their parts.

Defined results: a NULL html is the empty payload; a NULL url is left out and read back as NULL; rows
that repeat the smallest page_id of a payload are all responses; rows without page_id get an id without
a number; an empty table gives an empty archive. Other columns are left alone.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import broadcast_if_small, passing_tables, pieces_of, stored

MAGIC = "WARC/1.0\r\n"
BLANK = "\r\n\r\n"
ID_PREFIX = "urn:shelflake:page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
PIECE_BYTES = 16 << 20
#: Stretch of a file whose records are looked at together when parts of payloads find their record.
STRETCH_BYTES = 64 << 20

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hex_digest: Column) -> Column:
    """Bare upper-case base32 of 40 hexadecimal digits: four letters for each five digits."""
    letters = []
    for i in range(8):
        number = F.conv(F.substring(hex_digest, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(number, shift).bitwiseAND(31) + 1
            letters.append(F.substring(F.lit(_BASE32), place, F.lit(1)))
    return F.concat(*letters)


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _safe(url: Column) -> Column:
    """Control characters and blanks would break the header; they are written as escapes."""
    safe = url
    for code in (*range(33), 127):
        safe = F.replace(safe, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return safe


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_archives(
    pages: DataFrame, path: str, *, date: str = "2024-01-01T00:00:00Z", min_revisit_bytes: int = 0
) -> None:
    """One record per row of pages (page_id, url, html), in as many archives as there are tasks."""
    rows = pages.select(
        "page_id",
        "url",
        F.coalesce("html", F.lit("")).alias("payload"),
        F.unhex(F.sha1(F.coalesce("html", F.lit("")).cast("binary"))).alias("digest"),
    )
    eligible = F.octet_length("payload") >= min_revisit_bytes
    firsts = stored(
        pages.sparkSession,
        rows.where(eligible)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_page"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first_page", F.lit(True).alias("shared")),
        "warc-firsts",
    )
    rows = rows.join(broadcast_if_small(firsts, 64), "digest", "left")
    revisit = (
        F.coalesce("shared", F.lit(False))
        & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    )
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        _line("Content-Length", F.octet_length("payload").cast("string")),
        F.lit("\r\n"),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", _safe(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.lower(F.hex("digest"))))),
        _line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("first_page")))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
    )
    (
        rows.select(head.alias("head"), block.alias("block"))
        .select(
            F.concat(
                "head", _line("Content-Length", F.octet_length("block").cast("string")), F.lit("\r\n"), "block"
            )
        )
        .write.option("lineSep", BLANK)
        .text(path)
    )


# --- reading -----------------------------------------------------------------

_FIELDS = (
    T.StructType()
    .add("record_type", "string")
    .add("record_id", "string")
    .add("target_uri", "string")
    .add("refers_to_id", "string")
    .add("stated_digest", "string")
    .add("payload_digest", "string")
    .add("payload_bytes", "long")
)
_CANDIDATE = T.StructType(
    [
        *T.StructType().add("file", "long").add("split", "long").add("place", "long"),
        # successor: bytes from the beginning of the record to the next one's; NULL for no record
        *T.StructType().add("size", "long").add("leading", "boolean").add("successor", "long"),
        *_FIELDS,
    ]
)

_HEADER = re.compile(rb"(?m)^([A-Za-z-]+):[ \t]*([^\r\n]*)\r?$")


def _headers(head: bytes) -> dict[bytes, bytes]:
    return {name.lower(): value for name, value in _HEADER.findall(head)}


def _extent(content: bytes) -> tuple[int, int] | None:
    """Where the block of a record begins and ends, counted from behind its magic."""
    end = content.find(b"\r\n\r\n")
    length = _headers(content[: end + 2]).get(b"content-length", b"") if end >= 0 else b""
    if not length.isdigit():
        return None
    return end + 4, end + 4 + int(length)


def _fields(content: bytes, begin: int, end: int) -> dict:
    """The record's own fields. content is whole."""
    head = _headers(content[:begin])
    block = content[begin:end]
    split = block.find(b"\r\n\r\n")
    payload = block[split + 4 :] if split >= 0 else block
    kind = head.get(b"warc-type", b"").decode("utf-8", "replace")
    text = {
        name: head[key].decode("utf-8", "replace") if key in head else None
        for name, key in (
            ("record_id", b"warc-record-id"),
            ("target_uri", b"warc-target-uri"),
            ("refers_to_id", b"warc-refers-to"),
            ("stated_digest", b"warc-payload-digest"),
        )
    }
    if text["stated_digest"]:
        text["stated_digest"] = text["stated_digest"].removeprefix("sha1:")
    if kind == "revisit":  # holds the response's HTTP headers, not its payload
        length = _headers(block).get(b"content-length", b"")
        size, digest = int(length) if length.isdigit() else None, text["stated_digest"]
    else:
        size = len(payload)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return {"record_type": kind, "payload_bytes": size, "payload_digest": digest, **text}


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """The archives' bytes, split at every magic. A file goes by the hash of its path."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.col("value").cast("binary").alias("value"),
            F.xxhash64(F.col("_metadata.file_path")).alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
        )
    )


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes]]:
    """Each chunk with the bytes of its split before it. A task reads its splits in order."""
    current, place = None, 0
    for batch in pieces_of(batches, "value", PIECE_BYTES):
        files, splits = batch.column("file").to_pylist(), batch.column("split").to_pylist()
        for file, split, value in zip(files, splits, batch.column("value")):
            if (file, split) != current:
                current, place = (file, split), 0
            value = value.as_py()
            yield file, split, place, value
            place += len(value) + len(MAGIC)


def _in_batches(rows: Iterator[dict], schema: pa.Schema, weight) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size > PIECE_BYTES or len(held) >= 10_000:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _emit_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        for file, split, place, value in _placed(batches):
            row = {"file": file, "split": split, "place": place, "size": len(value)}
            row["leading"] = split == 0 and place == 0  # what stands before the first magic
            extent = None if row["leading"] else _extent(value)
            if extent:
                row["successor"] = len(MAGIC) + extent[1] + len(BLANK)
                if extent[1] <= len(value):
                    row |= _fields(value, *extent)
            yield row

    yield from _in_batches(rows(), to_arrow_schema(_CANDIDATE), lambda row: 200)


def _emit_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("file", "split", "place", "value")
    yield from _in_batches(
        (dict(zip(names, row)) for row in _placed(batches)),
        to_arrow_schema(_PLACED),
        lambda row: len(row["value"]),
    )


_PLACED = T.StructType().add("file", "long").add("split", "long").add("place", "long").add("value", "binary")


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every place where the magic stands: at (its offset in the file), following (the successor's).

    The text source gives each byte to one row, so a split's place in its file is the sum of the
    rows before it.
    """
    found = stored(spark, _chunks(spark, path).mapInArrow(_emit_candidates, _CANDIDATE), "warc-candidates")
    splits = found.groupBy("file", "split").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = splits.select("file", "split", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    at = F.col("base") + F.col("place") - len(MAGIC)
    return found.join(bases, ["file", "split"]).where(~F.col("leading")).withColumns(
        {"at": at, "following": at + F.col("successor")}
    )


def reachable(spark: SparkSession, links: DataFrame) -> DataFrame:
    """The (file, at) that a chain of successors reaches from the start of the file.

    Each round doubles the jumps and, with them, the length of the chains marked so far. The table
    of a round is written to the shared folder, so that a lost executor costs one round at most.
    """
    state = stored(
        spark,
        links.select("file", "at", F.col("following").alias("jump"), (F.col("at") == 0).alias("reached")),
        "warc-jumps",
    )
    marked = state.where("reached").count()
    while marked:
        target = state.select("file", F.col("at").alias("jump"), F.col("jump").alias("next"))
        pushed = state.where("reached AND jump IS NOT NULL").select(
            "file", F.col("jump").alias("at"), F.lit(True).alias("pushed")
        ).distinct()
        state = stored(
            spark,
            state.join(target, ["file", "jump"], "left")
            .join(pushed, ["file", "at"], "left")
            .select(
                "file",
                "at",
                F.col("next").alias("jump"),
                (F.col("reached") | F.coalesce("pushed", F.lit(False))).alias("reached"),
            ),
            "warc-jumps",
        )
        before, marked = marked, state.where("reached").count()
        if marked == before:
            break
    return state.where("reached").select("file", "at")


def _owners(rows: DataFrame) -> DataFrame:
    """For each candidate that is no record, the record it lies in: the last one before it.

    Looked up within stretches of a file, and from stretch to stretch by one row each.
    """
    record = F.when(F.col("is_record"), F.col("at"))
    rows = rows.withColumn("stretch", F.floor(F.col("at") / STRETCH_BYTES))
    within = Window.partitionBy("file", "stretch").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy("file").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("file", "stretch").agg(F.max(record).alias("last")).select(
        "file", "stretch", F.max("last").over(across).alias("carried")
    )
    return rows.join(carried, ["file", "stretch"]).withColumn(
        "owner", F.coalesce(F.max(record).over(within), F.col("carried"))
    )


def _mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        for batch in pieces_of(batches, "content", PIECE_BYTES):
            for file, at, content in zip(*(batch.column(n) for n in ("file", "at", "content"))):
                content = content.as_py()
                yield {"file": file.as_py(), "at": at.as_py(), **_fields(content, *_extent(content))}

    yield from _in_batches(rows(), to_arrow_schema(_MENDED), lambda row: 200)


_MENDED = T.StructType([*T.StructType().add("file", "long").add("at", "long"), *_FIELDS])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records: file (a hash of its path), at (offset in it), and the fields of _FIELDS.

    payload_digest is taken from the payload itself; a revisit repeats the digest and length of the
    response.
    """
    with passing_tables(spark):
        found = candidates(spark, path)
        marks = reachable(spark, found).withColumn("is_record", F.lit(True))
        records = found.join(marks, ["file", "at"], "left").withColumn(
            "is_record", F.coalesce("is_record", F.lit(False))
        )
        records = stored(spark, records, "warc-records", keep=True)
    whole = records.where("is_record AND record_type IS NOT NULL")
    names = ["file", "at", *_FIELDS.names]
    if records.where("is_record AND record_type IS NULL").isEmpty():
        return whole.select(names)
    broken = (F.col("is_record") & F.col("record_type").isNull()).alias("broken")
    parts = _owners(records.select("file", "split", "place", "at", "is_record", broken))
    mine = parts.where("broken").select("file", F.col("at").alias("owner")).distinct()
    parts = parts.join(mine, ["file", "owner"]).select("file", "split", "place", "at", "owner")
    values = _chunks(spark, path).mapInArrow(_emit_values, _PLACED)
    content = (
        values.join(broadcast_if_small(stored(spark, parts, "warc-parts"), 400), ["file", "split", "place"])
        .groupBy("file", "owner")
        .agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts"))
        .select(
            "file",
            F.col("owner").alias("at"),
            F.aggregate(
                F.slice("parts", F.lit(2), F.size("parts")),
                F.col("parts")[0]["value"],
                lambda held, part: F.concat(held, F.lit(MAGIC).cast("binary"), part["value"]),
            ).alias("content"),
        )
    )
    return whole.select(names).unionByName(content.mapInArrow(_mend, _MENDED))


def _page(record_id: str) -> Column:
    number = F.regexp_extract(record_id, f"^<{ID_PREFIX}(-?[0-9]+)>$", 1)
    return F.when(number != "", number).cast("bigint")


def round_trip(pages: DataFrame, path: str, **options) -> DataFrame:
    """pages through archives at path: what each record says about its page."""
    write_archives(pages, path, **options)
    return read_archives(pages.sparkSession, path).select(
        _page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(F.col("record_type") == "revisit", _page("refers_to_id")).alias("refers_to"),
        (F.col("payload_digest") == F.col("stated_digest")).alias("digest_holds"),
        "target_uri",
    )
