"""Near-duplicate documents: ProbMinHash of weighted word shingles, banding, verification.

A document is the multiset of its runs of five words; a shingle that comes n times weighs 1 + ln n.
Each shingle is a Poisson process with its weight as rate, whose arrivals go to random registers; a
register keeps the shingle that arrives first. Arrivals are drawn in rounds and a shingle stops as
soon as it can come first nowhere any more. Two registers agree with the probability Jaccard
similarity of the documents, which is the plain Jaccard similarity where all weights are equal.
Bands of registers give candidates, and each link is verified on the shingles themselves.

Copies of a text are one node. Within a bucket, members are held against a centre or two, and
against each other only where that leaves them in different classes and what only few texts hold
does not rule the link out. So a bucket of near copies costs about as many checks as it has members,
and no link is lost: what is not checked is connected already, or cannot be one.

Defined results: a NULL text or one without words is a class of its own; a text of fewer than five
words has itself as its single shingle; a class has the least doc_id of its documents as its id, and
that document stays; of repeated rows one stays; documents without id have a class of their text
alone. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from xxhash import xxh3_64_intdigest

from .common import broadcast_if_small, passing_tables, pieces_of, stored
from .components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 16
ROWS = 4
#: A shingle that so few texts hold is looked up at its holders. Any number gives the same links.
RARE = 24
#: Buckets of so few members are held against each other outright. Any number gives the same links.
SMALL = 16
PIECE_CHARS = 1 << 20

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxh3_64_intdigest(word)
        return value


def shingled(texts: list[str | None], size: int = SHINGLE) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text: its shingles (sorted hashes) and how often each comes."""
    words = _Words()
    out = []
    for text in texts:
        split = (text or "").split()
        n = len(split)
        found = np.fromiter(map(words.__getitem__, split), np.uint64, n)
        if n:
            width = min(size, n)
            run = np.full(n - width + 1, width, np.uint64)
            for j in range(width):
                run = _mixed(run * _FACTOR + found[j : j + len(run)])
            found = run
        out.append(np.unique(found, return_counts=True))
    return out


def weights(counts: np.ndarray) -> np.ndarray:
    return 1 + np.log(counts)


def registers(shingles: list[tuple[np.ndarray, np.ndarray]], number: int) -> np.ndarray:
    """The shingle that arrives first in each register of each text; zeros for texts without any."""
    n_texts = len(shingles)
    element = np.concatenate([s for s, _ in shingles] or [np.zeros(0, np.uint64)])
    rate = weights(np.concatenate([c for _, c in shingles] or [np.ones(0)]))
    owner = np.repeat(np.arange(n_texts), [len(s) for s, _ in shingles])
    first = np.full(n_texts * number, np.inf)
    winner = np.zeros(n_texts * number, np.uint64)
    time = np.zeros(len(element))
    turn = 0
    while len(element):
        turn += 1
        drawn = _mixed(element + np.uint64(turn * int(_FACTOR) % 2**64))
        # 52 bits make the waiting time, never zero; another mix picks the register
        time = time - np.log(((drawn >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52) / rate
        place = owner * number + (_mixed(drawn + _FACTOR) % np.uint64(number)).astype(np.int64)
        np.minimum.at(first, place, time)
        won = time == first[place]
        winner[place[won]] = element[won]
        latest = first.reshape(n_texts, number).max(1)
        going = time < latest[owner]
        element, rate, owner, time = element[going], rate[going], owner[going], time[going]
    return winner.reshape(n_texts, number)


def bands(signatures: np.ndarray, n_bands: int, n_rows: int) -> np.ndarray:
    """A hash for each band, different from band to band."""
    out = np.tile(np.arange(1, n_bands + 1, dtype=np.uint64), (len(signatures), 1))
    cut = signatures.reshape(len(signatures), n_bands, n_rows)
    for row in range(n_rows):
        out = _mixed(out * _FACTOR + cut[:, :, row])
    return out.view(np.int64)


def similarity(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> float:
    """Probability Jaccard similarity of two weighted sets: sorted elements and how often each comes."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    if len(a) == n.sum() and len(b) == m.sum():
        return len(i) / (len(a) + len(b) - len(i))
    u, v = weights(n), weights(m)
    x, y = u[i], v[j]
    # sum over k of max(u_k / x, v_k / y): the shared ones turn from the one to the other where v_k / u_k passes y / x
    order = np.argsort(y / x, kind="stable")
    x, y = x[order], y[order]
    ratio = y / x
    by_u = np.concatenate([[0.0], np.cumsum(x)])
    by_v = np.concatenate([np.cumsum(y[::-1])[::-1], [0.0]])
    turn = np.searchsorted(ratio, ratio, "right")
    total = (u.sum() - x.sum() + by_u[turn]) / x + (v.sum() - y.sum() + by_v[turn]) / y
    return float((1 / total).sum())


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key"))


def signed(docs: DataFrame, size: int, n_bands: int, n_rows: int) -> DataFrame:
    """doc_id, key (a hash of the text) and the hashes of its bands, none for texts without words."""
    rows = _keyed(docs)
    schema = T.StructType([rows.schema["doc_id"], rows.schema["key"]]).add(
        "bands", T.ArrayType(T.LongType())
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces_of(batches, "text", PIECE_CHARS):
            found = shingled(piece.column("text").to_pylist(), size)
            signs = bands(registers(found, n_bands * n_rows), n_bands, n_rows)
            lists = [s if len(f[0]) else None for s, f in zip(signs, found)]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("key"), pa.array(lists, arrow.field("bands").type)],
                schema=arrow,
            )

    return rows.mapInArrow(run, schema)


_SETS = (
    T.StructType()
    .add("node", "binary")
    .add("shingles", T.ArrayType(T.LongType()))
    .add("counts", T.ArrayType(T.IntegerType()))
)


def _sets(rows: DataFrame, size: int) -> DataFrame:
    """node and its shingles."""
    arrow = to_arrow_schema(_SETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces_of(batches, "text", PIECE_CHARS):
            found = shingled(piece.column("text").to_pylist(), size)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("key"),
                    pa.array([s.view(np.int64) for s, _ in found], arrow.field("shingles").type),
                    pa.array([c for _, c in found], arrow.field("counts").type),
                ],
                schema=arrow,
            )

    return rows.select("key", "text").mapInArrow(run, _SETS)


_PAIR = T.StructType().add("a", "binary").add("b", "binary").add("similarity", "double")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, similarity) of each pair. Elements come to the pairs by two joins."""
    arrow = to_arrow_schema(_PAIR)
    rows = pairs.join(sets.toDF("a", "s", "n"), "a").join(sets.toDF("b", "t", "m"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, n, t, m = (batch.column(c) for c in "sntm")
            found = [
                similarity(*(np.asarray(c[i].values).view(k) for c, k in ((s, "u8"), (n, "i4"), (t, "u8"), (m, "i4"))))
                for i in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], schema=arrow
            )

    return rows.select("a", "b", "s", "n", "t", "m").mapInArrow(run, _PAIR)


def _ordered(a: str, b: str):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def _rare_shingles(sets: DataFrame, rare: int) -> DataFrame:
    """(shingle, node, weight, holders) of the shingles that so few nodes hold."""
    spark = sets.sparkSession
    every = sets.select("node", F.explode(F.arrays_zip("shingles", "counts")).alias("s")).select(
        "node", F.col("s.shingles").alias("shingle"), (1 + F.log("s.counts")).alias("weight")
    )
    few = every.groupBy("shingle").agg(F.count("*").alias("holders")).where(F.col("holders") <= rare)
    few = stored(spark, few, "near-rare")
    return stored(spark, every.join(broadcast_if_small(few, 24), "shingle"), "near-rare")


def _common_parts(sets: DataFrame, held: DataFrame) -> DataFrame:
    """Of each node: size, whether no shingle repeats (plain), and what is not rare, as number and
    share of weight.
    """
    rare = held.groupBy("node").agg(F.count("*").alias("rare"), F.sum("weight").alias("rare_weight"))
    whole = sets.select(
        "node",
        F.size("shingles").alias("size"),
        F.aggregate("counts", F.lit(0.0), lambda total, n: total + 1 + F.log(n)).alias("weight"),
        F.forall("counts", lambda n: n == 1).alias("plain"),
    )
    return whole.join(rare, "node", "left").select(
        "node",
        "size",
        "weight",
        "plain",
        (F.col("size") - F.coalesce("rare", F.lit(0))).alias("common"),
        (1 - F.coalesce("rare_weight", F.lit(0.0)) / F.col("weight")).alias("share"),
    )


def _could_reach(threshold: float):
    """Whether a node and an other one could be so similar, going by the rare shingles that both
    have.

    Of what is rare they share shared pieces, of weight shared_weight and other_shared_weight to
    each, and of the rest at most what is common in either. Their similarity is at most the share of
    that in either, and where no shingle repeats, at most that out of all that the two would then
    have.
    """
    least = threshold - 1e-9
    both = F.least("common", "other_common") + F.col("shared")
    return (
        (F.col("share") + F.col("shared_weight") / F.col("weight") >= least)
        & (F.col("other_share") + F.col("other_shared_weight") / F.col("other_weight") >= least)
        & (
            ~(F.col("plain") & F.col("other_plain"))
            | (both >= least * (F.col("size") + F.col("other_size") - both))
        )
    )


def _other(rows: DataFrame, *shared: str) -> DataFrame:
    """The rows under the names of the other side of a pair."""
    names = {c: f"other_{c}" for c in rows.columns if c not in shared} | {"node": "other"}
    return rows.withColumnsRenamed(names)


def _small_pairs(rows: DataFrame) -> DataFrame:
    """(node, other) of rows (bucket, node, label) in different classes, all of each bucket."""
    return (
        rows.join(_other(rows, "bucket"), "bucket")
        .where("node < other AND label <> other_label")
        .select("node", "other")
    )


def _large_pairs(rows: DataFrame, held: DataFrame, parts: DataFrame, threshold: float) -> DataFrame:
    """(node, other) of rows (bucket, node, label) that are in different classes and could be a
    link.

    Two similar nodes share rare shingles, or each has enough that is common. The first kind is met
    at the few holders of a shingle, and the second kind in its buckets.
    """
    spark = rows.sparkSession
    nodes = stored(spark, rows.select("node", "label").distinct(), "near-open-nodes")
    parts = stored(spark, parts.join(broadcast_if_small(nodes, 80), "node"), "near-parts")
    parts_known = broadcast_if_small(parts, 120)
    meeting = held.where("holders > 1").select("shingle", "node", F.col("weight").alias("of_shingle"))
    by_shingle = (
        meeting.join(_other(meeting, "shingle"), "shingle")
        .where("node < other")
        .groupBy("node", "other")
        .agg(
            F.count("*").alias("shared"),
            F.sum("of_shingle").alias("shared_weight"),
            F.sum("other_of_shingle").alias("other_shared_weight"),
        )
        .join(parts_known, "node")
        .join(broadcast_if_small(_other(parts), 120), "other")
        .where(F.col("label") != F.col("other_label"))
        .where(_could_reach(threshold))
    )
    enough = parts.where(F.col("share") >= threshold - 1e-9)
    mates = stored(spark, rows.drop("label").join(broadcast_if_small(enough, 120), "node"), "near-mates")
    by_bucket = (
        mates.withColumns({"shared": F.lit(0), "shared_weight": F.lit(0.0), "other_shared_weight": F.lit(0.0)})
        .join(_other(mates, "bucket"), "bucket")
        .where(
            (F.col("node") < F.col("other"))
            & (F.col("label") != F.col("other_label"))
            & _could_reach(threshold)
        )
    )
    return by_shingle.select("node", "other").unionByName(by_bucket.select("node", "other"))


def _opened(rows: DataFrame, *more) -> DataFrame:
    """The buckets of rows (bucket, node, label) that hold more than one class."""
    return (
        rows.groupBy("bucket")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("members"), *more)
        .where("low <> high")
    )


def _parts_of_large(rows: DataFrame, sets: DataFrame, rare: int) -> tuple[DataFrame, DataFrame]:
    """Rare shingles and common parts of the nodes in large open buckets."""
    spark = rows.sparkSession
    large = stored(spark, _opened(rows).where(F.col("members") > SMALL).select("bucket"), "near-large")
    nodes = rows.join(broadcast_if_small(large, 16), "bucket", "left_semi").select("node").distinct()
    nodes = broadcast_if_small(stored(spark, nodes, "near-large-nodes"), 40)
    sets = sets.join(nodes, "node", "left_semi").dropDuplicates(["node"])
    held = _rare_shingles(sets, rare)
    return held, stored(spark, _common_parts(sets, held), "near-parts")


def linked(members: DataFrame, sets: DataFrame, threshold: float, rare: int = RARE) -> DataFrame:
    """Links (a, b) that connect the nodes of members (bucket, node, mates) as all links between
    bucket mates would.

    First each bucket's members are held against the one with most mates in all, then against the
    one with the least that only few texts hold, if they are not in its class yet. What is then in
    different classes of a bucket is held against each other, unless what only few texts hold rules
    the link out.
    """
    spark = members.sparkSession
    degrees = members.groupBy("node").agg(F.sum("mates").alias("degree"))
    members = stored(spark, members.join(degrees, "node").drop("mates"), "near-members")
    links = checked = held = parts = None
    for turn in range(3):
        if links is None:
            rows = members.withColumn("label", F.col("node"))
        else:
            labels = broadcast_if_small(components(links), 64)
            rows = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
            rows = stored(spark, rows, "near-members")
        if turn == 1:
            held, parts = _parts_of_large(rows, sets, rare)
            rows = rows.join(broadcast_if_small(parts.select("node", "share"), 48), "node", "left")
        rank = {0: -F.col("degree"), 1: F.coalesce(-F.col("share"), F.lit(0.0))}.get(turn, F.lit(0))
        open_buckets = _opened(
            rows, F.min(F.struct(rank, F.xxhash64("node", F.lit(turn)), "node", "label")).alias("centre")
        ).select(
            "bucket",
            "members",
            F.col("centre.node").alias("other"),
            F.col("centre.label").alias("other_label"),
        )
        open_buckets = broadcast_if_small(stored(spark, open_buckets, "near-centres"), 80)
        if turn < 2:
            mates = rows.join(open_buckets, "bucket").where("label <> other_label")
        else:
            rows = rows.join(open_buckets.select("bucket", "members"), "bucket")
            rows = stored(spark, rows.select("bucket", "node", "label", "members"), "near-open")
            few = F.col("members") <= SMALL
            mates = _small_pairs(rows.where(few).drop("members")).unionByName(
                _large_pairs(rows.where(~few).drop("members"), held, parts, threshold)
            )
        pairs = mates.select(*_ordered("node", "other")).distinct()
        if checked is not None:
            pairs = pairs.join(checked.select("a", "b"), ["a", "b"], "left_anti")
        seen = stored(spark, _verified(stored(spark, pairs, "near-pairs"), sets), "near-checked")
        checked = seen if checked is None else checked.unionByName(seen)
        links = checked.where(F.col("similarity") >= threshold)
    return links


def classes(
    docs: DataFrame,
    *,
    threshold: float = SIMILARITY,
    size: int = SHINGLE,
    n_bands: int = BANDS,
    n_rows: int = ROWS,
) -> DataFrame:
    """doc_id, key, class_id and kept (whether it is the document of its class that stays), per row
    of docs.
    """
    spark = docs.sparkSession
    signs = stored(spark, signed(docs, size, n_bands, n_rows), "near-signed", keep=True)
    with passing_tables(spark):
        found = stored(
            spark, _node_classes(docs, signs, threshold, size), "near-classes", keep=True
        )
    return (
        signs.select("doc_id", "key", F.col("bands").isNull().alias("bare"))
        .join(broadcast_if_small(found.withColumnRenamed("node", "key"), 64), "key", "left")
        .select(
            "doc_id",
            "key",
            F.when(F.col("bare"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))
    )


def _node_classes(docs: DataFrame, signs: DataFrame, threshold: float, size: int) -> DataFrame:
    """(node, class_id) of each different text."""
    spark = docs.sparkSession
    nodes = stored(
        spark,
        signs.where("bands IS NOT NULL")
        .groupBy(F.col("key").alias("node"))
        .agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands")),
        "near-nodes",
    )
    exploded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = stored(
        spark, exploded.groupBy("bucket").agg(F.count("*").alias("mates")).where("mates > 1"), "near-buckets"
    )
    members = stored(spark, exploded.join(broadcast_if_small(shared, 24), "bucket"), "near-members")
    # The texts of those nodes alone are read again.
    wanted = stored(
        spark,
        nodes.join(members.select("node").distinct(), "node", "left_semi").select("doc_id", "node"),
        "near-wanted",
    )
    texts = _keyed(docs)
    texts = texts.join(
        broadcast_if_small(wanted.withColumnRenamed("doc_id", "id"), 40),
        F.col("key").eqNullSafe(F.col("node")) & F.col("doc_id").eqNullSafe(F.col("id")),
    )
    sets = stored(spark, _sets(texts, size), "near-sets")
    links = linked(members, sets, threshold)
    least = nodes.select("node", "doc_id")
    labels = components(links)
    named = (
        least.join(broadcast_if_small(labels, 64), "node")
        .groupBy("label")
        .agg(F.min("doc_id").alias("class_id"))
    )
    renamed = stored(spark, labels.join(named, "label").select("node", "class_id"), "near-named")
    return least.join(broadcast_if_small(renamed, 64), "node", "left").select(
        "node", F.coalesce("class_id", "doc_id").alias("class_id")
    )


def report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: its class, and whether it stays."""
    return classes(docs, **options).select("doc_id", "class_id", "kept")


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """docs, all columns, with one document of each class."""
    spark = docs.sparkSession
    found = stored(spark, classes(docs, **options), "near-found")
    rows = docs.withColumn("__key", F.unhex(F.md5(F.coalesce("text", F.lit("")))))

    def same(other: DataFrame):
        return F.col("__key").eqNullSafe(other["k"]) & F.col("doc_id").eqNullSafe(other["i"])

    def named(chosen: DataFrame, name: str) -> DataFrame:
        chosen = chosen.select(F.col("key").alias("k"), F.col("doc_id").alias("i"))
        return broadcast_if_small(stored(spark, chosen, name), 40)

    gone = named(found.where("NOT kept").select("key", "doc_id").distinct(), "near-gone")
    rows = rows.join(gone, same(gone), "left_anti")
    repeated = found.where("kept").groupBy("key", "doc_id").count().where("count > 1")
    if not repeated.isEmpty():
        again = named(repeated, "near-repeated")
        once = rows.join(again, same(again), "left_semi").dropDuplicates(["doc_id", "__key"])
        rows = rows.join(again, same(again), "left_anti").unionByName(once)
    return rows.select(docs.columns)
