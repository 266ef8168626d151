"""Ordinal quality classifier: cumulative-link regression on hashed text.

A document has one score, of two parts. Faults add up: the weights of the hashed words that speak
against a text, and of a few shape features, are summed. The rest is a tendency: every hashed word that the
sample knows has a weight of either sign, and their sum is divided by the square root of the number
of words, so that long texts do not outweigh short ones. Ordered thresholds cut the score into grades:
P(grade > k) = logistic(score - threshold k). All grades share the weights, so that a document's expected
grade and tail probabilities follow from its score.

Training takes a bounded sample of the labelled documents; scoring reads whole texts of all of them.
The faults are fitted first, by gradient steps with soft thresholding, which sets those of neutral words to
zero; the tendency is fitted to what they leave open.

Defined results: a NULL or empty text is scored by the weights of its shape alone; repeated rows
give repeated results; labels with a NULL grade or for unknown documents are not used, nor do they
take a place in the sample; a document labelled twice has its lower grade; of an id with several
texts one is learned, the first by its hash; without any labelled document all scores are equal and no
document is rejected. Other columns are left alone. Nothing but ids and the sample is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import pieces_of

#: At most so many labelled documents are fitted, by a hash of the id: each grade keeps its share, which the
#: probabilities follow. The only bound; all rows are scored.
SAMPLE_ROWS = 8000
#: A word has a weight only if so many texts of the sample hold it; rarer ones tell nothing of other texts.
MIN_TEXTS = 8
#: Words are hashed to so many numbers; the few above them stand for shapes of a text.
BUCKETS = (1 << 32) - 16
GRADES = 3
PIECE_CHARS = 1 << 20
BATCH = 256
#: A document is kept if it reaches the highest grade with this probability.
KEEP_AT = 0.5

_PREFIXES = (4, 5, 6)
_TRIM = b".,;:!?\"'()[]-"
_NOT_LETTERS = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122 or b >= 128))


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers: hashed words and beginnings of words, then a few shapes of
    the text.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    distinct = {w.strip(_TRIM).lower() for w in set(words)}
    grams = list(distinct)
    for size in _PREFIXES:
        grams += {b"^" + w[:size] for w in distinct if len(w) > size}
    hashes = np.fromiter(map(crc32, grams), np.int64, len(grams))
    n = max(1, len(words))
    letters = len(data.translate(None, _NOT_LETTERS))
    solid = max(1, len(data) - data.count(b" ") - data.count(b"\n"))
    upper = sum(map(bytes.isupper, words))
    lines = data.split(b"\n")
    shape = (
        min(3, 4 * upper // n),
        4 + min(3, int(10 * (1 - letters / solid))),
        8 + min(3, 4 * (len(lines) - len(set(lines))) // len(lines)),
        12 + min(3, int(10 * sum(map(eq, words, words[1:])) / n)),
    )
    return np.unique(np.concatenate([hashes % BUCKETS, BUCKETS + np.array(shape)])).astype(np.uint32)


_NO_FEATURES, _NO_WEIGHTS = np.zeros(0, np.uint32), np.zeros(0)


@dataclass
class Model:
    features: np.ndarray  # of the faults; sorted; all others weigh nothing
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades
    leaning: np.ndarray = field(default_factory=_NO_FEATURES.copy)  # of the tendency; sorted
    leanings: np.ndarray = field(default_factory=_NO_WEIGHTS.copy)

    def score(self, found: np.ndarray) -> float:
        leaning = self.leanings[_places(self.leaning, found)].sum() * _evened(found)
        return float(self.weights[_places(self.features, found)].sum() + leaning)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and each k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -50, 50)))


#: The arrays of a model and their kinds.
_PARTS = {"features": "<u4", "weights": "<f8", "thresholds": "<f8", "leaning": "<u4", "leanings": "<f8"}


def fit(
    rows: list[np.ndarray],
    grades: np.ndarray,
    *,
    n_grades: int = GRADES,
    min_texts: int = MIN_TEXTS,
    rounds: int = 15,
    shrink: float = 1e-3,
    least_share: float = 0.05,
) -> Model:
    """Fit the faults twice, first with shrinkage, to find the words that matter, then those alone and
    freely; and then the tendency.

    A word matters if its weight has least_share of the largest weight of any. A fault can only lower
    the grade: no length of common words makes up for a bad one, and a short text without any is not
    a bad one. The tendency ranks what the faults leave alike.
    """
    known, often = np.unique(np.concatenate([*rows, np.zeros(0, np.uint32)]), return_counts=True)
    every = known[often >= min_texts]
    known = known[(often >= min_texts) | (known >= BUCKETS)]
    weights, _ = _ascend(rows, grades, known, n_grades, rounds, shrink)
    least = least_share * np.abs(weights[known < BUCKETS]).max(initial=0)
    known = known[(known >= BUCKETS) | (np.abs(weights) > least)]
    weights, thresholds = _ascend(rows, grades, known, n_grades, 4 * rounds, shrink / 50)
    faults = Model(known, weights, thresholds)
    return Model(known, weights, thresholds, every, _lean(rows, grades, every, faults))


def _evened(found: np.ndarray) -> float:
    return 1 / math.sqrt(max(1, len(found)))


def _balance(grades: np.ndarray, n_grades: int) -> np.ndarray:
    """Weights of the grades: the inverse of the square root of their share."""
    share = np.bincount(grades, minlength=n_grades) / max(1, len(grades))
    balance = 1 / np.sqrt(np.maximum(share, 1e-9))
    return balance / (balance * share).sum() if len(grades) else balance


def likelihood(
    scores: np.ndarray, grades: np.ndarray, thresholds: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The logarithm of the probability of each grade, and its slopes by the score and by each threshold."""
    tail = 1 / (1 + np.exp(np.clip(thresholds[None, :] - scores[:, None], -50, 50)))
    slope = tail * (1 - tail)
    # P(grade) is a difference of neighbouring tails, 1 before the first and 0 behind the last.
    edge = np.ones((len(scores), 1))
    wide, slopes = np.hstack([edge, tail, 0 * edge]), np.hstack([0 * edge, slope, 0 * edge])
    i = np.arange(len(scores))
    p = np.maximum(wide[i, grades] - wide[i, grades + 1], 1e-9)
    by_threshold = np.zeros((len(scores), len(thresholds) + 2))
    by_threshold[i, grades] -= slopes[i, grades] / p
    by_threshold[i, grades + 1] += slopes[i, grades + 1] / p
    return np.log(p), (slopes[i, grades] - slopes[i, grades + 1]) / p, by_threshold[:, 1:-1]


def _places(known: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Where the found features stand among the known ones; those that are not known are left out."""
    if not len(known):
        return np.zeros(0, np.int32)
    place = np.minimum(np.searchsorted(known, found), len(known) - 1)
    return place[known[place] == found].astype(np.int32)


def _ascend(
    rows: list[np.ndarray],
    grades: np.ndarray,
    known: np.ndarray,
    n_grades: int,
    rounds: int,
    shrink: float,
    rate: float = 0.3,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by proximal AdaGrad over mini-batches of the cumulative-link
    likelihood.

    Grades are weighted by :func:`_balance`. The thresholds are an anchor and positive steps.
    """
    lowers = known < BUCKETS
    rows = [_places(known, r) for r in rows]
    width = len(known)
    weights, seen = np.zeros(width), np.full(width, 1e-6)
    lengths = np.array([len(r) for r in rows], np.int64)
    flat = np.concatenate([*rows, np.zeros(0, np.int32)])
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    balance = _balance(grades, n_grades)
    # anchor, then logarithms of the steps between thresholds
    free = np.concatenate([[0.0], np.zeros(n_grades - 2)])
    free_seen = np.full(len(free), 1e-6)
    order = np.random.default_rng(5)
    for _ in range(rounds if len(rows) else 0):
        shuffled = order.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            batch = shuffled[at : at + BATCH]
            index = np.concatenate([flat[offsets[b] : offsets[b + 1]] for b in batch])
            owner = np.repeat(np.arange(len(batch)), lengths[batch])
            score = np.bincount(owner, weights[index], minlength=len(batch))
            steps = np.exp(free[1:])
            thresholds = free[0] + np.concatenate([[0.0], np.cumsum(steps)])
            factor = balance[grades[batch]] / len(batch)
            _, by_score, by_threshold = likelihood(score, grades[batch], thresholds)
            by_score = factor * by_score
            gradient = np.bincount(index, by_score[owner], minlength=width)
            touched = np.unique(index)
            g = gradient[touched]
            seen[touched] += g * g
            pace = rate / np.sqrt(seen[touched])
            moved = weights[touched] + pace * g
            moved = np.sign(moved) * np.maximum(np.abs(moved) - pace * shrink, 0)
            weights[touched] = np.where(lowers[touched], np.minimum(moved, 0), moved)
            total = (factor[:, None] * by_threshold).sum(0)
            g = np.concatenate([[total.sum()], np.cumsum(total[:0:-1])[::-1] * steps])
            free_seen += g * g
            free += 0.5 * g / np.sqrt(free_seen)
    thresholds = free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])
    return weights, thresholds


def _lean(
    rows: list[np.ndarray],
    grades: np.ndarray,
    known: np.ndarray,
    faults: Model,
    rounds: int = 10,
    shrink: float = 1e-4,
    rate: float = 0.3,
) -> np.ndarray:
    """Weights of either sign for what the faults leave open, by AdaGrad with a quadratic penalty."""
    places = [_places(known, r) for r in rows]
    evened = np.array([_evened(r) for r in rows])
    fixed = np.array([faults.score(r) for r in rows])
    weights, seen = np.zeros(len(known)), np.full(len(known), 1e-6)
    balance = _balance(grades, len(faults.thresholds) + 1)
    order = np.random.default_rng(5)
    for _ in range(rounds if len(rows) else 0):
        shuffled = order.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            batch = shuffled[at : at + BATCH]
            index = np.concatenate([places[b] for b in batch])
            owner = np.repeat(np.arange(len(batch)), [len(places[b]) for b in batch])
            sums = np.bincount(owner, weights[index], minlength=len(batch))
            _, by_score, _ = likelihood(fixed[batch] + evened[batch] * sums, grades[batch], faults.thresholds)
            pull = balance[grades[batch]] / len(batch) * by_score * evened[batch]
            touched = np.unique(index)
            g = np.bincount(index, pull[owner], minlength=len(known))[touched] - shrink * weights[touched]
            seen[touched] += g * g
            weights[touched] += rate * g / np.sqrt(seen[touched])
    return weights


def grade(quality: Column, toxic: Column) -> Column:
    """Graded rating of a labelled document: the number of the two tests it passes."""
    return (F.when(quality == 1, 1).otherwise(0) + F.when(toxic == 0, 1).otherwise(0)).cast("int")


def neutral() -> Model:
    """Rejects nothing."""
    return Model(np.zeros(0, np.uint32), np.zeros(0), np.arange(GRADES - 1) - 50.0)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, **options) -> Model:
    """Fit on at most sample_rows labelled documents, chosen by a hash of their id.

    The ids are chosen first, among those that docs holds, so that only the texts of the sample
    move.
    """
    chosen = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min(grade(F.col("quality"), F.col("toxic"))).alias("grade"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
        .collect()
    )
    if not chosen:
        return neutral()
    picked = docs.sparkSession.createDataFrame(
        [tuple(r) for r in chosen], T.StructType([docs.schema["doc_id"]]).add("grade", "integer")
    )
    # sample_rows ids at most: a bound that does not grow with the data.
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # One text for each id, however many rows carry it.
    rows = texts.groupBy("doc_id", "grade").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    schema = T.StructType().add("grade", "integer").add("found", T.ArrayType(T.IntegerType()))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces_of(batches, "text", PIECE_CHARS):
            found = [features(t).view(np.int32) for t in piece.column("text").to_pylist()]
            columns = [piece.column("grade"), pa.array(found, arrow.field("found").type)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Copies of a text count once, so that a much copied text does not teach its every word.
        texts = {}
        for batch in batches:
            for found, known_grade in zip(batch.column("found"), batch.column("grade").to_pylist()):
                name = found.values.to_numpy().tobytes()
                texts[name] = min(known_grade, texts.get(name, known_grade))
        if not texts:
            return
        names = sorted(texts)
        grades = np.array([texts[n] for n in names], np.int64)
        model = fit([np.frombuffer(n, np.uint32) for n in names], grades, **options)
        parts = [getattr(model, name).astype(kind) for name, kind in _PARTS.items()]
        yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], list(_PARTS))

    # One task fits the sample: the driver gets the weights alone.
    found = rows.select("text", "grade").mapInArrow(run, schema)
    fitted = found.repartition(1).mapInArrow(learn, ", ".join(f"{name} binary" for name in _PARTS)).collect()
    if not fitted:
        return neutral()
    return Model(**{name: np.frombuffer(fitted[0][name], kind) for name, kind in _PARTS.items()})


def score(docs: DataFrame, model: Model, keep_at: float = KEEP_AT) -> DataFrame:
    """docs, all columns, with expected_grade, tails (P(grade > k) for each k) and kept."""
    own = (
        T.StructType()
        .add("expected_grade", "double")
        .add("tails", T.ArrayType(T.DoubleType()))
        .add("kept", "boolean")
    )
    schema = T.StructType([*docs.schema.fields, *own.fields])
    arrow = to_arrow_schema(schema)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces_of(batches, "text", PIECE_CHARS):
            scores = np.array([model.score(features(t)) for t in piece.column("text").to_pylist()])
            tails = model.tails(scores)
            columns = [
                pa.array(tails.sum(1)),
                pa.array(list(tails), arrow.field("tails").type),
                pa.array(tails[:, -1] >= keep_at),
            ]
            yield pa.RecordBatch.from_arrays([*piece.columns, *columns], schema=arrow)

    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Every document's expected grade, tail probabilities and verdict."""
    model = train(docs, labels, **options)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        "expected_grade",
        *(F.col("tails")[k].alias(f"p_grade_{k + 1}") for k in range(GRADES - 1)),
        "kept",
    )


def selected(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """docs, all columns, without the documents that the classifier rejects."""
    model = train(docs, labels, **options)
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return score(rows, model).where("kept").select("row.*")
