"""Ordinal quality model: a cumulative-link regression on hashed text features.

Ratings are grades 0, 1, 2, ... One weight per hashed feature is shared by all grades; ordered
thresholds cut the score: ``P(grade >= k) = sigmoid(score - threshold[k])``. From these come the
expected grade and the probability of the grades wanted. Models are fitted by numpy, each on as
many ratings as a task holds, side by side until all ratings are in one; their mean is broadcast
and every document scored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfunnel.llm import sketch
from shopfunnel.llm.common import keeps, only

#: Feature buckets as a power of two: the broadcast weights take four bytes each.
BUCKET_BITS = 18
#: Ratings that one model is fitted on, about; more are dealt to several by a hash of their ids.
MOST_RATED = 12_000
#: Passes over the sample and steps, at least; rows of a step, its length, and the L1 penalty.
EPOCHS, STEPS, STEP_ROWS, STEP, PENALTY = 25, 1200, 250, 0.15, 5e-5
#: Least probability of a wanted grade for a document to be selected.
LEAST_PROBABILITY = 0.5

_PARTS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
#: Letters of the word beginnings that are features beside whole words.
_BEGINNINGS = (4, 5)
#: Words whose features a task remembers, each as 32-bit integers one after the other.
_MEMO_WORDS = 150_000
#: Weights are added up as whole multiples of a power of two, so that their order doesn't count.
_SCALE = 1 << 30
_memo: dict[str, bytes] = {}
keeps("quality", _memo.clear)


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) >> (32 - BUCKET_BITS)


def _word_features(word: str) -> bytes:
    names = []
    for part in _PARTS.findall(word):
        if part[0].isalpha():
            names.append("w " + part)
            names += [f"b {part[:n]}" for n in _BEGINNINGS if len(part) > n]
        elif part[0].isdigit():
            names.append(f"d {len(part)}")
        else:
            names.append("s " + part[:3])
    if word.isupper() and len(word) > 2:
        names.append("upper")
    return array("i", {_bucket(n) for n in names}).tobytes()


def features(text: str | None) -> np.ndarray:
    """Sorted distinct buckets of a text's words, word beginnings, signs and repetitions."""
    words = (text or "").split()
    found: list[bytes] = []
    for word in set(words):
        known = _memo.get(word)
        if known is None:
            if len(_memo) >= _MEMO_WORDS:
                _memo.clear()
            known = _memo[word] = _word_features(word if word.isupper() and len(word) > 2 else word.lower())
        found.append(known)
    again = sum(map(str.__eq__, words, words[1:]))
    if again:
        found.append(array("i", [_bucket(f"again {min(int(np.log2(again)), 4)}")]).tobytes())
    return np.unique(np.frombuffer(b"".join(found), np.int32))


@dataclass(frozen=True)
class OrdinalModel:
    """``weights`` by bucket and increasing ``thresholds`` of the grades from 1 on."""

    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """Row k holds ``P(grade >= k + 1)``."""
        return _sigmoid(scores[None, :] - self.thresholds[:, None])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(rows: list[np.ndarray], grades: np.ndarray, top: int) -> OrdinalModel:
    """Fit by proximal AdaGrad; ``top`` is the highest grade. Needs at least one row."""
    share = [np.clip(np.mean(grades >= k), 0.01, 0.99) for k in range(1, top + 1)]
    thresholds = np.array([-np.log(s / (1 - s)) for s in share])
    thresholds += np.arange(top) * 1e-3  # equal shares need thresholds apart
    weights = np.zeros(1 << BUCKET_BITS)
    squares, squares_t = np.full(1 << BUCKET_BITS, 1e-6), np.full(top, 1e-6)
    order = np.random.default_rng(7)
    for _ in range(max(EPOCHS, STEPS * STEP_ROWS // max(len(rows), STEP_ROWS))):
        shuffled = order.permutation(len(rows))
        for at in range(0, len(rows), STEP_ROWS):
            batch = shuffled[at : at + STEP_ROWS]
            lengths = np.array([len(rows[i]) for i in batch])
            columns = np.concatenate([rows[i] for i in batch]).astype(np.int64)
            owner = np.repeat(np.arange(len(batch)), lengths)
            scores = np.bincount(owner, weights[columns], minlength=len(batch))
            slope, slope_t = _slopes(scores, grades[batch], thresholds)
            gradient = np.bincount(columns, slope[owner], minlength=len(weights)) / len(batch)
            squares += gradient**2
            rate = STEP / np.sqrt(squares)
            weights -= rate * gradient
            weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * PENALTY, 0)
            slope_t /= len(batch)
            squares_t += slope_t**2
            thresholds = np.maximum.accumulate(thresholds - STEP * slope_t / np.sqrt(squares_t))
            thresholds += np.arange(top) * 1e-9
    return OrdinalModel(weights.astype(np.float32), thresholds)


def _slopes(scores: np.ndarray, grades: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of the negative log likelihood by score, and its sum by threshold."""
    over = _sigmoid(scores[None, :] - thresholds[:, None])
    edges = np.vstack([np.ones_like(scores), over, np.zeros_like(scores)])
    rows = np.arange(len(scores))
    upper, lower = edges[grades, rows], edges[grades + 1, rows]
    inside = np.maximum(upper - lower, 1e-9)
    by_score = upper + lower - 1
    by_threshold = np.zeros(len(thresholds))
    np.add.at(by_threshold, np.maximum(grades - 1, 0), np.where(grades > 0, upper * (1 - upper) / inside, 0))
    top = len(thresholds)
    np.add.at(by_threshold, np.minimum(grades, top - 1), -np.where(grades < top, lower * (1 - lower) / inside, 0))
    return by_score, by_threshold


def train(
    docs: DataFrame, ratings: DataFrame, top: int, id_col: str = "doc_id", text_col: str = "text",
    grade_col: str = "grade", most: int = MOST_RATED,
) -> OrdinalModel | None:
    """Fit on at most ``most`` ratings, drawn by a hash of the id; None if none has a document.

    Ratings with a null id or a grade outside 0..``top`` don't count. A document rated twice
    counts twice. Of several texts under one id the one whose features come first counts, so
    there is one row for each rating at most, whatever repeats.
    """
    usable = ratings.filter(F.col(grade_col).between(0, top) & F.col(id_col).isNotNull())
    drawn = usable.select(F.col(id_col).alias("id"), F.col(grade_col).cast("int").alias("grade"))
    drawn = drawn.orderBy(F.xxhash64("id"), "id", "grade").limit(most)
    ids = drawn.select("id").distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.list_(pa.int32()))], ["id", "x"])
        _memo.clear()  # the worker goes on with other work

    id_type = docs.schema[id_col].dataType.simpleString()
    rated = texts.mapInArrow(hashed, f"id {id_type}, x array<int>").groupBy("id").agg(F.min("x").alias("x"))
    sample = rated.join(F.broadcast(drawn), "id").toArrow().sort_by([("id", "ascending"), ("grade", "ascending")])
    if not len(sample):
        return None
    return fit(_rows(sample), sample["grade"].to_numpy(), top)


def train_on_all(
    docs: DataFrame, ratings: DataFrame, top: int, id_col: str = "doc_id", text_col: str = "text",
    grade_col: str = "grade", each: int = MOST_RATED,
) -> OrdinalModel | None:
    """:func:`train` on every rating, however many: the mean of models of about ``each`` ratings.

    A feature's weight in a model counts by how many of the model's ratings have it.
    """
    usable = ratings.filter(F.col(grade_col).between(0, top) & F.col(id_col).isNotNull())
    usable = usable.select(F.col(id_col).alias("id"), F.col(grade_col).cast("int").alias("grade"))
    count = usable.count()
    if count <= each:
        return train(docs, ratings, top, id_col, text_col, grade_col, each)
    parts = -(-count // each)
    times = usable.groupBy("id", "grade").agg(F.count(F.lit(1)).alias("times"))
    dealt = times.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select(
        "id", "grade", F.pmod(F.xxhash64("id", "grade", "time"), F.lit(parts)).alias("part")
    )
    bits = sketch.marked(usable.select(F.xxhash64("id").alias("key")), width := sketch.width_for(count))
    texts = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(id_col).cast(usable.schema["id"].dataType)).alias("key"), F.col(text_col).alias("text")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("quality")
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            mine = batch.filter(pa.array(sketch.holds(keys, bits.value, width)))
            rows = [features(t.as_py()) for t in mine.column("text")]
            yield pa.RecordBatch.from_arrays([mine.column("id"), pa.array(rows, pa.list_(pa.int32()))], ["id", "x"])
        _memo.clear()

    def fitted(key: tuple[pa.Scalar, ...], rated: pa.Table) -> pa.Table:
        rated = rated.sort_by([("id", "ascending"), ("grade", "ascending")])
        rows, grades = _rows(rated), rated["grade"].to_numpy()
        model = fit(rows, grades, top)
        met = np.bincount(np.concatenate(rows), minlength=1 << BUCKET_BITS)
        at = np.flatnonzero(met)
        values = np.concatenate([model.weights[at].astype(np.float64), model.thresholds])
        met = np.concatenate([met[at], np.full(top, len(rows))])
        at = np.concatenate([at, (1 << BUCKET_BITS) + np.arange(top)])
        return pa.table({"at": at, "value": np.rint(values * _SCALE).astype(np.int64) * met, "met": met})

    id_type = docs.schema[id_col].dataType.simpleString()
    rated = texts.mapInArrow(hashed, f"id {id_type}, x array<int>").groupBy("id").agg(F.min("x").alias("x")).join(dealt, "id")
    models = rated.groupBy("part").applyInArrow(fitted, "at long, value long, met long")
    found = models.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"), F.sum("met").alias("met"))
    found = found.select("at", (F.col("value").cast("double") / F.col("met") / _SCALE).alias("mean")).toArrow()
    if not len(found):
        return None
    means = np.zeros((1 << BUCKET_BITS) + top)
    means[found["at"].to_numpy()] = found["mean"].to_numpy()
    return OrdinalModel(means[: 1 << BUCKET_BITS].astype(np.float32), means[1 << BUCKET_BITS :])


def _rows(rated: pa.Table) -> list[np.ndarray]:
    """The features ``x`` of each row."""
    lists = rated["x"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    return [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def score(
    docs: DataFrame, model: OrdinalModel | None, wanted: int, text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail_probability``, that of grades from ``wanted`` on.

    A null, empty or blank text has no features and gets the probabilities of an unknown text.
    Without a model both columns are null. Columns of these names are replaced; all others stay.
    """
    docs = docs.drop("expected_grade", "tail_probability")
    if model is None:
        return docs.withColumns({c: F.lit(None).cast("double") for c in ("expected_grade", "tail_probability")})
    held = docs.sparkSession.sparkContext.broadcast(model)
    added = [T.StructField(c, T.DoubleType()) for c in ("expected_grade", "tail_probability")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("quality")
        weights = held.value.weights
        for batch in batches:
            texts = batch.column(text_col)
            scores = np.array([weights[features(t.as_py())].sum(dtype=np.float64) for t in texts])
            over = held.value.at_least(scores.reshape(-1))
            new = [pa.array(over.sum(axis=0)), pa.array(over[wanted - 1])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *(f.name for f in added)])
        _memo.clear()

    return docs.mapInArrow(apply, T.StructType([*docs.schema.fields, *added]))


def select(docs: DataFrame, model: OrdinalModel | None, wanted: int, text_col: str = "text") -> DataFrame:
    """Scored documents whose tail probability is high enough; all of them without a model."""
    scored = score(docs, model, wanted, text_col)
    return scored.filter(F.coalesce(F.col("tail_probability") >= LEAST_PROBABILITY, F.lit(True)))


def grade(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Grades of ratings with two flags: 0 toxic, 1 of low quality, 2 good; null if either is."""
    toxic, quality = F.col(toxic), F.col(quality)
    return F.when(toxic.isNull() | quality.isNull(), None).when(toxic == 1, 0).when(quality == 0, 1).otherwise(2)
