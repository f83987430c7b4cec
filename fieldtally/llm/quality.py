"""Quality grades by cumulative-link (proportional odds) regression on hashed text.

P(grade >= k) = sigmoid(w . x - t_k): one weight vector for all grades, and thresholds in increasing order. x holds the
words and the byte trigrams of the whole text, hashed to ``buckets`` places each, as log(1 + count) with length one. The
expected grade is the sum of the tail probabilities; a document stays if P(grade >= ``least``) reaches ``bound``.

The weights are fitted on a bounded sample: the ``max_rows`` labelled rows whose hashed identifiers come first. Only the sample's
hashed vectors, at most 2 * ``buckets`` numbers each, come to the driver, and the weights go out. Every document is scored.

Defined results: labels without a grade or a document are not used; of several labels of a document each counts. Without
any usable label all probabilities are one half and everything stays. A null text is an empty text, which has the vector 0.
Rows with equal identifiers are scored one by one. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text
from .words import slices, words

BUCKETS = 1 << 15
MAX_ROWS = 4096


@dataclass(frozen=True)
class Ordinal:
    """Weights and increasing thresholds; grade k is between threshold k and k + 1."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, places: np.ndarray, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(self.thresholds - np.sum(self.weights[places] * values)))


def hashed_rows(column: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted places and values of each text's vector."""
    found = words(column)
    word_places = (found.hashes % np.uint64(buckets)).astype(np.int64)
    data = found.data.astype(np.uint32)
    grams = ((data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)) * np.uint32(2654435761)) >> np.uint32(8)
    gram_places = grams.astype(np.int64) % buckets + buckets
    for i in range(len(found)):
        a, b = found.offsets[i], found.offsets[i + 1]
        places = np.concatenate((word_places[found.bounds[i] : found.bounds[i + 1]], gram_places[a : max(a, b - 2)]))
        places, counts = np.unique(places, return_counts=True)
        values = np.log1p(counts)
        yield places, values / np.sqrt(np.sum(values**2)) if len(values) else values


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], grades: int, buckets: int = BUCKETS, steps: int = 120, decay: float = 1e-5) -> Ordinal:
    """Maximum likelihood with a little weight decay, by Adam over all rows of (grade, places, values)."""
    levels = np.arange(1, grades)
    if not rows:
        return Ordinal(np.zeros(2 * buckets), np.zeros(grades - 1))
    y = np.array([r[0] for r in rows])
    places = np.concatenate([r[1] for r in rows])
    values = np.concatenate([r[2] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    share = np.clip([(y >= k).mean() for k in levels], 1e-3, 1 - 1e-3)
    first = -np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(first), 1e-2))  # thresholds are the first one plus sums of exp(gaps)
    params = np.concatenate((np.zeros(2 * buckets), first[:1], gaps))
    slope, square = np.zeros_like(params), np.zeros_like(params)
    n = 2 * buckets
    for step in range(1, steps + 1):
        weights, thresholds = params[:n], params[n] + np.concatenate(([0], np.cumsum(np.exp(params[n + 1 :]))))
        z = np.bincount(row, weights[places] * values, minlength=len(rows))
        tail = np.column_stack((np.ones(len(y)), 1 / (1 + np.exp(thresholds - z[:, None])), np.zeros(len(y))))
        mass = np.maximum(tail[np.arange(len(y)), y] - tail[np.arange(len(y)), y + 1], 1e-12)
        spread = tail * (1 - tail)
        low, high = spread[np.arange(len(y)), y], spread[np.arange(len(y)), y + 1]
        to_z = (high - low) / mass  # slope of the negative log likelihood by z
        to_t = np.array([np.sum((low / mass)[y == k]) - np.sum((high / mass)[y == k - 1]) for k in levels]) / len(y)
        grad = np.concatenate(
            (
                np.bincount(places, to_z[row] * values, minlength=n) / len(y) + decay * weights,
                [to_t.sum()],
                [to_t[j:].sum() * np.exp(params[n + j]) for j in range(1, grades - 1)],
            )
        )
        slope = 0.9 * slope + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        params = params - 0.1 * (slope / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Ordinal(params[:n], params[n] + np.concatenate(([0], np.cumsum(np.exp(params[n + 1 :])))))


def sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, grade) of at most ``max_rows`` of the labels (doc_id, grade); the same ones in every run."""
    first = (
        labels.select(F.col("doc_id").cast("long").alias("__labelled"), F.col("grade").cast("int").alias("grade"))
        .dropna()
        .orderBy(F.xxhash64("__labelled", F.lit(9)), "__labelled", "grade")
        .limit(max_rows)
    )
    rows = id_and_text(docs, doc_id, text)
    return rows.join(F.broadcast(first), rows["doc_id"] == first["__labelled"]).select("doc_id", "text", "grade")  # max_rows at most


def train(docs: DataFrame, labels: DataFrame, grades: int, buckets: int = BUCKETS, max_rows: int = MAX_ROWS) -> Ordinal:
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = list(hashed_rows(part.column("text"), buckets))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("grade"),
                        pa.array([p.astype("<i4").tobytes() for p, _ in rows], type=pa.binary()),
                        pa.array([v.astype("<f4").tobytes() for _, v in rows], type=pa.binary()),
                    ],
                    names=["doc_id", "grade", "places", "values"],
                )

    found = sample(docs, labels, max_rows).mapInArrow(vectors, "doc_id bigint, grade int, places binary, values binary").limit(max_rows).collect()
    found.sort(key=lambda r: (r.doc_id, r.grade, bytes(r.places)))
    rows = [(min(max(r.grade, 0), grades - 1), np.frombuffer(r.places, "<i4").astype(np.int64), np.frombuffer(r["values"], "<f4").astype(float)) for r in found]
    return fit(rows, grades, buckets)


def grade(docs: DataFrame, model: Ordinal, least: int = 1, bound: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, expected_grade, tails, keep) of every document; tails[k - 1] is P(grade >= k)."""
    rows = id_and_text(docs, doc_id, text)
    sent = rows.sparkSession.sparkContext.broadcast(model)
    buckets = len(model.weights) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                tails = [sent.value.tails(p, v) for p, v in hashed_rows(part.column("text"), buckets)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([float(t.sum()) for t in tails], type=pa.float64()),
                        pa.array([t.tolist() for t in tails], type=pa.list_(pa.float64())),
                        pa.array([bool(t[least - 1] >= bound) for t in tails], type=pa.bool_()),
                    ],
                    names=["doc_id", "expected_grade", "tails", "keep"],
                )

    return rows.mapInArrow(run, "doc_id bigint, expected_grade double, tails array<double>, keep boolean")


def rated(labels: DataFrame) -> DataFrame:
    """Grades of the label table: 0 poor, 1 well written but toxic, 2 well written and clean."""
    missing = F.col("quality").isNull() | F.col("toxic").isNull()
    return labels.select("doc_id", F.when(missing, None).when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2).alias("grade"))


GRADES = 3


def keep_good(docs: DataFrame, labels: DataFrame, least: int = 1, bound: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns. Each row goes by its own text, without a join."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, rated(labels), GRADES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = len(sent.value.weights) // 2
        for batch in batches:
            for part in slices(batch, text):
                keep = [bool(sent.value.tails(p, v)[least - 1] >= bound) for p, v in hashed_rows(part.column(text), buckets)]
                yield part.filter(pa.array(keep, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
