"""Toxicity by votes of the nearest labelled examples, found exactly by TF-IDF cosine in an inverted index.

Terms are words and their first 4, 5 and 6 bytes, hashed. All terms of the examples span the space; what a text holds of them,
with log counts times inverse document frequency over all documents, is its vector, of length one. Both sides of a cosine weigh
each term by its relevance frequency log2(2 + toxic examples / other examples that hold it), which is 1 or more: a term that
tells little counts as it does in plain TF-IDF, and none is left out. The examples are the ``max_examples`` labelled rows whose
hashed identifiers come first: a bounded sample, so the index is of bounded size and goes to every task.

The index has a posting list for each term, those that most examples hold first; the first ``HEAD`` are rows of a dense table.
The part of a cosine that the table has is added up in single precision, by a matrix product, and what the other lists have in
double precision. Of the examples that the error bound ``MARGIN`` leaves among the k best, the first part is computed again in
double precision: the result is the same as that of a comparison with every example. Ties go to the smaller example.

Neighbours vote with weight 1 / (DISTANCE + 1 - cosine), and ``PRIOR`` votes at the base rate keep scores of few or far
neighbours near it. A text that holds no term has no neighbour; it gets the rate of such examples. The neighbours are the
evidence.

Defined results: a null or empty text is such a text. Labels that are null, or of unknown documents, are not used; of several labels
of a document the largest counts, and a document that repeats in ``docs`` is one example per row. Without examples every
score is 0. Rows with equal identifiers are scored one by one. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property
from hashlib import blake2b
from zlib import compress, decompress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, materialize
from .words import prefixes, slices, spread, words

SIZES = (4, 5, 6)
HEAD = 1024
MARGIN = (HEAD + 64) * 2.0**-24  # relative error of a cosine in single precision; no weight is negative
TOGETHER = 64  # texts in a matrix product
REMEMBERED = 20_000  # results of equal vectors that a task keeps
NEIGHBOURS = 25
DISTANCE = 0.1
PRIOR = 1.0
MAX_EXAMPLES = 8192


def learnable(doc_id: Column) -> Column:
    """Rows whose labels may be learned from; the others are held out."""
    return F.crc32(doc_id.cast("string")) % 4 != 2


def text_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of all texts, and the text of each."""
    found = words(column)
    of_word = np.repeat(np.arange(len(found)), np.diff(found.bounds))
    parts = [(found.hashes, of_word)]
    for size in SIZES:
        hashes, which = prefixes(found, size)
        parts.append((hashes, of_word[which]))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def text_counts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct term hashes of each text, sorted, and how often it holds them."""
    hashes, texts = text_terms(column)
    order = np.argsort(texts, kind="stable")
    hashes, cuts = hashes[order], np.searchsorted(texts[order], np.arange(len(column) + 1))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield np.unique(hashes[a:b], return_counts=True)


class Vocabulary:
    """Sorted term hashes; a table has the first of each range of hashes."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.unique(terms)
        bits = max(1, len(self.terms)).bit_length() + 1
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.terms >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each term, -1 for hashes of none."""
        part = (hashes >> self.shift).astype(np.int64)
        at, ends = self.first[part], self.first[part + 1]
        out = np.full(len(hashes), -1, dtype=np.int64)
        left = np.flatnonzero(at < ends)
        while len(left):
            here = at[left]
            same = self.terms[here] == hashes[left]
            out[left[same]] = here[same]
            at[left] += 1
            left = left[~same & (here + 1 < ends[left])]
        return out

    def counts(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Terms (by number) that each text holds, and how often."""
        found = list(text_counts(column))
        if not found:
            return
        places = np.split(self.places(np.concatenate([h for h, _ in found])), np.cumsum([len(h) for h, _ in found])[:-1])
        for at, (_, counts) in zip(places, found, strict=True):
            yield at[at >= 0], counts[at >= 0]


def unit(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = (1 + np.log(counts)) * idf[terms]
    length = np.sqrt(np.sum(weights**2))
    return weights / length if length > 0 else weights


def relevance(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], size: int) -> np.ndarray:
    """Weight of each term by the toxic and the other rows that hold it, 1 or more."""
    held = [np.bincount(np.concatenate([np.zeros(0, dtype=np.int64), *(t for (t, _), y in zip(rows, labels, strict=True) if (y > 0) == toxic)]), minlength=size) for toxic in (True, False)]
    return np.log2(2 + held[0] / np.maximum(1, held[1]))


@dataclass
class Index:
    """Vectors of the examples that hold a term: by example, by term, and the head terms as a dense table."""

    ids: np.ndarray
    labels: np.ndarray
    idf: np.ndarray
    base_rate: float
    empty_rate: float
    rank: np.ndarray = field(repr=False)  # of a term, by the examples that hold it; below len(head): a row of the table
    bounds: np.ndarray = field(repr=False)  # example i has the terms bounds[i]:bounds[i + 1] in the table
    terms: np.ndarray = field(repr=False)  # by rank
    weights: np.ndarray = field(repr=False)
    pointers: np.ndarray = field(repr=False)  # the term of rank r has the postings pointers[r]:pointers[r + 1], none if it is in the table
    examples: np.ndarray = field(repr=False)
    posted: np.ndarray = field(repr=False)
    head: np.ndarray = field(repr=False)
    query: np.ndarray = field(repr=False)  # zeros, but while a query is compared

    @classmethod
    def build(cls, ids: Sequence[int], labels: Sequence[int], rows: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray) -> Index:
        labels_of = np.array(labels, dtype=float)
        base = float((labels_of.sum() + 0.0) / max(1, len(labels_of)))
        without = np.array([len(terms) == 0 for terms, _ in rows], dtype=bool)
        empty = float((labels_of[without].sum() + PRIOR * base) / (without.sum() + PRIOR)) if len(rows) else 0.0
        held = [i for i, (terms, _) in enumerate(rows) if len(terms)]
        chosen = np.array(held, dtype=np.int64)
        sizes = [len(rows[i][0]) for i in held]
        terms = np.concatenate([rows[i][0] for i in held]) if held else np.zeros(0, dtype=np.int64)
        weights = np.concatenate([unit(*rows[i], idf) for i in held]) if held else np.zeros(0)
        examples = np.repeat(np.arange(len(held)), sizes)
        rank = np.empty(len(idf), dtype=np.int32)
        rank[np.argsort(-np.bincount(terms, minlength=len(idf)), kind="stable")] = np.arange(len(idf))
        terms = rank[terms]
        head = np.zeros((min(HEAD, len(idf)), len(held)), dtype=np.float32)
        dense, rest = np.flatnonzero(terms < len(head)), np.flatnonzero(terms >= len(head))
        dense = dense[np.lexsort((terms[dense], examples[dense]))]
        head[terms[dense], examples[dense]] = weights[dense]
        rest = rest[np.argsort(terms[rest], kind="stable")]
        return cls(
            np.array(ids, dtype=np.int64)[chosen] if held else np.zeros(0, dtype=np.int64),
            labels_of[chosen] if held else np.zeros(0),
            idf, base, empty, rank, np.searchsorted(examples[dense], np.arange(len(held) + 1)), terms[dense].astype(np.int64), weights[dense],
            np.searchsorted(terms[rest], np.arange(len(idf) + 1)), examples[rest], weights[rest], head, np.zeros(len(head)),
        )

    def ranked(self, terms: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Ranks and weights, those in the table first, and how many these are."""
        ranks = self.rank[terms]
        order = np.argsort(ranks)
        ranks = ranks[order]
        return ranks, query[order], int(np.searchsorted(ranks, len(self.head)))

    def sums(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Cosines of each query with all examples, in single precision, and what the lists add to them, in double."""
        table = np.zeros((len(queries), len(self.head)), dtype=np.float32)
        lists = np.zeros((len(queries), len(self.ids)))
        for i, (terms, query) in enumerate(queries):
            ranks, query, n = self.ranked(terms, query)
            table[i, ranks[:n]] = query[:n]
            begins, ends = self.pointers[ranks[n:]], self.pointers[ranks[n:] + 1]
            at = spread(begins, ends)
            lists[i] = np.bincount(self.examples[at], np.repeat(query[n:], ends - begins) * self.posted[at], minlength=len(self.ids))
        sums = table @ self.head
        sums += lists
        return sums, lists

    def nearest(
        self, terms: np.ndarray, query: np.ndarray, k: int = NEIGHBOURS, sums: tuple[np.ndarray, np.ndarray] | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the largest cosine above 0, and the cosines; ties go to the first example."""
        if not len(terms) or not len(self.ids):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        sums, lists = sums or [s[0] for s in self.sums([(terms, query)])]
        floor = np.partition(sums, -k)[-k] if k < len(sums) else 0.0
        here = np.flatnonzero((sums > 0) & (sums >= floor * (1 - 3 * MARGIN)))
        if not len(here):
            return here, np.zeros(0)
        ranks, query, n = self.ranked(terms, query)
        self.query[ranks[:n]] = query[:n]
        cosines = lists[here]
        for i, (begin, end) in enumerate(zip(self.bounds[here].tolist(), self.bounds[here + 1].tolist(), strict=True)):
            cosines[i] += self.query.take(self.terms[begin:end]) @ self.weights[begin:end]
        self.query[ranks[:n]] = 0
        cosines = np.round(cosines, 12)
        order = [i for i in np.lexsort((here, -cosines))[:k] if cosines[i] > 0]
        return here[order], cosines[order]

    def scores(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, list[int]]]:
        """Score and evidence of each (terms, counts)."""
        queries = [(terms, unit(terms, counts, self.idf)) for terms, counts in vectors]
        out = []
        for first in range(0, len(queries), TOGETHER):
            part = queries[first : first + TOGETHER]
            sums = zip(*self.sums(part), strict=True) if len(self.ids) else [None] * len(part)
            for (terms, query), row in zip(part, sums, strict=True):
                if not len(terms):
                    out.append((self.empty_rate, []))
                    continue
                found, cosines = self.nearest(terms, query, sums=row)
                votes = 1 / (DISTANCE + np.maximum(0, 1 - cosines))
                value = (np.sum(votes * self.labels[found]) + PRIOR * self.base_rate) / (np.sum(votes) + PRIOR)
                out.append((float(value), self.ids[found].tolist()))
        return out


class Examples:
    """What an index is built from, compressed, since each executor keeps copies on disk; each task's process builds its own."""

    def __init__(self, ids: list[int], labels: list[int], rows: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray):
        self.ids, self.labels, self.idf = np.array(ids, dtype=np.int64), np.array(labels, dtype=np.int64), idf
        self.cuts = np.cumsum([len(terms) for terms, _ in rows])[:-1]
        none = np.zeros(0, dtype=np.int64)
        self.terms = compress(np.diff(np.concatenate([none, *(t for t, _ in rows)]), prepend=0).astype(np.int32).tobytes(), 1)
        self.counts = compress(np.concatenate([none, *(c for _, c in rows)]).astype(np.int32).tobytes(), 1)

    @cached_property
    def index(self) -> Index:
        if not len(self.ids):
            return Index.build([], [], [], self.idf)
        terms = np.cumsum(np.frombuffer(decompress(self.terms), dtype=np.int32), dtype=np.int64)
        counts = np.frombuffer(decompress(self.counts), dtype=np.int32)
        return Index.build(self.ids, self.labels, list(zip(np.split(terms, self.cuts), np.split(counts, self.cuts), strict=True)), self.idf)


def toxicity(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, evidence: identifiers of the nearest examples) of every document.

    ``labels`` has (doc_id, label); only its rows are learned from.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, doc_id, text)
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("__example"), F.col("label").cast("int").alias("label"))
        .dropna()
        .groupBy("__example")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("__example", F.lit(5)), "__example")
        .limit(max_examples)
    )
    chosen = materialize(chosen, "examples")  # max_examples rows

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = list(text_counts(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("label"),
                        pa.array([t.view(np.int64) for t, _ in found], type=pa.list_(pa.int64())),
                        pa.array([c for _, c in found], type=pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "label", "terms", "counts"],
                )

    examples = rows.join(F.broadcast(chosen), rows["doc_id"] == chosen["__example"]).select("doc_id", "text", "label")
    known = examples.mapInArrow(held, "doc_id bigint, label int, terms array<bigint>, counts array<int>").toArrow()
    known = known.combine_chunks()
    terms = [np.asarray(t.values).view(np.uint64) for t in known.column("terms")]
    counts = [np.asarray(c.values) for c in known.column("counts")]
    vocabulary = Vocabulary(np.concatenate(terms) if terms else np.zeros(0, dtype=np.uint64))
    size = len(vocabulary.terms)
    sent = spark.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents, holding = 0, np.zeros(size + 1, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [t for t, _ in sent.value.counts(part.column("text"))]
                holding += np.bincount(np.concatenate(found), minlength=size + 1)
                documents += part.num_rows
        holding[size] = documents  # the last number counts the documents
        at = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(holding[at])], names=["term", "n"])

    often = np.zeros(size + 1)
    sums = rows.select("text").mapInArrow(counted, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    often[sums.column("term").to_numpy()] = sums.column("n").to_numpy()  # terms of the examples, and one
    idf = np.log((often[size] + 1) / (often[:size] + 1)) + 1
    vectors = [(np.searchsorted(vocabulary.terms, t), c.astype(np.int64)) for t, c in zip(terms, counts, strict=True)]
    ids, values = known.column("doc_id").to_pylist(), known.column("label").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i], vectors[i][0].tobytes(), vectors[i][1].tobytes()))
    idf *= relevance(vectors, values, size)
    shared = spark.sparkContext.broadcast(Examples([ids[i] for i in order], [values[i] for i in order], [vectors[i] for i in order], idf))

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered: dict[bytes, tuple[float, list[int]]] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                found = list(sent.value.counts(part.column("text")))
                keys = [blake2b(t.tobytes() + c.tobytes(), digest_size=16).digest() for t, c in found]
                fresh = {k: v for k, v in zip(keys, found, strict=True) if k not in remembered}
                if len(remembered) + len(fresh) > REMEMBERED:
                    remembered, fresh = {}, dict(zip(keys, found, strict=True))
                remembered.update(zip(fresh, shared.value.index.scores(list(fresh.values())), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([remembered[k][0] for k in keys], type=pa.float64()),
                        pa.array([remembered[k][1] for k in keys], type=pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "score", "evidence"],
                )

    return rows.mapInArrow(voted, "doc_id bigint, score double, evidence array<bigint>")
