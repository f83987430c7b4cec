"""Token counts of fields and sections, from one encoding of each whole document.

The fields of a row are joined to one document by line breaks, and the lines of one of them are sections of their own. A
section holds its line break, so sections cover the document. The document is encoded once; each token has a span of
characters, from the one that holds its first byte to the one that holds its last. The spans are joined to the sections as
intervals. A token that crosses a boundary goes by rule:

* ``start``: to the section of its first character;
* ``end``: to that of its last one;
* ``most``: to the one that holds most of its characters, the first of several;
* ``share``: to each by the share of its characters.

Under each of them the counts of a document's sections add up to its tokens.

Defined results: null and empty fields are empty sections with their line break; the last field has none, so an empty one
holds no token. Rows with equal identifiers are counted one by one. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import LEAF_CHARS, ROWS, Codec, codec

RULES = ("start", "end", "most", "share")
SCHEMA = "doc_id bigint, n_tokens bigint, n_outside double, n_crossing bigint, sections array<struct<field:string,part:int,start:bigint,end:bigint,tokens:double>>"


def token_spans(ids: Sequence[int], text: str, made_of: Codec) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of each token."""
    ends = np.cumsum(np.fromiter((len(made_of.bytes_of[i]) for i in ids), dtype=np.int64, count=len(ids)))
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    if text.isascii() or not len(ends):
        return starts, ends
    character = np.cumsum((np.frombuffer(text.encode(), dtype=np.uint8) & 0xC0) != 0x80) - 1
    return character[starts], character[ends - 1] + 1


def attribute(starts: np.ndarray, ends: np.ndarray, first: np.ndarray, stop: np.ndarray, rule: str = "start") -> tuple[np.ndarray, int, float]:
    """Tokens of each section, tokens that cross a boundary, and tokens outside of all sections.

    Sections ``first``:``stop`` are in order and don't overlap; they may leave gaps.
    """
    counts = np.zeros(len(first))
    full = np.flatnonzero(stop > first)
    lo, hi = first[full], stop[full]
    if not len(full) or not len(starts):
        return counts, 0, float(len(starts))
    a = np.searchsorted(hi, starts, side="right")
    b = np.searchsorted(lo, ends, side="left") - 1
    touched = a <= b
    a, b = np.minimum(a, len(full) - 1), np.maximum(b, 0)
    crossing = touched & ((b > a) | (starts < lo[a]) | (ends > hi[b]))
    whole = touched & ~crossing
    np.add.at(counts, full[a[whole]], 1)
    for t in np.flatnonzero(crossing):
        over = np.minimum(hi[a[t] : b[t] + 1], ends[t]) - np.maximum(lo[a[t] : b[t] + 1], starts[t])
        if rule == "start" and starts[t] >= lo[a[t]]:
            counts[full[a[t]]] += 1
        elif rule == "end" and ends[t] <= hi[b[t]]:
            counts[full[b[t]]] += 1
        elif rule == "most":
            counts[full[a[t] + int(np.argmax(over))]] += 1
        elif rule == "share":
            counts[full[a[t] : b[t] + 1]] += over / (ends[t] - starts[t])
    return counts, int(crossing.sum()), float(len(starts) - counts.sum())


def sections(parts: Sequence[str], names: Sequence[str], lines_of: str | None) -> tuple[str, list[tuple[str, int, int, int]]]:
    """The document, and (field, part, first character, end) of its sections."""
    out, at = [], 0
    for k, (name, value) in enumerate(zip(names, parts, strict=True)):
        pieces = value.split("\n") if name == lines_of else [value]
        for i, piece in enumerate(pieces):
            last = k == len(parts) - 1 and i == len(pieces) - 1
            end = at + len(piece) + (not last)
            out.append((name, i, at, end))
            at = end
    return "\n".join(parts), out


def token_counts(
    docs: DataFrame,
    path: str,
    fields: Sequence[str] = ("lang", "source", "text"),
    lines_of: str | None = "text",
    rule: str = "start",
    doc_id: str = "doc_id",
    leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """(doc_id, n_tokens, n_outside, n_crossing, sections) of every row; a section is (field, part, start, end, tokens)."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.array(*(F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields)).alias("parts")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made_of = codec(path, leaf_chars)
        kind = pa.list_(pa.struct([("field", pa.string()), ("part", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("tokens", pa.float64())]))
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                found = []
                for values in part.column("parts"):
                    text, spans = sections(values.as_py(), fields, lines_of)
                    ids = made_of.encode(text)
                    starts, ends = token_spans(ids, text, made_of)
                    counts, crossing, outside = attribute(starts, ends, np.array([s[2] for s in spans]), np.array([s[3] for s in spans]), rule)
                    names = ("field", "part", "start", "end", "tokens")
                    listed = [dict(zip(names, (*s, float(c)), strict=True)) for s, c in zip(spans, counts, strict=True)]
                    found.append((len(ids), outside, crossing, listed))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([f[0] for f in found], type=pa.int64()),
                        pa.array([f[1] for f in found], type=pa.float64()),
                        pa.array([f[2] for f in found], type=pa.int64()),
                        pa.array([f[3] for f in found], type=kind),
                    ],
                    names=["doc_id", "n_tokens", "n_outside", "n_crossing", "sections"],
                )

    return rows.mapInArrow(run, SCHEMA)


def token_report(counted: DataFrame, fields: Sequence[str] = ("lang", "source", "text")) -> DataFrame:
    """Totals for each field, and the counts of all sections in order."""

    def total(field: str):
        own = F.filter("sections", lambda s: s["field"] == field)
        return F.aggregate(own, F.lit(0.0), lambda t, s: t + s["tokens"]).cast("long").alias(f"{field}_tokens")

    return counted.select(
        "doc_id",
        "n_tokens",
        F.size("sections").cast("long").alias("n_sections"),
        "n_crossing",
        *map(total, fields),
        F.transform("sections", lambda s: s["tokens"].cast("long")).alias("section_tokens"),
    )
