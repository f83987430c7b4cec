"""Line dedup with two Bloom filters, for lines seen in one document and lines seen in two or more.

1. Every task sets, for the distinct lines of its documents, bits of a filter of ``filter_bits`` bits, in blocks of 65,536
   bits. What it sends for a block is the list of its bits, or the block itself once that is shorter: about four bytes for
   each distinct line. Blocks are merged where they are dealt to: seen twice is what either side saw twice, or both saw.
2. The filter of the lines seen twice goes to all tasks; it has ``filter_bits`` / 8 bytes at most, however large the input
   is. A line that it doesn't know was seen in one document. The others are suspects: their digest and document are
   shuffled, counted exactly, and the document that keeps the line is chosen. A fuller filter sends more suspects, never
   another result.
3. Each document joins the digests that it loses, and its other lines are put together again. A digest that makes up one in
   ``HOT`` of all rows of that join, of which there are ``HOT`` at most, is looked up in a broadcast and its rows are dealt by
   document, so that no line is a large task, however many documents hold it.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z as a-z.

Defined results: a null or empty text is one empty line. A null identifier is a document of its own, the smallest; rows that
repeat an identifier are one document for the counts, and lose the same lines each. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, materialize

HOT = 1024
BLOCK_BITS = 1 << 16
PROBES = 2
STRIP = " \t\n\x0b\x0c\r"
DIGEST_BYTES = 16


def ascii_lower(text: str) -> str:
    return text.encode().lower().decode()


def line_digests(text: str, min_chars: int) -> list[bytes | None]:
    """The digest of each line's key; None for a key that is too short."""
    out: list[bytes | None] = []
    for line in ascii_lower(text).split("\n"):
        key = line.strip(STRIP)
        out.append(blake2b(key.encode(), digest_size=DIGEST_BYTES).digest() if len(key) >= min_chars else None)
    return out


def probes(found: bytes, filter_bits: int) -> np.ndarray:
    """Bit positions of joined digests, one row each."""
    return (np.frombuffer(found, dtype="<u8").reshape(-1, 2)[:, :PROBES] % np.uint64(filter_bits)).astype(np.int64)


class Filters:
    """Blocks of the two filters that a task has bits in."""

    def __init__(self) -> None:
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        if number not in self.blocks:
            self.blocks[number] = (np.zeros(BLOCK_BITS // 8, dtype=np.uint8), np.zeros(BLOCK_BITS // 8, dtype=np.uint8))
        return self.blocks[number]

    def merge(self, number: int, once: np.ndarray, twice: np.ndarray) -> None:
        mine, both = self.block(number)
        both |= twice | (mine & once)
        mine |= once


def packed(bits: np.ndarray) -> bytes:
    """The bits that are set as 16-bit numbers, or the block if that is shorter."""
    places = np.flatnonzero(np.unpackbits(bits, bitorder="little"))
    return bits.tobytes() if 2 * len(places) >= len(bits) else places.astype("<u2").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if len(data) == BLOCK_BITS // 8:
        return np.frombuffer(data, dtype=np.uint8)
    flags = np.zeros(BLOCK_BITS, dtype=bool)
    flags[np.frombuffer(data, dtype="<u2")] = True
    return np.packbits(flags, bitorder="little")


def seen_twice(rows: DataFrame, filter_bits: int, min_chars: int) -> DataFrame:
    """(block, bits) of the filter for lines seen in two documents or more; blocks without bits are left out."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: set[bytes] = set()
        again: set[bytes] = set()

        def sent() -> pa.RecordBatch:
            parts: dict[int, list[np.ndarray]] = defaultdict(lambda: [np.zeros(BLOCK_BITS // 8, dtype=np.uint8)] * 2)
            for which, digests in enumerate((first, again)):
                places = np.unique(probes(b"".join(digests), filter_bits))
                for part in np.split(places, np.flatnonzero(np.diff(places // BLOCK_BITS)) + 1) if len(places) else ():
                    flags = np.zeros(BLOCK_BITS, dtype=bool)
                    flags[part % BLOCK_BITS] = True
                    parts[int(part[0] // BLOCK_BITS)][which] = np.packbits(flags, bitorder="little")
            first.clear()
            again.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(parts.keys(), type=pa.int32()),
                    pa.array([packed(p[0]) for p in parts.values()], type=pa.binary()),
                    pa.array([packed(p[1]) for p in parts.values()], type=pa.binary()),
                ],
                names=["block", "once", "twice"],
            )

        for batch in batches:
            for text in batch.column("text"):
                for digest in set(line_digests(text.as_py(), min_chars)) - {None}:
                    (again if digest in first else first).add(digest)
            if len(first) > 1 << 18:
                yield sent()
        if first:
            yield sent()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters()
        for batch in batches:
            for block, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                filters.merge(block, unpacked(once), unpacked(twice))
        for block, (_, twice) in filters.blocks.items():
            if twice.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], type=pa.int32()), pa.array([packed(twice)], type=pa.binary())], names=["block", "bits"])

    sent = rows.select("text").mapInArrow(local, "block int, once binary, twice binary")
    return sent.repartition("block").mapInArrow(merged, "block int, bits binary")


def losses(held: DataFrame, repeated: DataFrame) -> DataFrame:
    """(doc_id, digest, keep) of the held digests that are repeated; the most frequent ones by a broadcast of ``HOT`` rows at most.

    Their rows pass the other join under a key of their own, longer than any digest.
    """
    total = repeated.agg(F.sum("n")).first()[0] or 0
    frequent = F.col("n") * HOT >= F.lit(total)
    hot = repeated.filter(frequent).select("digest", F.col("keep").alias("hot_keep"), F.lit(True).alias("hot"))
    rest = repeated.filter(~frequent).select(F.col("digest").alias("key"), "keep", F.lit(True).alias("cold"))
    own = F.concat("digest", F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "utf-8"))
    marked = held.join(F.broadcast(hot), "digest", "left").withColumn("key", F.when(F.col("hot"), own).otherwise(F.col("digest")))
    joined = marked.join(rest, "key", "left").filter(F.col("hot") | F.col("cold"))
    return joined.select("doc_id", "digest", F.when(F.col("hot"), F.col("hot_keep")).otherwise(F.col("keep")).alias("keep"))


def line_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5, filter_bits: int = 1 << 27
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) of every row: the text without the lines that other documents keep.

    Keys of at least ``min_chars`` code points that at least ``min_docs`` documents hold lose all their lines except in the
    largest identifier that holds them.
    """
    rows = id_and_text(docs, doc_id, text)
    blocks = {r.block: bytes(r.bits) for r in seen_twice(rows, filter_bits, min_chars).collect()}  # filter_bits / 8 bytes at most
    known = rows.sparkSession.sparkContext.broadcast(blocks)

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(filter_bits // 8, dtype=np.uint8)
        for block, bits in known.value.items():
            flags[block * (BLOCK_BITS // 8) : (block + 1) * (BLOCK_BITS // 8)] = unpacked(bits)
        for batch in batches:
            ids, found = [], []
            for doc, value in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                digests = sorted(set(line_digests(value.as_py(), min_chars)) - {None})
                places = probes(b"".join(digests), filter_bits)
                hit = (flags[places >> 3] >> (places & 7).astype(np.uint8)) & 1
                mine = [d for d, h in zip(digests, hit.all(axis=1), strict=True) if h]
                ids += [doc.as_py()] * len(mine)
                found += mine
            yield pa.RecordBatch.from_arrays([pa.array(ids, type=pa.int64()), pa.array(found, type=pa.binary())], names=["doc_id", "digest"])

    held = rows.mapInArrow(suspects, "doc_id bigint, digest binary")
    repeated = (
        held.groupBy("digest", "doc_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("doc_id").alias("keep"))
        .filter(F.col("n") >= min_docs)
    )
    repeated = materialize(repeated, "repeated")
    lost = (
        losses(held, repeated)
        .filter(~F.col("doc_id").eqNullSafe(F.col("keep")))
        .groupBy(F.col("doc_id").alias("of"))
        .agg(F.collect_set("digest").alias("lost"))
    )
    joined = rows.join(lost.hint("shuffle_hash"), rows["doc_id"].eqNullSafe(lost["of"]), "left").select("doc_id", "text", "lost")

    def rebuilt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, lines, dropped = [], [], []
            for value, gone in zip(batch["text"], batch["lost"], strict=True):
                parts = value.split("\n")
                kept = parts
                if gone is not None and len(gone):
                    gone = {bytes(g) for g in gone}
                    kept = [p for p, d in zip(parts, line_digests(value, min_chars), strict=True) if d not in gone]
                texts.append("\n".join(kept))
                lines.append(len(parts))
                dropped.append(len(parts) - len(kept))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_lines": lines, "n_dropped": dropped, "text": texts})

    return joined.mapInPandas(rebuilt, "doc_id bigint, n_lines bigint, n_dropped bigint, text string")


def line_report(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


LINE_DEDUP_SQL = """
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
lines AS (
  SELECT rid, doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM docs
),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
),
repeated AS (
  SELECT key, max(doc_id) AS keep FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
marked AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.keep AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid
"""
