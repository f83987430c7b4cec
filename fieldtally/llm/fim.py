"""Fill-in-middle transformation of texts that are stored as seekable compressed frames (see ``frames``).

``store`` turns documents into frames with cumulative counts. ``fill_in_middle`` cuts a stored text at two places and puts its
parts in the order of its form: plain (unchanged), psm (``<P>`` prefix ``<S>`` suffix ``<M>`` middle) or spm (``<S>`` suffix ``<P>`` prefix
``<M>`` middle). Its output is stored likewise: only the two frames that hold a cut are decompressed, the others are moved as they
are. ``restore`` rebuilds a text from output and form alone: it looks for the marks in the output and reads the parts in their first
order. Digests stream the frames in order. All steps work on one row at a time, without a shuffle, and hold one decompressed
frame at a time; a row is as long as its compressed text.

The cuts follow from the first 32 hexadecimal digits of the sha256 of ``seed:doc_id``, four numbers h1 to h4: the prefix ends after
the smaller of h1 and h2 modulo n + 1 code points, the middle after the larger. Texts with h3 modulo 100 of ``100 - plain_percent`` or
more are plain, others with h4 modulo 100 below ``spm_percent`` are spm. A retry or another partitioning gives the same cuts.

Defined results: a null text is an empty text. Empty texts, and those that contain a mark, are plain, with null for the counts of prefix
and middle. A null identifier counts as an empty one in the hash and stays null. Rows with equal identifiers are cut one by one,
so equal texts of one identifier give equal rows. A part may be empty. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text
from .frames import FIELDS, FRAME_UNITS, TYPES, Codec, Stored
from .words import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
SEED = 1
PLAIN_PERCENT = 10
SPM_PERCENT = 20


def store(docs: DataFrame, frame_units: int = FRAME_UNITS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n: code points, marked: whether a mark occurs, frames, ends) of every document."""

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec()
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                made = [Stored.of(codec, t, frame_units) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(t) for t in texts], type=pa.int64()),
                        pa.array([any(m in t for m in (PREFIX, SUFFIX, MIDDLE)) for t in texts], type=pa.bool_()),
                        *_columns(made),
                    ],
                    names=["doc_id", "n", "marked", "frames", "ends"],
                )

    return id_and_text(docs, doc_id, text).mapInArrow(stored, f"doc_id bigint, n bigint, marked boolean, {FIELDS}")


def _columns(made: list[Stored]) -> list[pa.Array]:
    return [pa.array([m.frames for m in made], type=TYPES[0]), pa.array([m.ends for m in made], type=TYPES[1])]


def _rows(batch: pa.RecordBatch, codec: Codec) -> Iterator[tuple[dict, Stored]]:
    """One row at a time, so that one stored text is in Python at a time."""
    for i in range(batch.num_rows):
        row = batch.slice(i, 1).to_pylist()[0]
        yield row, Stored(codec, row.pop("frames"), row.pop("ends"))


def fill_in_middle(texts: DataFrame, seed: int = SEED, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, frames, ends) of every row of ``store``; the last two are the output."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h1, h2, h3, h4 = (F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4))
    plain = (F.col("n") == 0) | F.col("marked") | (h3 % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    cuts = [f(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)) for f in (F.least, F.greatest)]
    cut = texts.select("doc_id", "n", form.alias("form"), cuts[0].alias("first"), cuts[1].alias("last"), "frames", "ends")

    def ordered(row: dict, text: Stored) -> Stored:
        if row["form"] == "plain":
            return text
        made = Stored(text.codec)
        part = {PREFIX: (0, row["first"]), MIDDLE: (row["first"], row["last"]), SUFFIX: (row["last"], len(text))}
        for mark in MARKS[row["form"]]:
            made.add(mark)
            made.add_part(text, *part[mark])
        return made

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec()
        for batch in batches:
            out = [ordered(row, text) for row, text in _rows(batch, codec)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *_columns(out)], names=batch.schema.names)

    done = cut.mapInArrow(moved, f"doc_id bigint, n bigint, form string, first bigint, last bigint, {FIELDS}")
    cut_form = F.col("form") != "plain"
    return done.select(
        "doc_id",
        "n",
        "form",
        F.when(cut_form, F.col("first")).alias("prefix_chars"),
        F.when(cut_form, F.col("last") - F.col("first")).alias("middle_chars"),
        "frames",
        "ends",
    )


def parts_of(output: Stored, form: str) -> list[tuple[int, int]]:
    """Places in the output of prefix, middle and suffix, found by its marks.

    No mark can overlap another, and none occurs in a text that is cut, so each first occurrence is the one that was put there.
    """
    if form == "plain":
        return [(0, len(output))]
    at, begins = [], 0
    for mark in MARKS[form]:
        at.append(output.find(mark, begins))
        begins = at[-1] + len(mark)
    ends = [*at[1:], len(output)]
    where = {mark: (a + len(mark), b) for mark, a, b in zip(MARKS[form], at, ends, strict=True)}
    return [where[PREFIX], where[MIDDLE], where[SUFFIX]]


def _streamed(out: DataFrame, columns: str, values: Callable[[Stored, str], tuple]) -> DataFrame:
    """The rows of ``out`` with ``values(output, form)`` as columns in place of the frames."""
    names = [c.split()[0] for c in columns.split(", ")]
    kept = [c for c in out.columns if c not in ("frames", "ends")]
    schema = f"{', '.join(f'`{c}` {out.schema[c].dataType.simpleString()}' for c in kept)}, {columns}"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec()
        for batch in batches:
            found = [values(text, row["form"]) for row, text in _rows(batch, codec)]
            added = [pa.array([f[k] for f in found], type=pa.string()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *added], names=[*kept, *names])

    return out.mapInArrow(read, schema)


def texts(out: DataFrame) -> DataFrame:
    """The output of ``fill_in_middle`` as plain strings, in column ``output``."""
    return _streamed(out, "output string", lambda text, form: ("".join(text.stream()),))


def restore(out: DataFrame) -> DataFrame:
    """The first text of each row, rebuilt from output and form, in column ``text``."""
    return _streamed(out, "text string", lambda text, form: ("".join(s for p in parts_of(text, form) for s in text.stream(*p)),))


def digests(out: DataFrame) -> DataFrame:
    """sha256 of the output and of the rebuilt text, from frames streamed in order; neither is ever held as a whole."""

    def sums(text: Stored, form: str) -> tuple[str, str]:
        output, restored = sha256(), sha256()
        for piece in text.stream():
            output.update(piece.encode())
        for part in parts_of(text, form):
            for piece in text.stream(*part):
                restored.update(piece.encode())
        return output.hexdigest(), restored.hexdigest()

    return _streamed(out, "output_sha256 string, restored_sha256 string", sums)


FIM_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS s, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
n AS (
  SELECT doc_id, s, length(s)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t
),
c AS (
  SELECT doc_id, s, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(s, '<P>') OR contains(s, '<S>') OR contains(s, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM n
),
o AS (
  SELECT doc_id, n, form, a, b,
         CASE form WHEN 'plain' THEN s
              WHEN 'psm' THEN '<P>' || substring(s, 1, a) || '<S>' || substring(s, b + 1) || '<M>' || substring(s, a + 1, b - a)
              ELSE '<S>' || substring(s, b + 1) || '<P>' || substring(s, 1, a) || '<M>' || substring(s, a + 1, b - a) END AS out
  FROM c
),
r AS (
  SELECT *, CASE form WHEN 'plain' THEN [out]
                 WHEN 'psm' THEN [split_part(split_part(out, '<P>', 2), '<S>', 1), split_part(out, '<M>', 2),
                                  split_part(split_part(out, '<S>', 2), '<M>', 1)]
                 ELSE [split_part(split_part(out, '<P>', 2), '<M>', 1), split_part(out, '<M>', 2),
                       split_part(split_part(out, '<S>', 2), '<P>', 1)] END AS parts
  FROM o
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(out) AS output_sha256, sha256(array_to_string(parts, '')) AS restored_sha256
FROM r
"""
