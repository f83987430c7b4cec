"""Byte-level BPE encoding and decoding by tree concatenation.

A text is unsplit between two special tokens. A short one is encoded at once. A long one is halved until its parts are short;
the parts are encoded in parallel and joined pairwise up the tree. For a join, a window around it is encoded again and grows
until both sides agree exactly with what it gives:

* A token of a space and another visible ASCII byte always begins a piece of the pre-tokenizer, whose scan looks ahead
  only. If the window begins at such a token of the left side, and gives one that the right side has at the same place,
  everything before and after is as in the encoding of the joined text.
* Within one run of letters, digits or signs, merges decide. A sequence of tokens is the encoding of its bytes if every two
  neighbours are, so it is enough that the window's first and last tokens are those of the two sides.

If the sides never agree, the window ends as the whole of both, which is right by definition.

The vocabulary file is read from a path on every worker. Its merges must be in the order of their identifiers, which is
checked; then the compiled merge loop that takes ranks gives the file's encoding.

Defined results: a null text is an empty text, with no tokens; null tokens decode to an empty text. Bytes that are no UTF-8
decode to U+FFFD. Rows with equal identifiers are encoded one by one; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text

# Fixed value: the pre-tokenizer of byte-level vocabularies of this kind.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF_CHARS = 8192
ROWS = 200  # that are Python objects at a time
WINDOW_TOKENS = 8
MARGIN_BYTES = 16  # more than the pre-tokenizer looks ahead
_RUN = regex.compile(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}']+")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable bytes for themselves, the others from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, leaf_chars: int = LEAF_CHARS, threads: int = 2):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        plain = before == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": before.get("trim_offsets"), "use_regex": True}
        if model["type"] != "BPE" or not plain or spec["normalizer"] or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        letters = byte_letters()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [model["vocab"][a + b] for a, b in pairs]
        if order != sorted(order):
            raise ValueError(f"{path}: merges are not in the order of their identifiers")
        self.special = added
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.bytes_of = [b""] * (max(*ranks.values(), *added.values(), 0) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        for token, i in added.items():
            self.bytes_of[i] = token.encode()
        self.begins = [len(b) > 1 and b[0] == 0x20 and 0x20 < b[1] < 0x7F for b in self.bytes_of]
        self.inside = [bool(b) and b[0] & 0xC0 == 0x80 for b in self.bytes_of]
        self.special_ids = set(added.values())
        self.leaf_chars, self.threads = leaf_chars, threads

    @cached_property
    def merge(self) -> Callable[[str], list[int]]:
        """Encoding of a text as a whole; built at the first use, since decoding needs none."""
        ranks = {token: i for i, token in enumerate(self.bytes_of) if token and i not in self.special_ids}
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    @cached_property
    def pool(self) -> ThreadPoolExecutor:
        return ThreadPoolExecutor(self.threads)

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if self.split_special is None or not self.split_special.search(text):
            return self.unsplit(text)
        out: list[int] = []
        for i, part in enumerate(self.split_special.split(text)):
            out += [self.special[part]] if i % 2 else self.unsplit(part) if part else []
        return out

    def unsplit(self, text: str) -> list[int]:
        """Encoding of a text without special tokens."""
        if len(text) <= self.leaf_chars:
            return self.merge(text)
        parts = [text]
        while max(map(len, parts)) > self.leaf_chars:
            parts = [half for p in parts for half in (p[: len(p) // 2], p[len(p) // 2 :])]
        level = list(self.pool.map(self.merge, parts))
        while len(level) > 1:
            level = list(self.pool.map(self.join, level[::2], level[1::2]))
        return level[0]

    def text_of(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the text of ``left`` followed by that of ``right``, each encoded for itself."""
        width = WINDOW_TOKENS
        while True:
            begin, end = max(0, len(left) - width), min(len(right), width)
            while begin > 0 and self.inside[left[begin]]:
                begin -= 1
            while end < len(right) and self.inside[right[end]]:
                end += 1
            if begin > 0 and end < len(right):
                window = (self.text_of(left[begin:]) + self.text_of(right[:end])).decode()
                if _RUN.fullmatch(window):
                    again = self.merge(window)
                    if again[0] == left[begin] and again[-1] == right[end - 1]:
                        return left[:begin] + again + right[end:]
                    width *= 2
                    continue
            while begin > 0 and not (self.begins[left[begin]] and len(self.text_of(left[begin:])) >= MARGIN_BYTES):
                begin -= 1
            head = self.text_of(left[begin:])
            window = head + self.text_of(right[:end])
            again = self.merge(window.decode())
            if end == len(right) and (begin == 0 or again[0] == left[begin]):
                return left[:begin] + again
            if begin == 0 or again[0] == left[begin]:
                there = self.places(right[:end], len(head))
                for at, i in self.places(again, 0).items():
                    if len(head) <= at <= len(window) - MARGIN_BYTES and at in there:
                        return left[:begin] + again[:i] + right[there[at] :]
            width *= 2

    def places(self, ids: list[int], at: int) -> dict[int, int]:
        """Byte position and index of the tokens that begin a piece for sure."""
        out = {}
        for i, t in enumerate(ids):
            if self.begins[t]:
                out[at] = i
            at += len(self.bytes_of[t])
        return out

    def decode(self, ids: list[int]) -> str:
        return self.text_of(ids).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def codec(path: str, leaf_chars: int) -> Codec:
    return Codec(path, leaf_chars)


def _lists(rows: list[list[int]]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate([np.zeros(0, dtype=np.int32), *(np.array(r, dtype=np.int32) for r in rows)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.int32()))


def bpe_encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path, leaf_chars).encode
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                ids = _lists([encode(t.as_py()) for t in part.column("text")])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], names=["doc_id", "ids"])

    return id_and_text(docs, doc_id, text).mapInArrow(run, "doc_id bigint, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) of the rows of ``bpe_encode``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = codec(path, LEAF_CHARS).decode
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                texts = pa.array([decode(x.values.to_numpy().tolist()) if x.is_valid else "" for x in part.column("ids")], type=pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), texts], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, text string")


def token_digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the rows of ``bpe_decode``."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
