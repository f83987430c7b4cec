"""Seekable compressed texts: independent zstandard frames with cumulative counts of code points.

A stored text is two arrays: ``frames``, each of which decompresses alone, and ``ends``, the number of code points up to the end
of each frame. A place in the text is found by bisection of ``ends``, and only the frame that holds it is decompressed. Whole
frames move from one stored text to another as they are. An empty text has no frames.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard

FRAME_UNITS = 1 << 14
LEVEL = 1
FIELDS = "frames array<binary>, ends array<bigint>"
TYPES = (pa.list_(pa.binary()), pa.list_(pa.int64()))


class Codec:
    """A compressor and a decompressor, made once for a task: their set-up costs more than a short text."""

    def __init__(self) -> None:
        self.press, self.open = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()

    def pack(self, text: str) -> bytes:
        return self.press.compress(text.encode())

    def unpack(self, frame: bytes) -> str:
        return self.open.decompress(frame).decode()


@dataclass
class Stored:
    """A stored text. Pieces are added at its end; parts are read from any place."""

    codec: Codec
    frames: list[bytes] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)

    @classmethod
    def of(cls, codec: Codec, text: str, units: int = FRAME_UNITS) -> Stored:
        made = cls(codec)
        for first in range(0, len(text), units):
            made.add(text[first : first + units])
        return made

    def __len__(self) -> int:
        return self.ends[-1] if self.ends else 0

    def add(self, text: str) -> None:
        if text:
            self.frames.append(self.codec.pack(text))
            self.ends.append(len(self) + len(text))

    def add_part(self, of: Stored, begin: int, end: int) -> None:
        """The code points ``begin`` to ``end`` of another stored text: cut frames are decompressed, whole ones only moved."""
        for i in range(*of.span(begin, end)):
            first = of.ends[i - 1] if i else 0
            if begin <= first and of.ends[i] <= end:
                self.frames.append(of.frames[i])
                self.ends.append(len(self) + of.ends[i] - first)
            else:
                self.add(self.codec.unpack(of.frames[i])[max(0, begin - first) : end - first])

    def span(self, begin: int, end: int) -> tuple[int, int]:
        """The range of frames that hold the code points ``begin`` to ``end``."""
        return (bisect_right(self.ends, begin), bisect_left(self.ends, end) + 1) if begin < end else (0, 0)

    def stream(self, begin: int = 0, end: int | None = None) -> Iterator[str]:
        """Those code points in order, a frame at a time."""
        end = len(self) if end is None else end
        for i in range(*self.span(begin, end)):
            first, text = self.ends[i - 1] if i else 0, self.codec.unpack(self.frames[i])
            yield text if begin <= first and self.ends[i] <= end else text[max(0, begin - first) : end - first]

    def find(self, word: str, begin: int = 0) -> int:
        """Place of the first ``word`` from ``begin`` on, over the borders of frames; -1 if there is none."""
        tail, at = "", begin
        for text in self.stream(begin):
            found = (tail + text).find(word)
            if found >= 0:
                return at - len(tail) + found
            at += len(text)
            tail = (tail + text)[max(0, len(tail) + len(text) - len(word) + 1) :]
        return -1
