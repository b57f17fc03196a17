"""Texts as independent zstandard frames with cumulative counts of units and code points.

A unit is a run of ASCII letters or any other single code point. A frame holds up to ``FRAME`` bytes and ends between
two code points. It counts the units that start in it, so a run of letters may go on over any number of frames. The place of
a unit is found by its frame's counts: only that frame is decompressed. Longer stretches are read frame by frame.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import map_arrow, slices, whole_text

FRAME, LEVEL = 1 << 16, 3
FRAMES = "array<struct<first_unit: long, first_char: long, joined: boolean, data: binary>>"
_TYPE = pa.struct([("first_unit", pa.int64()), ("first_char", pa.int64()), ("joined", pa.bool_()), ("data", pa.binary())])
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


def starts(data: np.ndarray, joined: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes start a unit, and which a code point; ``joined``: a letter stands before the first byte."""
    letter = _LETTER[data]
    inside = letter.copy()
    inside[1:] &= letter[:-1]
    inside[:1] &= joined
    points = (data & 0xC0) != 0x80
    return points & ~inside, points


def _cuts(data: np.ndarray, low: int, high: int, size: int) -> list[int]:
    """Starts of the frames of one text, none for an empty one."""
    found = []
    while low < high:
        found.append(low)
        stop = min(low + size, high)
        while stop < high and data[stop] & 0xC0 == 0x80:
            stop -= 1
        low = stop
    return found


def _framed(batch: pa.RecordBatch, size: int, most_bytes: int = 4 << 20) -> list[pa.Array]:
    """Units, code points and frames of each text of column 0. Besides these, memory holds the counts of ``most_bytes`` or of one frame at a time."""
    texts = batch.column(0).cast(pa.large_string())
    _, offsets, buffer = texts.buffers()
    edges = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    cuts = [_cuts(data, low, high, size) for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    first = np.concatenate([[0], np.cumsum([len(c) for c in cuts])]).astype(np.int64)
    lows = np.array([low for c in cuts for low in c], np.int64)
    highs = np.append(lows[1:], edges[-1])[: len(lows)]
    new_row = np.zeros(len(lows) + 1, dtype=bool)
    new_row[first[:-1]] = True
    units, points = np.zeros(len(lows), np.int64), np.zeros(len(lows), np.int64)
    joined = np.zeros(len(lows), dtype=bool)
    at = 0
    while at < len(lows):
        stop = max(at + 1, int(np.searchsorted(highs, lows[at] + most_bytes, side="right")))
        low = int(lows[at])
        before = not new_row[at] and bool(_LETTER[data[low - 1]])
        unit, point = starts(data[low : int(highs[stop - 1])], before)
        # The first byte of a text is a unit's start whatever stands before it in the buffer.
        unit[lows[at:stop][new_row[at:stop]] - low] = True
        units[at:stop] = np.add.reduceat(unit, lows[at:stop] - low, dtype=np.int64)
        points[at:stop] = np.add.reduceat(point, lows[at:stop] - low, dtype=np.int64)
        at = stop
    inner = np.flatnonzero(~new_row[: len(lows)])
    joined[inner] = _LETTER[data[lows[inner] - 1]]
    press = zstandard.ZstdCompressor(level=LEVEL)
    view = memoryview(buffer) if buffer is not None else memoryview(b"")
    packed = [press.compress(view[a:b]) for a, b in zip(lows.tolist(), highs.tolist(), strict=True)]
    before_row = lambda n: np.cumsum(n) - n
    base = np.repeat(first[:-1], np.diff(first))
    upto = [(t := before_row(n)) - t[base] if len(n) else n for n in (units, points)]
    rows = pa.StructArray.from_arrays([pa.array(upto[0]), pa.array(upto[1]), pa.array(joined), pa.array(packed, pa.binary())], fields=list(_TYPE))
    totals = [np.concatenate([[0], np.cumsum(n)]) for n in (units, points)]
    counts = [pa.array(t[first[1:]] - t[first[:-1]]) for t in totals]
    return [*counts, pa.ListArray.from_arrays(pa.array(first, pa.int32()), rows)]


def framed(docs: DataFrame, kept: dict[str, Column], text_column: str = "text", size: int = FRAME) -> DataFrame:
    """(``kept``, n_units, n_points, frames) per row of ``docs``; a null text counts as empty and has no frames. No shuffle."""

    names = [*kept, "n_units", "n_points", "frames"]

    def build(batches):
        for batch in slices(batches, 0):
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *_framed(batch, size)], names=names)

    rows = docs.select(whole_text(text_column).alias("_text"), *[c.alias(n) for n, c in kept.items()])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return map_arrow(rows, build, f"{schema}, n_units long, n_points long, frames {FRAMES}")


class SeekableText:
    """One text from its stored frames (structs as dictionaries, in order)."""

    def __init__(self, frames: list[dict], n_units: int, n_points: int) -> None:
        self.frames, self.n_units, self.n_points = frames, n_units, n_points
        self.first_units = [f["first_unit"] for f in frames]
        self.opened: dict[int, bytes] = {}
        self._press = zstandard.ZstdDecompressor()

    def frame(self, i: int) -> bytes:
        return self.opened[i] if i in self.opened else self._press.decompress(self.frames[i]["data"])

    def place(self, unit: int) -> tuple[int, int, int]:
        """(frame, byte in it, code points before) of the start of a unit; of the end of the text after the last one."""
        if unit >= self.n_units:
            return len(self.frames), 0, self.n_points
        # Frames in which no unit starts share their count with the next one: the last of those is meant.
        i = bisect_right(self.first_units, unit) - 1
        if i not in self.opened:
            self.opened[i] = self.frame(i)
        info, data = self.frames[i], np.frombuffer(self.opened[i], np.uint8)
        unit_starts, points = starts(data, info["joined"])
        byte = int(np.flatnonzero(unit_starts)[unit - info["first_unit"]])
        return i, byte, info["first_char"] + int(np.count_nonzero(points[:byte]))

    def read(self, low: tuple[int, int, int] | None = None, high: tuple[int, int, int] | None = None) -> Iterator[bytes]:
        """The bytes between two places, in order, a frame at a time."""
        first, start, _ = low or (0, 0, 0)
        last, stop, _ = high or (len(self.frames), 0, 0)
        for i in range(first, min(last + 1, len(self.frames))):
            if i == last and not stop:
                break
            data = self.frame(i)
            yield data[start if i == first else 0 : stop if i == last else None]


class SeekableBytes:
    """Bytes written once in order and kept as frames with cumulative sizes; reads open only the frames they need."""

    def __init__(self, size: int = FRAME) -> None:
        self.size, self.first, self.frames, self.held, self.total = size, [], [], bytearray(), 0
        self._press, self._open = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()

    def write(self, chunk: bytes) -> None:
        self.held += chunk
        self.total += len(chunk)
        if len(self.held) >= self.size:
            self._close()

    def _close(self) -> None:
        self.first.append(self.total - len(self.held))
        self.frames.append(self._press.compress(bytes(self.held)))
        self.held = bytearray()

    def read(self, low: int = 0, high: int | None = None) -> Iterator[bytes]:
        if self.held:
            self._close()
        high = self.total if high is None else high
        for i in range(max(0, bisect_right(self.first, low) - 1), len(self.frames)):
            at = self.first[i]
            if at >= high:
                return
            yield self._open.decompress(self.frames[i])[max(0, low - at) : high - at]
