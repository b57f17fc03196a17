"""Fill-in-the-middle documents made from seekable compressed frames.

Texts are stored once as frames with cumulative unit counts (``seekable.py``). The cuts of a document are units chosen by hashes of its
id; to place them, only the frames in which they lie are decompressed. The rearranged text is streamed from the ordered
frames, into its digest or into the text itself. Nothing is shuffled: each row is cut, arranged and checked where it is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .seekable import SeekableBytes, SeekableText, framed
from .tables import map_arrow, stored, whole_text

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Texts of 100 that stay plain, and of 100 others that put the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
#: Rows opened at a time; one row's frames are small beside its text.
ROWS = 64


def _hash(id_column: str, seed: int, group: int) -> Column:
    """A number of 32 bits from one group of eight digits of the id's digest; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def stored_frames(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The stored table (doc_id, marked, n_units, n_points, frames); ``marked``: the text holds one of the markers."""
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(whole_text(text_column), F.lit(marker))
    found = framed(docs, {"doc_id": F.col(id_column), "marked": marked}, text_column)
    return stored(found, "text-frames")


def planned(frames: DataFrame, seed: int = 1, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``frames`` with form, low and high: the units at which prefix and middle end."""
    h = [_hash("doc_id", seed, g) for g in range(4)]
    cuts = [x % (F.col("n_units") + 1) for x in h[:2]]
    whole = (F.col("n_units") == 0) | F.col("marked") | (h[2] % 100 >= 100 - plain)
    form = F.when(whole, "plain").when(h[3] % 100 < suffix_first, "spm").otherwise("psm")
    return frames.withColumns({"form": form, "low": F.least(*cuts), "high": F.greatest(*cuts)})


def arranged(text: SeekableText, form: str, low: tuple | None, high: tuple | None) -> Iterator[bytes]:
    """The bytes of the output, in order; ``low`` and ``high`` are places of ``text``, unused for plain ones."""
    if form == "plain":
        yield from text.read()
        return
    head, tail = (PREFIX.encode(), text.read(None, low)), (SUFFIX.encode(), text.read(high, None))
    for marker, stretch in [*((head, tail) if form == "psm" else (tail, head)), (MIDDLE.encode(), text.read(low, high))]:
        yield marker
        yield from stretch


class Rebuilder:
    """The text again, from the output and its form alone: the output is kept as frames while its markers are looked for."""

    def __init__(self, form: str) -> None:
        self.form, self.kept, self.at, self.tail = form, SeekableBytes(), {}, b""

    def write(self, chunk: bytes) -> None:
        if self.form != "plain":
            seen = self.tail + chunk
            for marker in (PREFIX, SUFFIX, MIDDLE):
                if marker not in self.at and (found := seen.find(marker.encode())) >= 0:
                    self.at[marker] = self.kept.total - len(self.tail) + found
            self.tail = seen[-2:]
        self.kept.write(chunk)

    def read(self) -> Iterator[bytes]:
        if self.form == "plain":
            yield from self.kept.read()
            return
        starts = sorted((at, marker) for marker, at in self.at.items())
        stops = [at for at, _ in starts[1:]] + [self.kept.total]
        stretch = {marker: (at + len(marker), stop) for (at, marker), stop in zip(starts, stops, strict=True)}
        for marker in (PREFIX, MIDDLE, SUFFIX):
            yield from self.kept.read(*stretch[marker])


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(doc_id, n, form, text, low place, high place) per planned row, a few rows in memory at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            columns = [c.to_pylist() for c in batch.slice(start, ROWS).columns]
            for doc_id, n_units, n_points, frames, form, low, high in zip(*columns, strict=True):
                text = SeekableText(frames, n_units, n_points)
                places = (None, None) if form == "plain" else (text.place(low), text.place(high))
                yield doc_id, n_units, form, text, *places


def _lengths(form: str, low: tuple | None, high: tuple | None) -> tuple:
    return (None, None) if form == "plain" else (low[2], high[2] - low[2])


def _mapped(frames: DataFrame, function, columns: str, seed: int, plain: int, suffix_first: int, lot_bytes: int = 4 << 20) -> DataFrame:
    """The plan's rows with the texts that ``function`` makes of each; they leave the worker in lots of about ``lot_bytes``."""
    rows = planned(frames, seed, plain, suffix_first).select("doc_id", "n_units", "n_points", "frames", "form", "low", "high")
    fixed = f"doc_id {frames.schema['doc_id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long"
    kinds = [to_arrow_type(frames.schema["doc_id"].dataType), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def lot(held: list[tuple]) -> pa.RecordBatch:
        values = list(zip(*held, strict=True))
        types = [*kinds, *[pa.string()] * (len(values) - len(kinds))]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=[f"c{i}" for i in range(len(values))])

    def run(batches):
        held, size = [], 0
        for doc_id, n, form, text, low, high in _opened(batches):
            lengths = (None, None) if form == "plain" else (low[2], high[2] - low[2])
            made = function(text, form, low, high)
            held.append((doc_id, n, form, *lengths, *made))
            size += sum(map(len, made))
            if size >= lot_bytes:
                yield lot(held)
                held, size = [], 0
        if held:
            yield lot(held)

    return map_arrow(rows, run, f"{fixed}, {columns}")


def fill_in_middle(docs: DataFrame, seed: int = 1, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST, id_column: str = "doc_id"):
    """(doc_id, n, form, prefix_chars, middle_chars, output): each text of ``docs`` rearranged.

    Rules for odd rows are those of ``digests``.
    """

    def written(text, form, low, high):
        return (b"".join(arranged(text, form, low, high)).decode("utf-8", "replace"),)

    found = _mapped(stored_frames(docs, id_column), written, "output string", seed, plain, suffix_first)
    return found.withColumnRenamed("doc_id", id_column)


def digests(docs: DataFrame, seed: int = 1, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST, id_column: str = "doc_id"):
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) for every row of ``docs``.

    ``n`` counts units. The output is streamed frame by frame, however long the text is; a task holds one text's compressed
    output at a time. ``restored_sha256`` is of the text rebuilt from that output and the form. A null or empty text is plain, with the
    digest of an empty one, and so is a text that holds a marker. A null id counts as an empty one; rows with repeated ids
    are cut alike and stay rows of their own. Other columns are not read; an empty table gives an empty result.
    """

    def digested(text, form, low, high):
        made, again, rebuilder = hashlib.sha256(), hashlib.sha256(), Rebuilder(form)
        for chunk in arranged(text, form, low, high):
            made.update(chunk)
            rebuilder.write(chunk)
        for chunk in rebuilder.read():
            again.update(chunk)
        return made.hexdigest(), again.hexdigest()

    found = _mapped(stored_frames(docs, id_column), digested, "output_sha256 string, restored_sha256 string", seed, plain, suffix_first)
    return found.withColumnRenamed("doc_id", id_column)
