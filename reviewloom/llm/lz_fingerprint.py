"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed front to back into the shortest phrases not seen before in it; texts that would compress
well together share many phrases. The phrases are hashed, and the ``K`` smallest different hashes are
the fingerprint. The likeness of two fingerprints estimates the Jaccard similarity of the two phrase sets: of the
``K`` smallest hashes of both together, the share that both have. It is exact for small sets.

To compare a text with an edited one, whose end comes from the next document, the parse goes on from where both
are still the same. Documents meet their successors by cutting the order into ranges: a range is sorted in one
task, and the first document of the range below is sent along, so the texts are shuffled once.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import map_arrow, slices, whole_text

K = 128
#: UTF-8 bytes of text that one range holds, about.
RANGE_BYTES = 8 << 20
#: Quantiles of the ids that are asked for; each range between two is sliced further as the data grow.
COARSE = 1024
#: Ranges whose two numbers are broadcast (about 200 MB).
MOST_SENT = 4_000_000


def parse(data: bytes, start: int, begin: int, phrases: set[bytes]) -> int:
    """Add the phrases of ``data``, the one that begins at ``begin`` known to be old up to ``start``; where the last begins.

    A rest at the end that is an old phrase adds nothing.
    """
    add = phrases.add
    for end in range(start + 1, len(data) + 1):
        phrase = data[begin:end]
        if phrase not in phrases:
            add(phrase)
            begin = end
    return begin


def _spread(values: np.ndarray) -> np.ndarray:
    """A published 32-bit finaliser (murmur3), one to one."""
    values = (values ^ (values >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    values = (values ^ (values >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return values ^ (values >> np.uint32(16))


def smallest(phrases: Iterable[bytes], k: int = K) -> np.ndarray:
    """The ``k`` smallest different hashes in ascending order."""
    hashes = np.unique(_spread(np.fromiter(map(zlib.crc32, phrases), np.uint32)))
    return hashes[:k]


def as_text(hashes: np.ndarray) -> str:
    """Eight hex digits a hash, ascending; the empty text has the empty fingerprint."""
    return hashes.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity of two phrase sets, from 0 to 1; that of two empty ones is 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:k]
    return float((np.isin(both, a) & np.isin(both, b)).sum() / len(both))


def fingerprint(text: str, k: int = K) -> np.ndarray:
    phrases: set[bytes] = set()
    data = text.encode()
    parse(data, 0, 0, phrases)
    return smallest(phrases, k)


def edited(text: str, following: str) -> tuple[str, str]:
    """The text without its last third, and the part of the next document that replaces it."""
    third = len(text) // 3
    return text[: len(text) - third], following[:third]


def _both(text: str, following: str, k: int) -> tuple[np.ndarray, np.ndarray, str]:
    """Fingerprints of a text and of its edited form, and the edited form; the common part is parsed once."""
    head, tail = edited(text, following)
    same, phrases = head.encode(), set()
    begin = parse(same, 0, 0, phrases)
    changed = head + tail
    if changed == text:
        rest = phrases
    else:
        rest = phrases.copy()
        parse(changed.encode(), len(same), begin, rest)
    parse(text.encode(), len(same), begin, phrases)
    own = smallest(phrases, k)
    return own, own if rest is phrases else smallest(rest, k), changed


def _range_of(df: DataFrame, edges: list[int], slices_each: int) -> DataFrame:
    """``df`` with ``coarse``, how many of the ascending ``edges`` are at or below ``id``, and ``range``, which cuts it in equal slices.

    ``edges`` begin with the smallest id and end with the largest; rows without an id come before all. Neither step ever puts a larger id into a smaller range.
    """
    df = df.withColumn("coarse", F.lit(0))
    inner, held = edges[1:-1], F.lit(edges).cast("array<long>")
    step = 1 << max(0, len(inner).bit_length() - 1)
    while inner and step:
        ahead = F.coalesce(F.get(F.lit(inner).cast("array<long>"), F.col("coarse") + (step - 1)) <= F.col("id"), F.lit(False))
        df = df.withColumn("coarse", F.col("coarse") + F.when(ahead, step).otherwise(0))
        step //= 2
    low, high = (F.get(held, F.col("coarse") + i).cast("double") for i in (0, 1))
    part = (F.col("id").cast("double") - low) / F.greatest(high - low, F.lit(1.0)) * slices_each
    part = F.least(F.greatest(F.floor(part), F.lit(0)), F.lit(slices_each - 1))
    return df.withColumn("range", F.col("coarse").cast("long") * slices_each + part.cast("long"))


def _lenders(rows: DataFrame, above: dict[int, int]) -> DataFrame:
    """(top, borrower): per range its largest id, whose first row goes to the next higher range that has rows too.

    ``above`` has per coarse range the first range of the next one with rows.
    """
    ranges = rows.groupBy("coarse", "range").agg(F.max("id").alias("top"))
    following = F.lead("range").over(Window.partitionBy("coarse").orderBy("range"))
    onward = F.get(F.lit([above.get(c, 0) for c in range(max(above, default=0) + 1)]).cast("array<long>"), F.col("coarse"))
    return ranges.select("top", F.coalesce(following, onward).alias("borrower"))


def _with_first_of_next(rows: DataFrame, range_bytes: int, coarse: int) -> DataFrame:
    """Rows with ``range`` and ``lent``: each range in one partition and in order, after it the first rows of the range below.

    There is a range to about ``range_bytes`` of text, however many that are: up to ``coarse`` ranges from approximate quantiles of the
    ids, each cut into equal slices of its ids. Only the quantiles and one range for each come to the driver. A range may
    have any size: it is sorted by Spark and read as a stream.
    """
    quantiles = F.array(*[F.lit(i / coarse) for i in range(1, coarse)])
    low = F.min(F.when(~F.col("none"), F.col("id"))).alias("low")
    figures = [F.sum(F.octet_length("text").cast("long")).alias("bytes"), low, F.max("id").alias("high")]
    seen = rows.agg(*figures, F.percentile_approx("id", quantiles, 10 * coarse).alias("edges")).head()
    shares = (seen["bytes"] or 0) // range_bytes + 1
    wanted = min(coarse, shares)
    taken = [seen["edges"][i * coarse // wanted - 1] for i in range(1, wanted)] if seen["edges"] else []
    low, high = seen["low"] or 0, seen["high"] or 0
    edges = [low, *sorted({e for e in taken if e > low}), high]
    ranged = _range_of(rows, edges, -(-shares // wanted))
    firsts = {r["coarse"]: r["first"] for r in ranged.groupBy("coarse").agg(F.min("range").alias("first")).collect()}
    held = sorted(firsts)
    above = {c: firsts[held[(i + 1) % len(held)]] for i, c in enumerate(held)}
    lenders = _lenders(ranged, above)
    # Two numbers for each range; beyond ``MOST_SENT`` Spark joins the two by id.
    lenders = F.broadcast(lenders) if len(edges) * -(-shares // wanted) <= MOST_SENT else lenders
    met = ranged.join(lenders, F.col("id") == F.col("top"), "left")
    own = F.struct(F.col("range"), F.lit(False).alias("lent"))
    lent = F.struct(F.col("borrower").alias("range"), F.lit(True).alias("lent"))
    to = F.when(F.col("borrower").isNotNull(), F.array(own, lent)).otherwise(F.array(own))
    dealt = met.withColumn("to", F.explode(to)).select("to.range", "to.lent", "id", "none", "text")
    return dealt.repartition("range").sortWithinPartitions("range", "lent", F.desc("id"), "none", F.desc("text"))


def compare_next(docs: DataFrame, k: int = K, range_bytes: int = RANGE_BYTES, coarse: int = COARSE) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row of ``docs``.

    The next document has the next smaller id; after the last comes the first, so a single document follows itself.
    Rows that repeat an id come in descending order of their texts, rows without an id after all others. A null
    text is empty: its edited text is empty too, and the two are alike (1.0). An empty table gives an empty
    result. Other columns are not read. Ids are whole numbers or texts that spell one.
    """
    none = F.col("doc_id").isNull()
    # Without an id: below all ids, and told from the smallest by ``none``.
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"), none.alias("none"), whole_text().alias("text"))

    def compared(batches):
        pending = at = None  # text of the last row, its range, id
        waiting = None  # what is known of the row before: all but how near the next one is
        done: list[tuple] = []

        def batch():
            columns = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        def finish(own) -> None:
            row, before, changed = waiting
            done.append((*row, as_text(before), as_text(changed), likeness(before, changed, k), likeness(before, own, k)))

        for piece in slices(batches, 4):
            for place, lent, doc, absent, text in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                if place != at:
                    pending, waiting, at = None, None, place
                if lent and pending is None:
                    continue  # only the first of them follows
                if pending is not None:
                    own, changed, edit = _both(pending[1], text, k)
                    if waiting is not None:
                        finish(own)
                    sha = hashlib.sha256(edit.encode()).hexdigest()
                    waiting = ((pending[0], len(pending[1]), sha), own, changed)
                pending = (None if absent else doc, text)
                if lent:
                    finish(fingerprint(text, k))
                    pending = waiting = None
            if done:
                yield batch()

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, ["long", "long", "string", "string", "string", "double", "double"], strict=True))
    found = map_arrow(_with_first_of_next(rows, range_bytes, coarse), compared, schema)
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
