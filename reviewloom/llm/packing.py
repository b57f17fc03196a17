"""Packing of documents into sequences of a fixed number of tokens.

Tokenizing gives a narrow table of pieces. Their histogram (at most ``capacity`` rows) goes to the
driver, where ``completion.pack`` decides how many sequences of which content there are. The
pieces of one length are numbered on the cluster, in shares so that no task holds a hot length whole, and a
piece's number decides its sequence and place: nothing but the histogram and the fillings
ever passes the driver.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .completion import Filling, pack
from .tables import map_arrow, slices, stored, whole_text
from .tokens import encoder

#: Rows of one length that one task numbers.
SHARE_ROWS = 16_384


def cut_pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, and ids as bytes if wanted) for every row of ``docs``.

    A row's ids are its whole text's, without special tokens, and ``end_id``; a null text is empty, so it has one
    piece with ``end_id`` alone. More than ``capacity`` ids are cut into pieces of that length, of which the
    first may be shorter.
    """

    def pieces(batches):
        tokens = encoder(path)
        end = int(end_id).to_bytes(4, "little")
        for batch in slices(batches, 1):
            at, numbers, starts, lengths, sums, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                data = b"".join(ids.astype("<u4", copy=False).tobytes() for ids in tokens.encode(text)) + end
                total = len(data) // 4
                first = total % capacity or capacity
                for number, start in enumerate([0, *range(first, total, capacity)]):
                    length = capacity if number else first
                    piece = data[4 * start : 4 * (start + length)]
                    at.append(row)
                    numbers.append(number)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(piece))
                    if with_ids:
                        ids.append(piece)
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()),
                       pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", whole_text().alias("text"))
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return map_arrow(rows, pieces, schema)


def slots(plan: list[Filling]) -> dict[int, np.ndarray]:
    """Per length its slots in order: (first number, first sequence, pieces per sequence, offset).

    A plan has at most as many fillings as there are lengths, plus those of the search's last steps, and a filling
    at most 63 different lengths for 2048 tokens, so the slots stay small whatever the data.
    """
    taken: dict[int, int] = defaultdict(int)
    found: dict[int, list] = defaultdict(list)
    sequence = 0
    for times, content in plan:
        offset = 0
        for length, each in sorted(Counter(content).items(), reverse=True):
            found[length].append((taken[length], sequence, each, offset))
            taken[length] += times * each
            offset += length * each
        sequence += times
    return {length: np.array(rows, dtype=np.int64).T for length, rows in found.items()}


def numbered(pieces: DataFrame, share_rows: int = SHARE_ROWS) -> DataFrame:
    """``pieces`` with ``_rank``, a number from 0 among the pieces of equal length.

    A length is cut into shares by a hash of the piece; shares are numbered apart and moved up by the sizes of
    the shares before them. Equal rows may swap numbers, which changes nothing.
    """
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("_n"))
    shares = counts.select("length", F.ceil(F.col("_n") / share_rows).alias("_shares"))
    spread = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("_shares"))
    # One row per length: at most as many as a sequence has tokens.
    dealt = pieces.join(F.broadcast(shares), "length").withColumn("_share", spread).drop("_shares")
    sizes = dealt.groupBy("length", "_share").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.partitionBy("length").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(
        F.col("length").alias("_l"), F.col("_share").alias("_s"), F.coalesce(before, F.lit(0)).alias("_before")
    )
    own = F.row_number().over(Window.partitionBy("length", "_share").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = dealt.withColumn("_own", own)
    met = ranked.join(sizes, (F.col("length") == F.col("_l")) & (F.col("_share") == F.col("_s")))
    return met.withColumn("_rank", F.col("_own") + F.col("_before") - 1).drop("_share", "_own", "_l", "_s", "_before")


def place_pieces(pieces: DataFrame, capacity: int = 2048, nodes: int = 20_000) -> DataFrame:
    """Stored ``pieces`` with sequence_id and offset."""
    histogram = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    where = pieces.sparkSession.sparkContext.broadcast(slots(pack(histogram, capacity, nodes)))

    def placed(batches):
        table = where.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                rows = length == n
                first, base, each, start = table[n]
                slot = np.searchsorted(first, rank[rows], side="right") - 1
                within = rank[rows] - first[slot]
                sequence[rows] = base[slot] + within // each[slot]
                offset[rows] = start[slot] + within % each[slot] * n
            kept = [batch.column(c) for c in batch.schema.names if c != "_rank"]
            names = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    ranked = numbered(pieces)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "_rank")
    found = map_arrow(ranked, placed, f"{schema}, sequence_id long, offset long")
    return found.select(*pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids if wanted): one row per piece.

    Every row of ``docs`` is packed whole, whatever its id: rows that repeat an id, or have none, are
    documents of their own. Other columns are not read. An empty table gives an empty result. Sequences have no
    gaps before their end.
    """
    return place_pieces(stored(cut_pieces(docs, path, capacity, end_id, with_ids), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence as little-endian bytes, from pieces with ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"))
