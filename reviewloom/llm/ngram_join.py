"""Exact Jaccard self-join over word n-grams, and the groups that it links.

Documents with equal sets are one class. Any two sets that are similar enough share an element among the
first few of a common order of all elements (the prefix), so classes meet in tiles, one per prefix element;
large ones are cut by size bands, of which only equal and adjacent ones meet. In a tile, hashed bitmaps decide first: each element flips one bit, and the number of bits in
which two bitmaps differ bounds the elements that only one set has from below, hence the overlap from
above. Pairs that pass are settled by an exact intersection of the sorted arrays.

A tile of n classes has n*n/2 pairs, and a group of near copies is one large tile. In a tile of up to ``FEW``
classes all pairs meet at once. Larger tiles are worked in rounds. First each class meets its neighbour in size
and the first of its size band only. Then groups not linked yet are looked at: a tile proposes no more
pairs than connect its groups. At last all pairs of groups that are still apart meet: no link between groups
is lost, while links inside a group that is connected already aren't asked for. That is all ``linked_groups`` and
``first_of_groups`` need; ``links`` and ``link_counts`` go on to settle the pairs inside each group.

The order puts frequent elements last, which keeps tiles small. Which elements are frequent comes
from a sample of the texts and is held as a bitmap of fixed size; it decides the order alone, never the result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .tables import SPACES, map_arrow, release, slices, stored, whole_text
from .words import shingle_sets, words_of

#: One text in SAMPLED is looked at for frequent shingles; SEEN texts of the sample make one frequent.
SAMPLED, SEEN = 32, 8
#: Bits of the tables of frequent shingles and of wanted texts: 4 MB each, whatever the data.
TABLE_BITS = 1 << 25
#: Classes of a tile that all meet at once, and of a larger tile that meet in one block.
FEW, BLOCK = 8, 512
#: Elements of one share of sets, 64 MB; a task that settles pairs holds two shares at a time.
HELD = 1 << 23
SLICE = 1 << 20


def most_apart(total, percent: int):
    """Largest number of elements in one of two sets only, for sets of ``total`` elements together that link."""
    least_common = -(-percent * total // (100 + percent))
    return total - 2 * least_common


def fit(a, b, percent: int):
    """Whether sizes allow a link."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def bitmap(values: np.ndarray) -> bytes:
    """Parity of the elements per bit; the width grows with the set, in powers of two."""
    width = min(2048, max(64, 1 << (len(values) - 1).bit_length()))
    counts = np.bincount((values >> np.uint64(20)).astype(np.int64) & (width - 1), minlength=width)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(value: int, width: int, to: int) -> int:
    """A bitmap as if made with a smaller width."""
    while width > to:
        width //= 2
        value = (value ^ (value >> width)) & ((1 << width) - 1)
    return value


def apart(a: bytes, b: bytes) -> int:
    """Bits in which two bitmaps differ."""
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    width = min(len(a), len(b)) * 8
    return (_folded(x, len(a) * 8, width) ^ _folded(y, len(b) * 8, width)).bit_count()


def _in_table(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values.astype(np.int64) & (TABLE_BITS - 1)
    return (table[at >> 6] >> (at & 63)) & 1 == 1


def bit_table(values: DataFrame) -> np.ndarray:
    """Table of ``TABLE_BITS`` bits with those of the column ``v`` set; at most 4 MB come to the driver."""
    at = values.select(F.col("v").bitwiseAND(F.lit(TABLE_BITS - 1)).alias("p"))
    bit = F.expr("shiftleft(1L, cast(p & 63 as int))")
    words = at.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(bit).alias("bits"))
    table = np.zeros(TABLE_BITS // 64, np.int64)
    found = words.toArrow()
    table[found.column("w").to_numpy()] = found.column("bits").to_numpy()
    return table


def _sets(batch: pa.RecordBatch, column: int, size: int) -> Iterator[np.ndarray]:
    return shingle_sets(words_of(batch.column(column)), size)


def frequent_shingles(texts: DataFrame, size: int) -> np.ndarray:
    """Table of the shingles in at least ``SEEN`` different texts of the sample."""

    def shingles(batches):
        for batch in slices(batches, 0, SLICE):
            for values in _sets(batch, 0, size):
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64))], names=["v"])

    chosen = texts.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0).distinct()
    counted = map_arrow(chosen, shingles, "v long").groupBy("v").count()
    return bit_table(counted.where(F.col("count") >= SEEN).select("v"))


def signatures(docs: DataFrame, size: int, percent: int, table) -> DataFrame:
    """(doc_id, hash, n, sig, bits, prefix) per row of (doc_id, text); sig is null for an empty set.

    ``sig`` is a 128-bit hash of the whole set: equal sets have equal ones.
    """

    def signed(batches):
        frequent = table.value
        for batch in slices(batches, 1, SLICE):
            sizes, sigs, bits, lengths, prefixes = [], [], [], [0], []
            for values in _sets(batch, 1, size):
                n = len(values)
                sizes.append(n)
                sigs.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest() if n else None)
                bits.append(bitmap(values) if n else None)
                wanted = n - -(-percent * n // 100) + 1 if n else 0
                late = _in_table(frequent, values)
                prefixes.append(np.concatenate([values[~late][:wanted], values[late]])[:wanted])
                lengths.append(lengths[-1] + wanted)
            flat = np.concatenate(prefixes).view(np.int64) if prefixes else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat))
            columns = [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()), pa.array(bits, pa.binary()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "hash", "n", "sig", "bits", "prefix"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    return map_arrow(rows, signed, f"doc_id {kind}, hash long, n long, sig binary, bits binary, prefix array<long>")


def classes(signed: DataFrame) -> DataFrame:
    """(node, sig, doc_id, hash, n, bits, prefix): a row per different set, numbered; stored.

    ``doc_id`` is the smallest of the class, ``hash`` that of the text which it has.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("first")
    same = [F.any_value(c).alias(c) for c in ("n", "bits", "prefix")]
    found = signed.where("sig IS NOT NULL").groupBy("sig").agg(first, *same)
    found = found.select(F.monotonically_increasing_id().alias("node"), "sig", "first.doc_id", "first.hash", "n", "bits", "prefix")
    return stored(found, "classes")


def _few(token: np.ndarray, node: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of fitting sizes with equal tokens, for runs of few rows."""
    left, right = [], []
    for d in range(1, min(FEW, len(token))):
        both = np.flatnonzero((token[d:] == token[:-d]) & fit(n[d:], n[:-d], percent))
        left.append(node[both])
        right.append(node[both + d])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


class _Run:
    """A large run that may go on in the next batch: its last row, and the first of the last row's size band."""

    def __init__(self) -> None:
        self.token = self.node = self.n = self.band = self.centre = self.centre_n = None

    def rows(self, token, node, n, band, percent: int):
        """``before`` and ``centre`` (-1 for none) of rows of large runs, the first of which may continue this one."""
        size = len(token)
        begins = np.ones(size, bool)
        begins[1:] = (token[1:] != token[:-1]) | (band[1:] != band[:-1])
        before = np.full(size, -1, np.int64)
        before[1:] = np.where((token[1:] == token[:-1]) & fit(n[1:], n[:-1], percent), node[:-1], -1)
        head = np.maximum.accumulate(np.where(begins, np.arange(size), 0))
        centre, centre_n = node[head], n[head]
        if self.token is not None and token[0] == self.token:
            if fit(n[0], self.n, percent):
                before[0] = self.node
            if band[0] == self.band:
                mine = head == 0
                centre, centre_n = np.where(mine, self.centre, centre), np.where(mine, self.centre_n, centre_n)
        self.token, self.node, self.n, self.band = token[-1], node[-1], n[-1], band[-1]
        self.centre, self.centre_n = centre[-1], centre_n[-1]
        return before, np.where((centre != node) & fit(n, centre_n, percent), centre, -1)


def tiles(found: DataFrame, percent: int) -> DataFrame:
    """(token, node, n, before, centre): first pairs of all tiles, and the rows of large ones; stored.

    Rows of a token come in order of size. Up to ``FEW`` of them give all their pairs as rows without a token, (node,
    before). Of more, each row has the row before and the first of its size band, null where sizes don't fit; only
    the last row of such a run is kept from batch to batch.
    """
    step = _step(percent)

    def shared(batches):
        names = ["token", "node", "n", "before", "centre"]
        held = [np.zeros(0, np.int64)] * 3  # rows of the last run while it is small
        large = _Run()

        def out(small, rows):
            (a, b), (token, node, n, before, centre) = _few(*small, percent), rows
            none = np.zeros(len(a), np.int64)
            missing = np.concatenate([np.ones(len(a), bool), np.zeros(len(token), bool)])
            columns = [
                pa.array(np.concatenate([none, token]), mask=missing), pa.array(np.concatenate([a, node])), pa.array(np.concatenate([none, n]), mask=missing),
                pa.array(np.concatenate([b, before]), mask=np.concatenate([none > 0, before < 0])),
                pa.array(np.concatenate([none, centre]), mask=np.concatenate([none == 0, centre < 0])),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        def worked(columns, last: bool):
            token, node, n = columns
            if not len(token):
                return None
            starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(token)]]))
            many = sizes > FEW
            many[0] |= large.token is not None and token[0] == large.token
            keep = np.ones(len(starts), bool)
            keep[-1] = last or many[-1]
            of_many, kept = np.repeat(many & keep, sizes), np.repeat(~many & keep, sizes)
            held[:] = [c[~np.repeat(keep, sizes)] for c in columns]
            rows = [c[of_many] for c in columns]
            if len(rows[0]):
                rows += large.rows(*rows, np.floor(np.log(rows[2]) / step).astype(np.int64), percent)
            else:
                rows += [rows[0], rows[0]]
            return out([c[kept] for c in columns], rows)

        for batch in batches:
            columns = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns, strict=True)]
            if (done := worked(columns, False)) is not None:
                yield done
        if (done := worked(list(held), True)) is not None:
            yield done

    rows = found.select(F.explode("prefix").alias("token"), "node", "n")
    rows = rows.repartition("token").sortWithinPartitions("token", "n", "node")
    return stored(map_arrow(rows, shared, "token long, node long, n long, before long, centre long"), "tiles")


def possible(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) that the bitmaps leave possible."""

    def passing(batches):
        for batch in batches:
            n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
            most = most_apart(n + m, percent)
            bits, others = batch.column("bits").to_pylist(), batch.column("others").to_pylist()
            keep = [apart(x, y) <= z for x, y, z in zip(bits, others, most.tolist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = found.select(F.col("node").alias("a"), "n", "bits")
    right = found.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("bits").alias("others"))
    # Neither side has a bound, so none is ever broadcast.
    return map_arrow(pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b"), passing, "a long, b long")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, text, h): the texts whose hash is among those of ``wanted``, and few others.

    A table of fixed size tells most of those that aren't asked for before anything is shuffled.
    """
    table = docs.sparkSession.sparkContext.broadcast(bit_table(wanted.select(F.col("hash").alias("v"))))

    def asked(batches):
        for batch in batches:
            kept = batch.filter(pa.array(_in_table(table.value, batch.column(2).to_numpy())))
            if kept.num_rows:
                yield kept

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("h"))
    return map_arrow(rows, asked, f"id {kind}, text string, h long")


def _together(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """``pairs`` with ``bucket`` and ``cell``: pairs of one neighbourhood share a cell, so that a set goes to few; stored.

    A neighbourhood is led by the smallest class within two steps. One whose sets have more than ``HELD``
    elements is cut into shares of about as many, and every two shares meet in a cell of their own. Cells are dealt out
    to as many buckets as their elements fill; a task holds the sets of one cell at a time.
    """
    ways = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = ways.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("lead"))
    leads = ways.join(near.select(F.col("a").alias("b"), "lead"), "b").groupBy("a").agg(F.min("lead").alias("lead"))
    led = stored(pairs.join(leads, "a"), "led-pairs")
    members = led.select("lead", F.col("a").alias("node")).unionAll(led.select("lead", "b")).distinct()
    full = members.join(found.select("node", "n"), "node").groupBy(F.col("lead").alias("_lead")).agg(F.sum("n").alias("n"))
    full = stored(full, "neighbourhoods")
    shares = F.ceil(F.col("n") / HELD)
    buckets = -(-(full.agg(F.sum(F.col("n") * shares)).head()[0] or 1) // HELD)
    of_a, of_b = F.pmod(F.xxhash64("a"), shares), F.pmod(F.xxhash64("b"), shares)
    cell = F.xxhash64("lead", F.least(of_a, of_b), F.greatest(of_a, of_b))
    dealt = led.join(full, F.col("lead") == F.col("_lead")).select(cell.alias("cell"), "a", "b")
    return stored(dealt.select(F.pmod("cell", F.lit(buckets)).cast("int").alias("bucket"), "cell", "a", "b"), "dealt-pairs")


def verified(pairs: DataFrame, found: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b, linked) for stored ``pairs``, by exact intersection of the sorted sets of their texts; stored.

    Only texts that are asked for travel, in less space than their sets: to the cells that ask for them, once each, where
    they come before the pairs and become sorted arrays.
    """

    def settled(batches):
        at, held = None, {}
        for batch in batches:
            done = []
            texts = batch.column("text")
            for i, (cell, pair, a, b) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("cell", "pair", "a", "b")), strict=True)):
                if cell != at:
                    at, held = cell, {}
                if not pair:
                    held[a] = next(shingle_sets(words_of(texts.slice(i, 1)), size))
                    continue
                x, y = held[a], held[b]
                small, large = (x, y) if len(x) < len(y) else (y, x)
                found_at = np.searchsorted(large, small)
                found_at[found_at == len(large)] = 0
                common = int((large[found_at] == small).sum())
                done.append((a, b, 100 * common >= percent * (len(x) + len(y) - common)))
            columns = [pa.array([d[k] for d in done], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "linked"])

    dealt = _together(pairs, found)
    asked = dealt.select("bucket", "cell", F.col("a").alias("node")).unionAll(dealt.select("bucket", "cell", "b")).distinct()
    asked = stored(asked.join(found.select("node", "doc_id", "hash"), "node"), "asked")
    texts = _texts(docs, asked)
    # No bound on what is asked for is known, so it is never broadcast.
    sent = texts.join(asked.hint("merge"), texts["id"].eqNullSafe(asked["doc_id"]) & (F.col("h") == F.col("hash")))
    rows = sent.select("bucket", "cell", F.lit(False).alias("pair"), F.col("node").alias("a"), F.lit(None).cast("long").alias("b"), "text").unionAll(
        dealt.select("bucket", "cell", F.lit(True), "a", "b", F.lit(None).cast("string"))
    )
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "cell", "pair")
    return stored(map_arrow(rows, settled, "a long, b long, linked boolean"), "settled")


def _ordered(a: str, b: str):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def near_pairs(tiled: DataFrame) -> DataFrame:
    """(a, b) of each row of the tiles with its neighbour and its centre."""
    partners = tiled.select("node", F.explode(F.array("before", "centre")).alias("other")).where("other IS NOT NULL")
    return partners.select(*_ordered("node", "other")).distinct()


_FAR = np.iinfo(np.int32).max


def _distances(rows: list, percent: int) -> np.ndarray:
    """Per pair (i, j) of rows the bits that differ, or ``_FAR`` where sizes, bitmaps or groups rule the pair out.

    rows: (block, node, group, n, bits). A cell of one block pairs all its rows, one of two blocks those of either.
    """
    block, _, group, n = (np.array([r[k] for r in rows], np.int64) for k in range(4))
    width = np.array([len(r[4]) * 8 for r in rows])
    found = np.full((len(rows), len(rows)), _FAR, np.int32)
    crossed = block.min() != block.max()
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        for v in np.unique(width[width <= w]):
            partners = np.flatnonzero(width == v)
            least, most = n[own].min(), n[partners].max()
            if most < least and not fit(least, most, percent):
                continue
            y = np.array([np.frombuffer(rows[j][4], np.uint64) for j in partners])
            for part in np.array_split(own, len(own) * len(partners) * v // (8 * SLICE) + 1):
                if not len(part):
                    continue
                x = np.array([
                    np.frombuffer(_folded(int.from_bytes(rows[i][4], "little"), int(w), int(v)).to_bytes(v // 8, "little"), np.uint64)
                    for i in part])
                bits = np.bitwise_count(x[:, None, :] ^ y[None, :, :]).sum(axis=2, dtype=np.int64)
                i, j = part[:, None], partners[None, :]
                good = (bits <= most_apart(n[i] + n[j], percent)) & (group[i] != group[j]) & fit(n[i], n[j], percent)
                if crossed:
                    good &= block[i] != block[j]
                bits = np.where(good, bits, _FAR)
                found[i, j] = np.minimum(found[i, j], bits)
                found[partners[:, None], part[None, :]] = np.minimum(found[partners[:, None], part[None, :]], bits.T)
    return found


def _connecting(distances: np.ndarray, group: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs that connect the groups as far as the distances allow, nearest partners first; at most one per group."""
    open_ = np.ones(len(group), bool)
    for start in range(len(group)):
        if not open_[start]:
            continue
        reached = group == group[start]
        open_ &= ~reached
        front = np.flatnonzero(reached)
        while len(front) and open_.any():
            left = np.flatnonzero(open_)
            near = distances[np.ix_(front, left)]
            best = near.argmin(axis=0)
            least = near[best, np.arange(len(left))]
            hit = np.flatnonzero(least < _FAR)
            hit = hit[np.argsort(least[hit], kind="stable")]
            new = group[left[hit]]
            _, first = np.unique(new, return_index=True)
            for at in hit[first]:
                yield int(front[best[at]]), int(left[at])
            reached = np.isin(group, new) & open_
            open_ &= ~reached
            front = np.flatnonzero(reached)


def _step(percent: int) -> float:
    """Width of a size band in logarithms: sizes that fit are in equal or adjacent bands, whatever the rounding."""
    return math.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1.0


def _cells(marked: DataFrame, percent: int) -> DataFrame:
    """(token, i, j, block, node, grp, n): rows of tiles with more than one group, once per cell (token, i, j).

    A tile of up to ``BLOCK`` rows is one block. A larger one is cut into size bands and these into blocks; every two blocks
    of equal or adjacent bands meet in a cell of their own.
    """
    marked = marked.withColumn("band", F.floor(F.log("n") / _step(percent)))
    bands = marked.groupBy("token", "band").agg(F.min("grp").alias("low"), F.max("grp").alias("high"), F.count(F.lit(1)).alias("size"))
    blocks = F.map_from_entries(F.collect_list(F.struct("band", F.ceil(F.col("size") / BLOCK).alias("blocks"))))
    mixed = bands.groupBy(F.col("token").alias("t")).agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("size").alias("size"), blocks.alias("blocks"))
    mixed = mixed.where("low <> high").select("t", F.when(F.col("size") > BLOCK, F.col("blocks")).alias("blocks"))
    code = lambda band, block: F.shiftleft(band, 32) + block
    of = lambda band: F.coalesce(F.try_element_at("blocks", band), F.lit(0).cast("long"))
    met = lambda band: F.transform(
        F.filter(F.sequence(F.lit(0).cast("long"), of(band)), lambda k: k < of(band)), lambda k: code(band, k))
    one = F.col("blocks").isNull()
    rows = marked.join(mixed, F.col("token") == F.col("t"))
    own = code(F.col("band"), F.pmod(F.xxhash64("node"), of(F.col("band"))))
    rows = rows.withColumn("block", F.when(one, F.lit(0).cast("long")).otherwise(own))
    partners = F.concat(*[met(F.col("band") + d) for d in (-1, 0, 1)])
    rows = rows.withColumn("with", F.explode(F.when(one, F.array(F.lit(0).cast("long"))).otherwise(partners)))
    return rows.select("token", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "node", "grp", "n")


def _block_pairs(rows: list, percent: int, connect: bool) -> Iterator[tuple[int, int]]:
    """Pairs of different groups in one cell of a tile that sizes and bitmaps allow: all, or enough to ``connect`` them."""
    distances = _distances(rows, percent)
    if connect:
        pairs = _connecting(distances, np.array([r[2] for r in rows], np.int64))
    else:
        pairs = zip(*np.nonzero(np.triu(distances < _FAR, 1)), strict=True)
    for i, j in pairs:
        a, b = rows[i][1], rows[j][1]
        yield (a, b) if a < b else (b, a)


def group_pairs(tiled: DataFrame, found: DataFrame, groups: DataFrame, percent: int, connect: bool) -> DataFrame:
    """(a, b): pairs of a tile whose classes are in different groups and that sizes and bitmaps allow; see ``_block_pairs``.

    A large tile is cut into blocks, which meet in cells; see ``_cells``.
    """

    def cells(batches):
        def done(rows):
            pairs = list(_pair_of_two(rows, percent) if len(rows) == 2 else _block_pairs(rows, percent, connect)) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], names=["a", "b"])

        at, rows = None, []
        for batch in batches:
            for cell_and_row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cell = cell_and_row[:3]
                if cell != at:
                    if len(rows) > 1:
                        yield done(rows)
                    at, rows = cell, []
                rows.append(cell_and_row[3:])
        yield done(rows)

    group = F.coalesce("component", "node").alias("grp")
    marked = tiled.select("token", "node", "n").join(groups, "node", "left").select("token", "node", "n", group)
    rows = _cells(marked, percent).join(found.select("node", "bits"), "node")
    rows = rows.select("token", "i", "j", "block", "node", "grp", "n", "bits")
    rows = rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return map_arrow(rows, cells, "a long, b long").distinct()


def _pair_of_two(rows: list, percent: int) -> Iterator[tuple[int, int]]:
    """``_block_pairs`` for two rows, by far the most frequent case."""
    (p, a, g, n, x), (q, b, h, m, y) = rows
    if g != h and 100 * min(n, m) >= percent * max(n, m) and apart(x, y) <= most_apart(n + m, percent):
        yield (a, b) if a < b else (b, a)


def _connected(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``signatures`` and ``classes`` of (doc_id, text), (node, component) of linked classes, and the pairs settled for that."""
    spark: SparkSession = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_shingles(docs.select("text"), size))
    signed = stored(signatures(docs, size, percent, table), "signatures")
    found = classes(signed)
    release(spark)
    tiled = tiles(found, percent)
    release(spark)
    large = tiled.where("token IS NOT NULL")
    settled = None
    groups = spark.createDataFrame([], "node long, component long")
    # First pairs of all tiles; of large tiles, pairs that connect groups; all pairs of groups still apart.
    for step in range(1 if large.isEmpty() else 3):
        if step:
            proposed = group_pairs(large, found, groups, percent, connect=step == 1)
            proposed = proposed.join(settled.select("a", "b"), ["a", "b"], "left_anti")
        else:
            proposed = possible(near_pairs(tiled), found, percent)
        pairs = stored(proposed, "pairs")
        if pairs.isEmpty():
            settled = pairs.withColumn("linked", F.lit(False)) if settled is None else settled
            continue
        new = verified(pairs, found, docs, size, percent)
        settled = new if settled is None else settled.unionAll(new)
        release(spark)
        groups = components(settled.where("linked").select("a", "b"))
    return signed, found, groups, settled


def _members(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``signatures`` of (doc_id, text), and (sig, doc_id, hash, component) per class."""
    signed, found, groups, _ = _connected(docs, size, percent)
    member = found.select("node", "sig", "doc_id", "hash").join(groups, "node", "left")
    return signed, member.select("sig", "doc_id", "hash", F.coalesce("component", "node").alias("component"))


def linked_groups(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    The set of a text: its distinct runs of ``size`` words, A-Z as a-z; with fewer words the whole sequence as one.
    Two documents link when 100 * intersection >= ``percent`` * union. A null or empty text has the empty set and links
    with nothing. ``component_id`` is the smallest id reachable; rows without an id are reached last, and a group
    of such rows alone has none. Rows that repeat an id are rows of their own. An empty table gives an empty
    result. Other columns are not read.
    """
    signed, member = _members(docs.select("doc_id", whole_text().alias("text")), size, percent)
    least = member.groupBy("component").agg(F.min("doc_id").alias("least"))
    of_class = member.join(least, "component").select(F.col("sig").alias("_sig"), "least")
    met = signed.select("doc_id", "n", "sig").join(of_class, F.col("sig") == F.col("_sig"), "left")
    own = F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return met.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def links(docs: DataFrame, size: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """The whole join: (doc_id, n_shingles, class) for every row of ``docs``, and (a, b) for every two classes that link, a < b.

    Rows of one class have equal sets, so they link with each other too; ``class`` is null for the empty set, which links with
    nothing. Two rows link if and only if they are of one class or of two classes that link; see ``linked_groups``.

    Linked classes are in one group, and groups are exact. So all pairs of a group that sizes and bitmaps allow meet once, in
    blocks, and those that connecting the groups hasn't settled are settled here.
    """
    docs = docs.select("doc_id", whole_text().alias("text"))
    signed, found, groups, settled = _connected(docs, size, percent)
    grouped = stored(groups.join(found.select("node", "n"), "node").select(F.col("component").alias("token"), "node", "n"), "grouped")
    apart_ = docs.sparkSession.createDataFrame([], groups.schema)  # every class on its own: all pairs are asked for
    proposed = group_pairs(grouped, found, apart_, percent, connect=False)
    pairs = stored(proposed.join(settled.select("a", "b"), ["a", "b"], "left_anti"), "link-pairs")
    release(docs.sparkSession)
    if not pairs.isEmpty():
        settled = settled.unionAll(verified(pairs, found, docs, size, percent))
        release(docs.sparkSession)
    of_class = found.select(F.col("sig").alias("_sig"), F.col("node").alias("class"))
    rows = signed.join(of_class, F.col("sig") == F.col("_sig"), "left").select("doc_id", F.col("n").alias("n_shingles"), "class")
    return rows, settled.where("linked").select("a", "b")


def link_counts(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, n_links) for every row of ``docs``: how many other rows it links with.

    See ``linked_groups`` for links. Rows that repeat an id, or have none, are rows of their own. An empty table gives an
    empty result. Other columns are not read.
    """
    rows, pairs = links(docs, size, percent)
    rows = stored(rows, "link-rows")
    counts = rows.where("class IS NOT NULL").groupBy(F.col("class").alias("_class")).agg(F.count(F.lit(1)).alias("_rows"))
    ways = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ways.join(counts, F.col("b") == F.col("_class")).groupBy(F.col("a").alias("_a")).agg(F.sum("_rows").alias("_others"))
    per_class = counts.join(others, F.col("_class") == F.col("_a"), "left")
    per_class = per_class.select("_class", (F.col("_rows") - 1 + F.coalesce("_others", F.lit(0))).alias("_links"))
    met = rows.join(per_class, F.col("class") == F.col("_class"), "left")
    return met.select("doc_id", "n_shingles", F.coalesce("_links", F.lit(0).cast("long")).alias("n_links"))


def first_of_groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with their columns, but one of each group of linked documents: that with the smallest id.

    See ``linked_groups`` for links. Texts without words link with nothing and stay. Of rows with the same id and text one
    stays; a group without ids keeps one row.
    """
    _, member = _members(docs.select("doc_id", whole_text().alias("text")), size, percent)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")
    first = member.groupBy("component").agg(F.min(order).alias("f"))
    last = F.lit((1 << 63) - 1)
    first = first.select(F.coalesce(F.col("f.doc_id").cast("long"), last).alias("_id"), F.col("f.hash").alias("_hash"))
    row = docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce(F.col("doc_id").cast("long"), last).alias("_id"), F.xxhash64(whole_text()).alias("_hash"))
    empty = F.btrim(F.coalesce("_row.text", F.lit("")), F.lit(SPACES)) == ""
    chosen = row.where(~empty).join(first, ["_id", "_hash"], "left_semi").groupBy("_id", "_hash").agg(F.first("_row").alias("_row"))
    return chosen.select("_row.*").unionAll(row.where(empty).select("_row.*"))
