"""How far the sources of a language differ in their words, by run-length columns.

Each (lang, source) has a column of counts over the kept vocabulary of its language. The vocabulary is put in an order that
brings terms with equal counts together (the columns of small sources first, as these have the fewest different counts), dealt
out by ranges of that order, and cut into blocks. In a block every column is held as runs of equal counts. For two
sources their run boundaries are intersected, and each stretch adds its f once, times its length. A count, and so
its share, is looked at once per run instead of once per term.

All arithmetic is in whole numbers of 64 bits (see ``shares`` for the bound).
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import map_arrow, slices, stored, whole_text

#: Documents of a language in which a kept term occurs at least; ranks of single terms.
LEAST, RANKS = 10, 10
#: Entries of a task's partial counts before they leave it, and counts (terms by sources) of a block.
HELD, BLOCK = 500_000, 1 << 21
#: Rows of a batch of partial counts.
EMITTED = 50_000
#: A-Z as a-z, other ASCII as spaces; bytes of longer characters stay.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, n_docs): occurrences, and rows of ``docs`` with the term. Nulls count as empty.

    Tasks add up what they read before it is shuffled, up to ``HELD`` entries at a time.
    """

    def partial(batches):
        # Per (lang, source) the occurrences and the rows of each term, both in the order in which terms were first met.
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def emit():
            parts = []
            for (lang, source), (n, n_docs) in held.items():
                lang, source = (pa.repeat(pa.scalar(x, pa.string()), len(n)) for x in (lang, source))
                counts = [pa.array(c.values(), pa.int64(), size=len(c)) for c in (n, n_docs)]
                parts.append(pa.RecordBatch.from_arrays([lang, source, pa.array(n, pa.binary(), size=len(n)).cast(pa.string()), *counts], names=names))
            # Few large batches: there may be many small groups.
            return pa.Table.from_batches(parts).combine_chunks().to_batches(max_chunksize=EMITTED)

        names = ["lang", "source", "term", "n", "n_docs"]
        for batch in slices(batches, 2):
            texts = batch.column(2).cast(pa.large_binary())
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
                if not (terms := text.as_py().translate(_TABLE).split()):
                    continue
                n, n_docs = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                n.update(terms)
                n_docs.update(iter(dict.fromkeys(terms)))  # in the order of ``n``; a dict itself would be added by value
                size += len(n)
                if size >= HELD:
                    yield from emit()
                    held, size = {}, 0
        if size:
            yield from emit()

    rows = docs.select(whole_text("lang").alias("lang"), whole_text("source").alias("source"), whole_text().alias("text"))
    found = map_arrow(rows, partial, "lang string, source string, term string, n long, n_docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def kept_counts(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, term, total, by_source): terms in at least ``least`` documents of their language; ``by_source``: its (source, n)."""
    per_term = counts.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("n_docs").alias("n_docs"), F.collect_list(F.struct("source", "n")).alias("by_source")
    )
    return per_term.where(F.col("n_docs") >= least).drop("n_docs")


def group_sizes(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, sources, sizes, vocabulary): per language its sources, smaller ones first, and their counts over kept terms."""
    of_source = kept.select("lang", F.explode("by_source").alias("s")).groupBy("lang", "s.source").agg(F.sum("s.n").alias("size"))
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"))
    sized = groups.join(of_source, ["lang", "source"], "left").select("lang", "source", F.coalesce("size", F.lit(0)).alias("size"))
    ordered = F.array_sort(F.collect_list(F.struct("size", "source")))
    per_lang = sized.groupBy("lang").agg(ordered.alias("o")).join(vocabulary, "lang", "left")
    return per_lang.select("lang", F.col("o.source").alias("sources"), F.col("o.size").alias("sizes"), F.coalesce("vocabulary", F.lit(0)).alias("vocabulary"))


def shares(counts: np.ndarray, size: int, vocabulary: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (size + 2 vocabulary)), exact.

    The digits come three at a time, so that no number passes 1000 times the divisor: exact up to 9 * 10^15 words in a group.
    """
    divisor = np.int64(size + 2 * vocabulary)
    whole, rest = np.divmod(counts + 2, divisor)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, divisor)
        whole = whole * 1000 + more
    return whole + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); both are at most 10^9 + 1, so the square fits."""
    return (p - q) * (p - q) // (p + q)


def runs(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, values) of the runs of equal values."""
    starts = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
    return starts, column[starts]


def met(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value of a, value of b, length) of the stretches between the run boundaries of both columns."""
    starts = np.union1d(a[0], b[0])
    at = [np.searchsorted(x[0], starts, side="right") - 1 for x in (a, b)]
    return a[1][at[0]], b[1][at[1]], np.diff(np.append(starts, length))


def _block_sums(columns: np.ndarray, sizes: list[int], vocabulary: int) -> list[int]:
    """f of each two columns of a block (terms by sources), summed over its terms."""
    held = []
    for column, size in zip(columns.T, sizes, strict=True):
        starts, counts = runs(column)
        held.append((starts, shares(counts, size, vocabulary)))
    sums = []
    for a, b in combinations(held, 2):
        p, q, length = met(a, b, len(columns))
        sums.append(int((divergence(p, q) * length).sum()))
    return sums


def _dense(counts: pa.ListArray, sources: int) -> np.ndarray:
    """Terms by sources, from the lists of (place of a source, n) of which a term has one."""
    entries = counts.flatten()
    column = np.zeros((len(counts), sources), np.int64)
    term = np.repeat(np.arange(len(counts)), np.diff(counts.offsets.to_numpy()))
    column[term, entries.field(0).to_numpy()] = entries.field(1).to_numpy()
    return column


def pair_sums(kept: DataFrame, sizes: DataFrame, block: int = BLOCK) -> DataFrame:
    """(lang, a, b, value) for every two sources of a language with kept terms, ``a`` before ``b`` in its list of sources."""
    # One row per language with its sources; Spark knows the stored table's size.
    rows = kept.join(sizes, "lang")
    placed = F.transform("by_source", lambda s: F.struct((F.array_position("sources", s["source"]) - 1).cast("int").alias("at"), s["n"].alias("n")))
    rows = rows.select("lang", F.array_sort(placed).alias("counts"), "term", "sources", "sizes", "vocabulary")
    # Spark samples the keys of ranges on the driver, so these are short: the first counts, and the term, since many terms may share those.
    ordered = rows.repartitionByRange("lang", F.slice("counts", 1, 3), "term").sortWithinPartitions("lang", "counts").drop("term")

    def sums(batches):
        now, held, size = None, [], 0

        def block_rows():
            lang, sources, group_sizes_, vocabulary = now
            names = list(combinations(sources, 2))
            found = _block_sums(np.concatenate(held), group_sizes_, vocabulary)
            arrays = [pa.array([lang] * len(names), pa.string()), *[pa.array(x, pa.string()) for x in zip(*names, strict=True)], pa.array(found, pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "a", "b", "value"])

        for batch in filter(len, batches):
            langs = batch.column(0).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(langs[1:] != langs[:-1]) + 1).tolist(), batch.num_rows]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                if now is None or now[0] != langs[low]:
                    if size:
                        yield block_rows()
                    now, held, size = (langs[low], *[batch.column(c)[low].as_py() for c in (2, 3, 4)]), [], 0
                step = max(1, block // len(now[1]))
                # A single source has nobody to be compared with.
                for start in range(low, high if len(now[1]) > 1 else low, step):
                    held.append(_dense(batch.column(1).slice(start, min(step, high - start)), len(now[1])))
                    size += len(held[-1])
                    if size >= step:
                        yield block_rows()
                        held, size = [], 0
        if size:
            yield block_rows()

    found = map_arrow(ordered, sums, "lang string, a string, b string, value long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _ranked(df: DataFrame, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    found = df.withColumn("rank", F.row_number().over(order))
    return found.where(F.col("rank") <= most) if most else found


def term_values(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, source, item, value): terms that a source uses more than its language, with their f."""
    of_source = sizes.select("lang", "vocabulary", F.expr("aggregate(sizes, 0L, (a, x) -> a + x)").alias("all_size"),
                             F.explode(F.map_from_arrays("sources", "sizes")).alias("source", "size"))
    rows = kept.select("lang", "term", "total", F.explode("by_source").alias("s"))
    rows = rows.select("lang", "term", "total", "s.source", "s.n").join(of_source, ["lang", "source"])
    share = lambda n, size: F.expr(f"1 + (cast(1000000000 as decimal(20,0)) * ({n} + 2)) div ({size} + 2 * vocabulary)")
    rows = rows.withColumns({"p": share("n", "size"), "q": share("total", "all_size")}).where("p > q")
    return rows.select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))


def audit(docs: DataFrame, least: int = LEAST, ranks: int = RANKS, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): sources against each other, and the terms that mark a source.

    Part ``pair`` has each other source of the language with the summed divergence over all kept terms, part ``term`` the
    ``ranks`` kept terms that stand out most. Null text, lang and source count as empty; a (lang, source) without terms
    is a source like any other. Repeated rows count as often as they occur; equal values are ranked by the item's
    bytes. Other columns are not read; an empty table gives an empty result.
    """
    groups = docs.select(whole_text("lang").alias("lang"), whole_text("source").alias("source")).distinct()
    kept = stored(kept_counts(term_counts(docs), least), "kept-terms")
    sizes = stored(group_sizes(groups, kept), "group-sizes")
    sums = pair_sums(kept, sizes, block)
    both = sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("e"), "value")
    # Languages without kept terms: every pair is 0.
    bare = sizes.where("vocabulary = 0").select("lang", F.explode("sources").alias("source"), "sources")
    bare = bare.select("lang", "source", F.explode("sources").alias("item"), F.lit(0).cast("long").alias("value")).where("source <> item")
    pairs = _ranked(both.select("lang", "e.source", "e.item", "value").unionByName(bare))
    terms = _ranked(term_values(kept, sizes), ranks)
    parts = [df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, df in (("pair", pairs), ("term", terms))]
    return parts[0].unionByName(parts[1])
