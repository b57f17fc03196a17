"""Exact sets of keys as bitmaps: references, orphans and distinct counts by bit operations.

A whole number n is bit ``n mod 64`` of word ``n div 64``. Words of a set are put together by ``bit_or``, an ordinary hash aggregate that
combines map-side: where ids are dense, 64 of them travel as one row; where they are sparse, a word costs no more than the id
itself. (A bitmap of fixed 4 kB blocks would cost 4 kB per sparse id.) A text that is the one spelling of a whole
number counts as that number, and every other text is kept as it is, so no key is ever confused with another. Nulls are in no set.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored

#: A wanted set: (number of the set, column of the table).
Wanted = tuple[int, str]
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _entry(df: DataFrame, number: int, column: str) -> Column:
    """(set, n, text): one of the last two, or neither for a null."""
    key = F.col(column)
    if isinstance(df.schema[column].dataType, _WHOLE):
        n, text = key.cast("long"), F.lit(None).cast("string")
    else:
        key = key.cast("string")
        n = key.try_cast("long")
        n = F.when(n.cast("string") == key, n)
        text = F.when(n.isNull(), key)
    return F.struct(F.lit(number).alias("set"), n.alias("n"), text.alias("text"))


def entries(tables: Mapping[str, DataFrame], wanted: Mapping[str, Sequence[Wanted]], *group: str) -> DataFrame:
    """(group, set, word, bit, text) per row of each table and wanted column; every table is scanned once."""
    parts = []
    for name, columns in wanted.items():
        df = tables[name]
        rows = df.select(*group, F.inline(F.array(*[_entry(df, i, c) for i, c in columns])))
        parts.append(rows.where(F.col("n").isNotNull() | F.col("text").isNotNull()))
    rows = reduce(DataFrame.unionAll, parts)
    bit = F.coalesce(F.col("n").bitwiseAND(F.lit(63)), F.lit(0)).cast("int")
    return rows.select(*group, "set", F.shiftright("n", 6).alias("word"), bit.alias("bit"), "text")


def _mask() -> Column:
    return F.expr("shiftleft(1L, bit)")


def key_sets(rows: DataFrame, *group: str) -> DataFrame:
    """(group, set, word, text, bits) of ``entries``: the words of every set, and its other texts, each with one bit."""
    return rows.groupBy(*group, "set", "word", "text").agg(F.bit_or(_mask()).alias("bits"))


def distinct_counts(df: DataFrame, columns: Sequence[str], *group: str) -> DataFrame:
    """(group, one count per column under its name): different values, all columns in one scan; nulls don't count.

    A group without any value has no row here.
    """
    found = key_sets(entries({"t": df}, {"t": list(enumerate(columns))}, *group), *group)
    sizes = [F.coalesce(F.sum(F.when(F.col("set") == i, F.bit_count("bits"))), F.lit(0)).cast("long").alias(c) for i, c in enumerate(columns)]
    return found.groupBy(*group).agg(*sizes) if group else found.agg(*sizes)


def references(tables: Mapping[str, DataFrame], pairs: Sequence[tuple[str, str, str, str]], count_rows: bool = True) -> DataFrame:
    """(pair, keys, orphan_keys, orphan_rows) per (child, column, parent, parent column); null keys pass.

    ``keys`` and ``orphan_keys`` are different keys of the child, and those that the parent doesn't have: bits of its words that are
    not set in the parent's. One scan of each table and one shuffle of words find them for all pairs. Words with orphans
    are stored, so that Spark knows their size, and the rows with such keys are counted in a second scan of the child columns
    concerned. Without ``count_rows`` that is left out, and ``orphan_rows`` too. The driver gets one row per parent key.
    """
    spark = next(iter(tables.values())).sparkSession
    spaces = list(dict.fromkeys((parent, column) for _, _, parent, column in pairs))
    of = [spaces.index((parent, column)) for _, _, parent, column in pairs]
    # A set is a space and a slot in it: 0 for the parent, then one for each child.
    slot = [of[: i + 1].count(k) for i, k in enumerate(of)]
    most = max(slot)
    children: dict[str, list[Wanted]] = {}
    for i, (table, column, _, _) in enumerate(pairs):
        children.setdefault(table, []).append((of[i] * (most + 1) + slot[i], column))
    wanted = {table: list(columns) for table, columns in children.items()}
    for i, (table, column) in enumerate(spaces):
        wanted.setdefault(table, []).append((i * (most + 1), column))
    place = (F.col("set") % (most + 1)).alias("slot")
    rows = entries(tables, wanted).select((F.col("set") / (most + 1)).cast("int").alias("space"), place, "word", "bit", "text")
    bits = lambda s: F.coalesce(F.bit_or(F.when(F.col("slot") == s, _mask())), F.lit(0)).alias(f"b{s}")
    words = rows.groupBy("space", "word", "text").agg(*[bits(s) for s in range(most + 1)])
    bad = lambda s: F.col(f"b{s}").bitwiseAND(F.bitwise_not("b0"))
    if count_rows:
        words = stored(words, "key-words")
    sums = [F.sum(F.bit_count(c)).alias(f"{n}{s}") for s in range(1, most + 1) for n, c in (("keys", F.col(f"b{s}")), ("bad", bad(s)))]
    found = {r["space"]: r for r in words.groupBy("space").agg(*sums).collect()}
    counts = [(i, *((found[k][f"keys{n}"], found[k][f"bad{n}"]) if k in found else (0, 0))) for i, (k, n) in enumerate(zip(of, slot, strict=True))]
    if not count_rows:
        return spark.createDataFrame(counts, "pair int, keys long, orphan_keys long")
    concerned = {i: of[i] * (most + 1) + slot[i] for i, _, orphans in counts if orphans}
    hit: dict[int, int] = {}
    if concerned:
        some = {t: [c for c in columns if c[0] in concerned.values()] for t, columns in children.items()}
        some = {t: columns for t, columns in some.items() if columns}
        orphans = words.select("space", "word", "text", F.inline(F.array(*[F.struct(F.lit(s).alias("slot"), bad(s).alias("bad")) for s in range(1, most + 1)])))
        orphans = orphans.where("bad <> 0").select((F.col("space") * (most + 1) + F.col("slot")).alias("_set"), F.col("word").alias("_word"), F.col("text").alias("_text"), "bad")
        same = (F.col("set") == F.col("_set")) & F.col("word").eqNullSafe(F.col("_word")) & F.col("text").eqNullSafe(F.col("_text"))
        met = entries(tables, some).join(stored(orphans, "orphan-words"), same).where(_mask().bitwiseAND(F.col("bad")) != 0)
        hit = {r["set"]: r["n"] for r in met.groupBy("set").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows_of = [(*c, hit.get(concerned.get(c[0], -1), 0)) for c in counts]
    return spark.createDataFrame(rows_of, "pair int, keys long, orphan_keys long, orphan_rows long")
