"""Joins and first-per-key that stay balanced when one key holds much of the data.

A *hot* key is one with ``LEAST_ROWS`` rows or more (some 240 MB of reviews) and at least one row in ``FAIR`` of its table: what a
single core of a large cluster has to work on anyhow. All join keys of a table are summed up in one aggregate before a plan is built, by
mergeable summaries of frequent items with ``TRACKED`` counters per column. A summary counts a key too low by at
most 3.5 / m of all rows, m being the power of two above 4/3 of ``TRACKED``, and lists it if twice that is passed; ``FAIR`` is below
m / 7, so every hot key is listed (``guaranteed`` says so for other numbers). There are ``FAIR`` hot keys at most, so they
may be sent to all tasks.

Each hot key is cut into as many shares as its rows make up, and no task sees much more than a share of one key.
Without hot keys the plans are plain joins and windows. The null key counts as a key here: rows without a
key can be the hottest of all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST_ROWS = 100_000
FAIR, TRACKED = 4_096, 16_384
#: Summaries of the tasks meet in as many groups before the last one.
MERGERS = 64


def guaranteed(fair: int = FAIR, tracked: int = TRACKED) -> bool:
    """Whether every key with one row in ``fair`` or more is listed by summaries of ``tracked`` counters."""
    slots = 1
    while slots * 3 < tracked * 4:
        slots *= 2
    return 2 * 3.5 * fair <= slots


@dataclass(frozen=True)
class HotKeys:
    """The hot values of one key column with their shares; false when there are none."""

    key: str
    kind: T.DataType = field(default_factory=T.StringType)
    shares: Mapping = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.shares)

    def table(self, spark) -> DataFrame:
        """(_hot_key, _shares): at most ``FAIR`` rows for a table, hence the hint."""
        schema = T.StructType([T.StructField("_hot_key", self.kind), T.StructField("_shares", T.IntegerType())])
        return F.broadcast(spark.createDataFrame(list(self.shares.items()), schema))

    def merge(self, other: HotKeys) -> HotKeys:
        """Keys hot in either table; the pairs of a key that is hot in both are cut by both."""
        both = {k: self.shares.get(k, 1) * other.shares.get(k, 1) for k in {**self.shares, **other.shares}}
        return HotKeys(self.key, self.kind if self else other.kind, both)

    def without_null(self) -> HotKeys:
        return HotKeys(self.key, self.kind, {k: n for k, n in self.shares.items() if k is not None})


def hot_keys(df: DataFrame, columns: Sequence[str], hot_rows: int | None = None) -> dict[str, HotKeys]:
    """The hot values of several columns of a table, from one aggregate over these columns: a single Spark job.

    ``hot_rows``: rows that make a key hot, instead of ``LEAST_ROWS``; one row in ``FAIR`` is the least in any case. Counts are
    upper bounds, too high by no more than the summary's error, so a key has a share too many at worst.
    """
    state = lambda name, c, n: F.call_function(f"approx_top_k_{name}", c, F.lit(n))
    names = [f"_c{i}" for i in range(len(columns))]
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)], F.spark_partition_id().alias("_p"))
    per_group = rows.groupBy(F.pmod("_p", F.lit(MERGERS)).alias("_g")).agg(
        F.count(F.lit(1)).alias("_n"), *[state("accumulate", F.col(n), TRACKED).alias(n) for n in names]
    )
    # One group, so that a table without rows has no summary to be read.
    met = per_group.groupBy(F.lit(True).alias("_all")).agg(F.sum("_n").alias("_n"), *[state("combine", F.col(n), TRACKED).alias(n) for n in names])
    least = F.greatest(F.lit(LEAST_ROWS if hot_rows is None else hot_rows).cast("long"), F.ceil(F.col("_n") / FAIR))
    lists = [F.filter(state("estimate", F.col(n), TRACKED), lambda x: x["count"] >= F.col("_least")).alias(n) for n in names]
    found = met.withColumn("_least", least).select("_least", *lists).head()
    shares = {c: {x["item"]: -(-x["count"] // found["_least"]) for x in found[n]} if found else {} for c, n in zip(columns, names, strict=True)}
    return {c: HotKeys(c, df.schema[c].dataType, shares[c]) for c in columns}


def find_hot(df: DataFrame, key: str, hot_rows: int | None = None) -> HotKeys:
    """``hot_keys`` of one column."""
    return hot_keys(df, [key], hot_rows)[key]


#: Columns of each table by which large joins meet.
JOIN_KEYS = {
    "review": ("review_id", "buyer_id"), "product_reviews": ("p_id", "review_id"), "product": ("category_id",),
    "cart_items": ("p_id", "cart_id"),
}


class Profiles:
    """Hot join keys of the tables of one mapping, summed up at first use and kept: at most one job per table."""

    def __init__(self, tables: Mapping[str, DataFrame]) -> None:
        self._tables, self._found = tables, {}

    def prepare(self, *names: str, hot_rows: int | None = None) -> Profiles:
        """Sum up several tables side by side."""
        missing = [n for n in names if (n, hot_rows) not in self._found]

        def one(name: str) -> dict[str, HotKeys]:
            df = self._tables[name]
            return hot_keys(df, [c for c in JOIN_KEYS[name] if c in df.columns], hot_rows)

        if missing:
            with ThreadPoolExecutor(len(missing)) as pool:
                self._found |= zip([(n, hot_rows) for n in missing], pool.map(one, missing), strict=True)
        return self

    def hot(self, name: str, key: str, hot_rows: int | None = None) -> HotKeys:
        return self.prepare(name, hot_rows=hot_rows)._found[name, hot_rows][key]


def profiles_of(tables: Mapping[str, DataFrame], *names: str, hot_rows: int | None = None) -> Profiles:
    """The profiles that ``tables`` keeps for its whole life, or new ones."""
    return (getattr(tables, "profiles", None) or Profiles(tables)).prepare(*names, hot_rows=hot_rows)


def spread_hash(*columns: str) -> Column:
    """Hash that spreads rows over the shares of a hot key.

    The partition id tells identical copies of one row apart; it stays the same
    when a lost task is run again.
    """
    return F.xxhash64(*[F.col(c) for c in columns]) + F.spark_partition_id()


def _marked(df: DataFrame, hot: HotKeys, shares: str = "_shares") -> DataFrame:
    """Add the number of shares of each row's key, 1 for an ordinary key."""
    if not hot:
        return df.withColumn(shares, F.lit(1))
    marks = hot.table(df.sparkSession)
    return (
        df.join(marks, df[hot.key].eqNullSafe(marks["_hot_key"]), "left")
        .withColumn(shares, F.coalesce("_shares", F.lit(1)))
        .drop("_hot_key", *([] if shares == "_shares" else ["_shares"]))
    )


def _share(spread: Column, shares: str = "_shares") -> Column:
    return F.pmod(spread, F.col(shares)).cast("int")


def _all_shares(shares: str = "_shares") -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(shares) - 1))


def salted_join(
    left: DataFrame, right: DataFrame, hot: HotKeys, spread: Column, how: str = "left"
) -> DataFrame:
    """Join on the key of ``hot``, its hot keys in ``left`` cut into shares.

    ``right`` holds few rows per key (usually one); its rows for hot keys are
    repeated once per share, at most 2 * rows(left) / hot_rows rows in all.
    """
    if not hot:
        return left.join(right, hot.key, how)
    cut_left = _marked(left, hot).withColumn("_cut", _share(spread)).drop("_shares")
    known = right.where(F.col(hot.key).isNotNull())
    cut_right = _marked(known, hot).withColumn("_cut", _all_shares()).drop("_shares")
    return cut_left.join(cut_right, [hot.key, "_cut"], how).drop("_cut")


def two_sided_join(
    left: DataFrame,
    right: DataFrame,
    hot_left: HotKeys,
    hot_right: HotKeys,
    spread_left: Column,
    spread_right: Column,
    how: str = "left",
) -> DataFrame:
    """Left or inner join of hot keys alone, where either side may be the large one.

    Left rows are cut by their share and repeated over the right shares, right rows
    the other way round, so that each pair meets in exactly one cell. Left rows
    without any partner are added after.
    """
    key = hot_left.key
    both = hot_left.merge(hot_right)
    l = _marked(_marked(left, hot_left, "_ls"), hot_right, "_rs")
    l = l.withColumn("_a", _share(spread_left, "_ls")).withColumn("_b", _all_shares("_rs")).drop("_ls", "_rs")
    right = _only(right, both)
    r = _marked(_marked(right, hot_left, "_ls"), hot_right, "_rs")
    r = r.withColumn("_b", _share(spread_right, "_rs")).withColumn("_a", _all_shares("_ls")).drop("_ls", "_rs")
    matched = l.join(r, [key, "_a", "_b"], "inner").drop("_a", "_b")
    if how == "inner":
        return matched
    partners = right.select(key).distinct()  # hot keys only
    extra = [f for f in right.schema.fields if f.name != key]
    alone = left.join(partners, key, "left_anti").select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra]
    )
    return matched.unionByName(alone)


def _only(df: DataFrame, hot: HotKeys) -> DataFrame:
    marks = hot.table(df.sparkSession)
    return df.join(marks, df[hot.key].eqNullSafe(marks["_hot_key"]), "left_semi")


def split_hot(df: DataFrame, hot: HotKeys) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys or None)."""
    if not hot:
        return df, None
    marks = hot.table(df.sparkSession)
    return df.join(marks, df[hot.key].eqNullSafe(marks["_hot_key"]), "left_anti"), _only(df, hot)


def first_of_regular(df: DataFrame, key: str, order: list[Column], flag: str = "is_first") -> DataFrame:
    """Mark the first row per key where no key is hot: one window over the key."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).withColumn(flag, F.col("_rn") == 1).drop("_rn")


def first_of_hot(
    df: DataFrame, order: list[Column], hot: HotKeys, spread: Column, flag: str = "is_first"
) -> DataFrame:
    """Mark the first row per hot key in two rounds: first per share, then among those firsts.

    In the second round the rows that already lost stay spread by share; only the
    firsts (one per share) meet in one group.
    """
    cut = _marked(df, hot).withColumn("_cut", _share(spread)).drop("_shares")
    first = cut.withColumn("_rn", F.row_number().over(Window.partitionBy(hot.key, "_cut").orderBy(*order)))
    group = F.when(F.col("_rn") == 1, F.lit(-1)).otherwise(F.col("_cut"))
    second = first.withColumn("_group", group).withColumn(
        "_rn2", F.row_number().over(Window.partitionBy(hot.key, "_group").orderBy(*order))
    )
    return second.withColumn(flag, (F.col("_rn") == 1) & (F.col("_rn2") == 1)).drop("_cut", "_rn", "_group", "_rn2")


def mark_first(
    df: DataFrame, key: str, order: list[Column], hot_rows: int | None = None, flag: str = "is_first",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Mark exactly one row per key (the first in ``order``) of any DataFrame.

    Hot keys known from the narrow inputs of ``df`` spare a count over ``df`` itself, which runs it once more.
    """
    hot = find_hot(df, key, hot_rows) if hot is None else hot
    regular, hot_part = split_hot(df, hot)
    marked = first_of_regular(regular, key, order, flag)
    if hot_part is None:
        return marked
    return marked.unionByName(first_of_hot(hot_part, order, hot, spread_hash(*df.columns), flag))
