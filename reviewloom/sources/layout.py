"""Stored layouts that answer single requests without reading a whole table.

* ``store_bucketed``: rows dealt into buckets by a key and sorted by it. A look-up reads one bucket, of which row groups without the key
  are skipped by their statistics and bloom filters; a batch of keys meets its buckets without a shuffle of the table.
* ``Pages``: rows in the order of a key, numbered, one folder per range of the order, and a directory of the first number in each. A
  page opens only the folders that hold it, however deep it lies.
* ``TrigramIndex``: per trigram the rows that have it, as 64-bit words of row numbers. The words of a search text's trigrams
  are intersected, and only the rows left are read and compared.

All three are built by one write and are read-only after that; a newer state is a new one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import contains_ignoring_case
from ..session import scratch_path, stored

#: Rows of a bucket, about, and the least number of buckets.
BUCKET_ROWS, LEAST_BUCKETS = 1_000_000, 8
#: Tasks that share the rows of one bucket while it is written, so that a frequent key isn't written by one.
WRITERS = 4
#: Bits of a row number below its range (those of ``monotonically_increasing_id``).
RANGE_BITS = 33


@dataclass(frozen=True)
class Bucketed:
    """A table in the catalog, bucketed and sorted by ``keys``.

    Spark leaves out buckets by the value of a single column, so several keys are bucketed by their hash, ``_key``.
    """

    spark: SparkSession
    name: str
    keys: tuple[str, ...]

    @property
    def rows(self) -> DataFrame:
        return self.spark.table(self.name).drop("_key")

    def lookup(self, *values) -> DataFrame:
        """Rows with these values of the keys: one bucket is read."""
        found = self.spark.table(self.name)
        literals = [F.lit(v).cast(found.schema[c].dataType) for c, v in zip(self.keys, values, strict=True)]
        if len(self.keys) > 1:
            # Worked out here, as only a literal decides the bucket.
            found = found.where(F.col("_key") == F.lit(self.spark.range(1).select(F.xxhash64(*literals)).first()[0]))
        for column, literal in zip(self.keys, literals, strict=True):
            found = found.where(F.col(column) == literal)
        return found.drop("_key")

    def lookup_many(self, wanted: DataFrame) -> DataFrame:
        """Rows whose keys are among those of ``wanted``; with a single key the table stays where it is, the keys come to it."""
        return self.rows.join(wanted.select(*self.keys).distinct(), list(self.keys), "left_semi")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def store_bucketed(df: DataFrame, name: str, keys: Sequence[str], sort: Sequence[str] = (), buckets: int | None = None) -> Bucketed:
    """Write ``df`` bucketed by ``keys``, sorted by them and then by ``sort``, with bloom filters on text keys."""
    spark = df.sparkSession
    buckets = buckets or max(LEAST_BUCKETS, -(-df.count() // BUCKET_ROWS))
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    texts = [k for k in keys if df.schema[k].dataType.simpleString() == "string"]
    # Rows of a bucket go to a few tasks by the rest of the row: whole buckets to each would leave a hot key to one of them.
    part = F.pmod(F.xxhash64(*df.columns), F.lit(WRITERS))
    by = list(keys) if len(keys) == 1 else ["_key"]
    rows = df if len(keys) == 1 else df.withColumn("_key", F.xxhash64(*keys))
    writer = rows.repartition(buckets * WRITERS, *[F.col(c) for c in by], part).write.format("parquet").option("path", scratch_path(spark, table))
    for k in texts:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
    writer.bucketBy(buckets, *by).sortBy(*keys, *sort).saveAsTable(table)
    return Bucketed(spark, table, tuple(keys))


def _number(df: DataFrame) -> DataFrame:
    """Number the rows of each partition: ``_range`` and ``_row`` in it."""
    number = F.monotonically_increasing_id()
    mask = F.lit((1 << RANGE_BITS) - 1)
    return df.withColumn("_id", number).withColumns(
        {"_range": F.shiftright("_id", RANGE_BITS).cast("int"), "_row": F.col("_id").bitwiseAND(mask)}
    ).drop("_id")


def _stored_by_range(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy("_range").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Pages:
    """Rows in the order of ``keys`` (nulls first), to be read a page at a time.

    Rows with equal keys are put in the order of the other columns, so the order is the same every time, and a key
    that very many rows share is still cut into ranges.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], ranges: int | None = None) -> None:
        order = [F.col(c).asc_nulls_first() for c in [*keys, *[c for c in df.columns if c not in keys]]]
        self.columns = df.columns
        dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
        self.rows = _stored_by_range(_number(dealt.sortWithinPartitions(*order)), "pages")
        # One row per range: its first number in the whole order.
        counts = self.rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).orderBy("_range").collect()
        self.starts, total = [], 0
        for r in counts:
            self.starts.append((r["_range"], total, r["n"]))
            total += r["n"]

    def page(self, skip: int = 0, limit: int = 100) -> DataFrame:
        """The same rows as ``orderBy(...).offset(skip).limit(limit)``."""
        wanted = F.lit(False)
        for range_, first, n in self.starts:
            if first < skip + limit and first + n > skip:
                inside = (F.col("_row") >= skip - first) & (F.col("_row") < skip + limit - first)
                wanted = wanted | ((F.col("_range") == range_) & inside)
        found = self.rows.where(wanted)
        return found.orderBy("_range", "_row").select(*self.columns)


def trigrams(text: Column) -> Column:
    """The different runs of three characters of a text in lower case; none for a shorter or null text."""
    chars = F.split(F.lower(text), "", -1)
    runs = F.transform(chars, lambda c, i: F.concat(c, F.get(chars, i + 1), F.get(chars, i + 2)))
    return F.array_distinct(F.filter(runs, lambda r: F.length(r) == 3))


class TrigramIndex:
    """Substring search in one column without regard to case."""

    def __init__(self, df: DataFrame, column: str, ranges: int | None = None) -> None:
        self.spark, self.column, self.columns = df.sparkSession, column, df.columns
        self.rows = _stored_by_range(_number(df), "searched")
        having = self.rows.select("_range", "_row", F.explode(trigrams(F.col(column))).alias("trigram"))
        bit = F.col("_row").bitwiseAND(F.lit(63)).cast("int").alias("bit")
        having = having.select("trigram", "_range", F.shiftright("_row", 6).alias("word"), bit)
        # Words of the same rows meet in any order; a trigram that most rows have is many words, not one list.
        words = having.groupBy("trigram", "_range", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        dealt = words.repartitionByRange(ranges, "trigram", "_range", "word") if ranges else words.repartitionByRange("trigram", "_range", "word")
        self.words = stored(dealt.sortWithinPartitions("trigram"), "trigrams")

    def candidates(self, text: str) -> DataFrame | None:
        """(_range, _row) of the rows that have all trigrams of the text; None where it is too short to have one."""
        wanted = self.spark.range(1).select(trigrams(F.lit(text))).first()[0]
        if not wanted:
            return None
        met = self.words.where(F.col("trigram").isin(wanted)).groupBy("_range", "word")
        met = met.agg(F.bit_and("bits").alias("bits"), F.count(F.lit(1)).alias("n")).where((F.col("n") == len(wanted)) & (F.col("bits") != 0))
        set_ = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(F.col("bits"), b) == 1)
        return met.select("_range", F.explode(set_).alias("b"), "word").select("_range", (F.col("word") * 64 + F.col("b")).alias("_row"))

    def search(self, text: str) -> DataFrame:
        """The rows whose column contains the text; a text of fewer than three characters is looked for in all rows."""
        found, rows = self.candidates(text), self.rows
        if found is not None:
            rows = rows.join(found, ["_range", "_row"], "left_semi")
        return rows.where(contains_ignoring_case(self.column, text)).select(*self.columns)
