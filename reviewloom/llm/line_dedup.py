"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches by ascending id. A run is a stored table of (hash, owner): the lines seen so far, each
with the smallest document that holds it. A batch is merge-anti-joined with the runs; what is left is new, gets the
batch's smallest document as owner, and becomes a run of level 0. Two runs of a level are compacted into one of the
next by a merge join, so a batch meets about ``log2(batches)`` runs. At the end each line's owner is known, and a line
goes wherever its document isn't the owner.

Runs are bucketed by the hash into as many buckets as a shuffle has partitions, one sorted file each. So a batch is
shuffled once, for its own aggregate, and then meets bucket after bucket: runs are neither shuffled nor sorted again.
Only (hash, document, place) travels until the end, 16 bytes of hash a line; the texts are shuffled
once, with the places to drop. All of it is DataFrame operations: no Python runs on the executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import SPACES, stored, whole_text

#: Batches: one per so many bytes of text, ``BATCHES`` at least and ``MOST_BATCHES`` at most; a batch may have any size.
BATCH_BYTES = 8 << 40
BATCHES, MOST_BATCHES = 4, 64
LEAST_CHARS = 10
_SORTED_SCANS = "spark.sql.legacy.bucketedTableScan.outputOrdering"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LAST = (1 << 63) - 1


def line_key(line: Column) -> Column:
    """The line without ``SPACES`` at both ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(SPACES))
    # lower() is the same and faster where all is ASCII; elsewhere it would change other letters too.
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_places(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(a, b, doc, copy, place): two hashes of each line's key that is long enough, and where it stands.

    ``copy`` tells rows with one id and different texts apart. A null id comes after all others.
    """
    text = whole_text()
    rows = docs.select(_id().alias("doc"), text.alias("text"))
    rows = rows.select("doc", F.xxhash64("text").alias("copy"), F.posexplode(_lines(F.col("text"))).alias("place", "line"))
    keyed = rows.select("doc", "copy", "place", line_key(F.col("line")).alias("key")).where(F.length("key") >= least_chars)
    return keyed.select(F.xxhash64("key").alias("a"), F.xxhash64(F.lit(1), F.col("key")).alias("b"), "doc", "copy", "place")


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))


def _batch_edges(docs: DataFrame, batches: int | None) -> list[int]:
    """Ids at which a new batch begins, from one aggregate: ``MOST_BATCHES`` quantiles, of which the batches take some."""
    quantiles = F.array(*[F.lit(i / MOST_BATCHES) for i in range(1, MOST_BATCHES)])
    size = F.sum(F.octet_length(whole_text()).cast("long")).alias("bytes")
    seen = docs.agg(size, F.percentile_approx(_id(), quantiles).alias("edges")).head()
    batches = min(batches or max(BATCHES, (seen["bytes"] or 0) // BATCH_BYTES), MOST_BATCHES)
    edges = seen["edges"] or []
    return sorted({edges[i * MOST_BATCHES // batches - 1] for i in range(1, batches)}) if edges else []


def _batch_of(edges: list[int]) -> Column:
    """How many of the edges are at or below the document's id."""
    return reduce(Column.__add__, [(F.col("doc") >= e).cast("int") for e in edges], F.lit(0))


@contextmanager
def _run_tables(spark: SparkSession) -> Iterator[str]:
    """A database in the shared folder, dropped with its tables at the end; scans of sorted buckets keep their order meanwhile."""
    name = f"line_runs_{uuid.uuid4().hex}"
    before = spark.conf.get(_SORTED_SCANS)
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    spark.conf.set(_SORTED_SCANS, "true")
    try:
        yield name
    finally:
        spark.conf.set(_SORTED_SCANS, before)
        spark.sql(f"DROP DATABASE {name} CASCADE")


def _buckets(spark: SparkSession) -> int:
    """As many as a shuffle has partitions: then a batch that was just aggregated meets the runs as it is."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))


def _sorted_run(run: DataFrame, database: str) -> str:
    """The name of a table with one sorted file per bucket, as the rows come dealt by (a, b) already."""
    spark, name = run.sparkSession, f"{database}.run_{uuid.uuid4().hex}"
    run.write.format("parquet").bucketBy(_buckets(spark), "a", "b").sortBy("a", "b").saveAsTable(name)
    return name


def _as_files(spark: SparkSession, run: str) -> DataFrame:
    """The rows of a run, its buckets left out of account."""
    place = spark.sql(f"DESCRIBE FORMATTED {run}").where("col_name = 'Location'").first()["data_type"]
    return spark.read.schema(spark.table(run).schema).parquet(place)


def new_lines(batch: DataFrame, runs: list[str]) -> DataFrame:
    """(a, b, owner): the lines of ``batch`` that no run holds."""
    fresh = batch.groupBy("a", "b").agg(F.min("doc").alias("owner"))
    for run in runs:
        fresh = fresh.join(batch.sparkSession.table(run).select("a", "b").hint("merge"), ["a", "b"], "left_anti")
    return fresh


def compacted(spark: SparkSession, older: str, newer: str) -> DataFrame:
    """Two runs as one: no line is in both, so the full outer merge join is their merge in order."""
    left, right = spark.table(older), spark.table(newer).select(*[F.col(c).alias(f"_{c}") for c in ("a", "b", "owner")])
    met = left.join(right.hint("merge"), (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "full_outer")
    return met.select(*[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) for c in ("a", "b", "owner")])


def owners(places: DataFrame, batches: int, database: str) -> list[str]:
    """The runs (a, b, owner) after all batches of ``places``; a line is in exactly one of them."""
    spark, levels = places.sparkSession, []
    for number in range(batches):
        new = _sorted_run(new_lines(places.where(F.col("batch") == number), [r for r in levels if r]), database)
        level = 0
        while level < len(levels) and levels[level]:
            merged = _sorted_run(compacted(spark, levels[level], new), database)
            for run in (levels[level], new):
                spark.sql(f"DROP TABLE {run}")
            new, levels[level] = merged, None
            level += 1
        levels[level : level + 1] = [new]
    return [r for r in levels if r]


def dropped_places(docs: DataFrame, batches: int | None = None, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc, copy, places): per row of ``docs`` that loses lines, their places in ascending order."""
    edges = _batch_edges(docs, batches)
    with _run_tables(docs.sparkSession) as database:
        name = f"{database}.places"
        rows = line_places(docs, least_chars).withColumn("batch", _batch_of(edges))
        rows.write.format("parquet").partitionBy("batch").saveAsTable(name)
        places = docs.sparkSession.table(name)
        # Read as plain files: where both sides are shuffled, Spark cuts up the places of a line that very many documents hold.
        runs = [_as_files(docs.sparkSession, run) for run in owners(places, len(edges) + 1, database)]
        gone = places.join(reduce(DataFrame.unionAll, runs), ["a", "b"]).where(F.col("doc") != F.col("owner"))
        # Stored, as the runs go.
        return stored(gone.groupBy("doc", "copy").agg(F.array_sort(F.collect_set("place")).alias("places")), "line-drops")


def _kept_text(lines: Column, places: Column, text: Column) -> Column:
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places)
    joined = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    return F.when(places.isNull(), text).otherwise(joined)


def _deduped(docs: DataFrame, batches: int | None, least_chars: int) -> DataFrame:
    """(_row, _kept, _lines, _dropped): each row of ``docs`` with its text after the lines went, and two counts."""
    gone = dropped_places(docs, batches, least_chars)
    gone = gone.select(F.col("doc").alias("_doc"), F.col("copy").alias("_copy"), F.col("places").alias("_places"))
    row = docs.select(
        F.struct(*docs.columns).alias("_row"), _id().alias("_id"),
        F.xxhash64(whole_text()).alias("_hash"), whole_text().alias("_text"),
    )
    met = row.join(gone.hint("shuffle_hash"), (F.col("_id") == F.col("_doc")) & (F.col("_hash") == F.col("_copy")), "left")
    met = met.withColumn("_split", _lines(F.col("_text")))
    return met.select(
        "_row", _kept_text(F.col("_split"), F.col("_places"), F.col("_text")).alias("_kept"),
        F.size("_split").cast("long").alias("_lines"), F.coalesce(F.size("_places"), F.lit(0)).cast("long").alias("_dropped"),
    )


def dedup_documents(docs: DataFrame, batches: int | None = None, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``docs`` with the lines that go dropped from ``text``, and ``n_chars`` to match where there is one.

    A line goes if its key has ``least_chars`` code points or more and a document with a smaller id holds
    the key too; within the smallest document all its lines stay. A null or empty text is one empty line and
    becomes the empty text. Rows that repeat an id are one document. A null id comes after all others. An
    empty table gives an empty result. Other columns are kept as they are. Ids are whole numbers or texts that spell one.
    """
    new = {"text": F.col("_kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("_kept").cast(docs.schema["n_chars"].dataType)
    kept = _deduped(docs, batches, least_chars)
    return kept.select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def line_report(docs: DataFrame, batches: int | None = None) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) for every row; see ``dedup_documents``."""
    kept = _deduped(docs.select("doc_id", "text"), batches, LEAST_CHARS)
    return kept.select(
        "_row.doc_id", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"),
        F.sha2(F.col("_kept"), 256).alias("kept_sha256"),
    )
