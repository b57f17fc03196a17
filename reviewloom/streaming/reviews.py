"""The cleaning rules on a stream of reviews, and running counts.

Files that arrive in a folder are read in micro-batches. Rows delivered twice are dropped within the watermark; copies
of a review id are told by the ids seen before, which are kept as a published table like all results. Each batch publishes under its own
number, so a batch that runs again after a failure replaces what it wrote (``sources/snapshots.py``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import FULL_RULES, REASON, Rule, apply_rules, clean_rows, keep_order, rejected_rows
from ..operators.skew import mark_first
from ..session import remove_path, scratch_path
from ..sources.snapshots import Snapshots

ARRIVED = "arrived_at"


def arriving(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int = 64) -> DataFrame:
    """Rows of the files that arrive in a folder, with the time of their file as event time."""
    stream = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch)
    return stream.load(folder).select("*", F.col("_metadata.file_modification_time").alias(ARRIVED))


@dataclass(frozen=True)
class Sinks:
    """Where a cleaning stream publishes: clean rows, rejects, and the review ids seen."""

    clean: Snapshots
    rejected: Snapshots
    seen: Snapshots

    @classmethod
    def under(cls, spark: SparkSession, root: str) -> Sinks:
        return cls(Snapshots(spark, f"{root}/clean"), Snapshots(spark, f"{root}/rejected", "json", (REASON,)), Snapshots(spark, f"{root}/seen"))


def publish_batch(batch: DataFrame, number: int, sinks: Sinks, rules: tuple[Rule, ...] = FULL_RULES) -> None:
    """Judge one batch against the ids of earlier ones and publish its three results."""
    spark, run = batch.sparkSession, f"batch-{number:012d}"
    staging = scratch_path(spark, "stream-batch")
    try:
        batch.write.parquet(staging)
        rows = spark.read.schema(batch.schema).parquet(staging)
        if rows.isEmpty():  # Spark also runs batches without data, to move the watermark
            return
        marked = mark_first(rows, "review_id", keep_order(rows.columns))
        if sinks.seen.state().version:
            known = sinks.seen.read(without_run=run).select(F.col("review_id").alias("_seen"), F.lit(True).alias("_known"))
            marked = marked.join(known, F.col("review_id").eqNullSafe(F.col("_seen")), "left")
            marked = marked.withColumn("is_first", F.col("is_first") & F.col("_known").isNull()).drop("_seen", "_known")
        flagged = apply_rules(marked, rules)
        sinks.clean.append(clean_rows(flagged, fill=False), run)
        sinks.rejected.append(rejected_rows(flagged), run)
        sinks.seen.append(flagged.where(f"{REASON} IS NULL OR {REASON} <> 'duplicate_review_id'").select("review_id"), run)
    finally:
        remove_path(spark, staging)


def clean_stream(rows: DataFrame, sinks: Sinks, checkpoint: str, delay: str = "7 days", rules: tuple[Rule, ...] = FULL_RULES, **trigger) -> StreamingQuery:
    """Start the stream; ``trigger`` is Spark's, by default all files there now and then the end.

    A row delivered again within ``delay`` of its first delivery is dropped. State is bounded by the watermark.
    """
    columns = [c for c in rows.columns if c != ARRIVED]
    once = rows.withWatermark(ARRIVED, delay).dropDuplicatesWithinWatermark(columns)
    writer = once.drop(ARRIVED).writeStream.option("checkpointLocation", checkpoint)
    return writer.foreachBatch(lambda batch, number: publish_batch(batch, number, sinks, rules)).trigger(**(trigger or {"availableNow": True})).start()


def running_counts(rows: DataFrame, key: str, target: Snapshots, checkpoint: str, **trigger) -> StreamingQuery:
    """Reviews and mean rating per key so far, published after each batch; a batch sends only the keys that changed."""
    found = rows.groupBy(key).agg(F.count(F.lit(1)).alias("nb_reviews"), F.sum("rating").alias("sum_rating"), F.count("rating").alias("rated"))

    def merge(batch: DataFrame, number: int) -> None:
        changed = batch
        if target.state().version:
            # Values are totals: a batch that runs again puts the same ones in place.
            old = target.read()
            kept = old.join(changed.select(F.col(key).alias("_k"), F.lit(True).alias("_new")), F.col(key).eqNullSafe(F.col("_k")), "left")
            changed = kept.where("_new IS NULL").select(*old.columns).unionByName(changed)
        target.replace(changed, f"batch-{number:012d}")

    writer = found.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(merge)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
