"""Sinks: lake files, warehouse tables, reject store, run metadata."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import PIPELINE_VERSION
from ..functions.scalar import one_line
from ..schemas import REVIEW_RELEVANT_COLUMNS, REVIEWS_COLUMNS
from .snapshots import Snapshots, published


def write_lake(df: DataFrame, path: str, fmt: str = "parquet", compression: str = "none") -> str:
    """Overwrite one lake table; CSV has a header and doubles quotes.

    ``csv-lines`` is CSV whose records are one line each: line ends and backslashes in texts are written as ``\\n``, ``\\r`` and
    ``\\b``, so that a large file is read in splits. ``compression``: of CSV; a compressed file is read whole, as one with records
    of several lines is anyhow.
    """
    if fmt == "csv-lines":
        df, fmt = one_line(df), "csv"
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression=compression)
    else:
        writer.format(fmt).save(path)
    return path


def as_reviews(clean: DataFrame, ingested_at: Column | None = None, version: str = PIPELINE_VERSION) -> DataFrame:
    """The 14 warehouse columns in order."""
    at = F.current_timestamp() if ingested_at is None else ingested_at
    return (
        clean.withColumns(
            {
                "rating": F.col("rating").cast("int"),
                "text_length": F.col("text_length").cast("int"),
                "has_image": F.col("has_image").cast("boolean"),
                "has_orders": F.col("has_orders").cast("boolean"),
                "ingestion_timestamp": at.cast("timestamp_ntz"),
                "pipeline_version": F.lit(version),
            }
        ).select(*REVIEWS_COLUMNS)
    )


def replace_table(df: DataFrame, target: str) -> int:
    """Replace a catalog table, or the published table of a folder where ``target`` is a path; returns the rows written.

    Readers see the old rows until all new ones are written (see ``snapshots.py``). States before the last two are deleted.
    """
    table = published(df.sparkSession, target)
    rows = table.replace(df)
    table.vacuum()
    return rows


def save_reviews(clean: DataFrame, target: str = "reviews", ingested_at: Column | None = None) -> int:
    """Full refresh of the warehouse table; returns the rows written, counted during the write."""
    return replace_table(as_reviews(clean, ingested_at), target)


def reject_table(spark: SparkSession, path: str) -> Snapshots:
    """Reject documents, by reason."""
    return Snapshots(spark, path, "json", ("rejection_reason",))


def as_reject_documents(rejected: DataFrame, run_id: str) -> DataFrame:
    return rejected.withColumn("run_id", F.lit(run_id))


def save_rejected(rejected: DataFrame, path: str, run_id: str) -> int:
    """Append reject documents; those of an earlier attempt of the same run are replaced."""
    return reject_table(rejected.sparkSession, path).append(as_reject_documents(rejected, run_id), run_id)


def run_metadata(
    spark: SparkSession, run_id: str, statistics: Mapping[str, int], version: str = PIPELINE_VERSION
) -> DataFrame:
    rows = [(run_id, version, {k: int(v) for k, v in statistics.items()})]
    return spark.createDataFrame(
        rows, "run_id string, pipeline_version string, statistics map<string,bigint>"
    ).select("run_id", "pipeline_version", F.current_timestamp().alias("execution_timestamp"), "statistics")


def save_metadata(metadata: DataFrame, path: str, run_id: str) -> None:
    """Append a run's metadata; a repeated run has one row."""
    Snapshots(metadata.sparkSession, path, "json").append(metadata, run_id)


def as_review_relevant(scored: DataFrame) -> DataFrame:
    """The 19 columns of the scored table in order, flags as booleans."""
    flags = {c: F.col(c).cast("boolean") for c in ("has_image", "has_orders", "is_extreme_rating")}
    return scored.withColumns(flags).select(*REVIEW_RELEVANT_COLUMNS)


def save_review_relevant(scored: DataFrame, target: str = "review_relevant") -> None:
    replace_table(as_review_relevant(scored), target)
