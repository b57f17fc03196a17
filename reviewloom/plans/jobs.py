"""The batch jobs: reviews (join, clean, store) and scoring."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.scoring import CONFIDENCE_THRESHOLD, RELEVANCE_THRESHOLD, WEIGHTS, add_scores, relevant_status
from ..functions.sentiment import DEFAULT_LEXICON, Lexicon
from ..operators.classify import with_precomputed
from ..operators.clean import FULL_RULES, REASON, Rule, clean_rows, join_and_flag, rejected_rows
from ..session import STAGED_CODEC, remove_path, scratch_path
from ..sources.readers import load_tables
from ..sources.snapshots import published
from ..sources.writers import as_reject_documents, as_reviews, reject_table, run_metadata, save_metadata


def new_run_id() -> str:
    return f"{datetime.now(timezone.utc):%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"


def stage_flagged(flagged: DataFrame, path: str) -> tuple[DataFrame, dict[str, int]]:
    """Write the flagged rows once, with their verdict, and count clean and rejected ones on the way.

    All sinks read this table, so the joins run once and a lost executor costs its own
    tasks only. The verdict is a column: folders by it would have every task sort its texts first.
    """
    seen = Observation()
    clean = F.col(REASON).isNull()
    (
        flagged.observe(
            seen, F.count(F.lit(1)).alias("total"), F.count_if(clean).alias("clean"), F.count_if(~clean).alias("rejected")
        )
        .withColumn("verdict", F.when(clean, "clean").otherwise("rejected"))
        .write.mode("error").option("compression", STAGED_CODEC).parquet(path)
    )
    spark = flagged.sparkSession
    schema = flagged.withColumn("verdict", F.lit("")).schema
    return spark.read.schema(schema).parquet(path), dict(seen.get)


def process_tables(
    tables: Mapping[str, DataFrame],
    reviews_table: str,
    reject_path: str,
    metadata_path: str,
    product_id: str | None = None,
    rules: tuple[Rule, ...] = FULL_RULES,
    hot_rows: int | None = None,
    run_id: str | None = None,
    ingested_at: Column | None = None,
    staging: str | None = None,
) -> dict[str, int]:
    """Join, clean, store clean and rejected rows, record the run; returns its statistics.

    The flagged rows are staged under ``staging`` (by default in the shared folder), which is deleted in any case. All data are written
    before the first table is published, and each is published in one step. A run repeated under its ``run_id`` replaces
    what it left behind, in whichever step it failed.
    """
    run_id = run_id or new_run_id()
    spark = next(iter(tables.values())).sparkSession
    staging = staging or scratch_path(spark, "flagged")
    try:
        staged, counts = stage_flagged(join_and_flag(tables, product_id, rules, hot_rows), staging)
        clean = clean_rows(staged.where(F.col("verdict") == "clean").drop("verdict"), fill=rules is FULL_RULES)
        reviews, rejects = published(spark, reviews_table), reject_table(spark, reject_path)
        new_reviews = reviews.write(as_reviews(clean, ingested_at), run_id)
        new_rejects = None
        if counts["rejected"]:
            rejected = rejected_rows(staged.where(F.col("verdict") == "rejected").drop("verdict"))
            new_rejects = rejects.write(as_reject_documents(rejected, run_id), run_id)
        reviews.publish(new_reviews)
        if new_rejects:
            rejects.publish(new_rejects, append=True)
    finally:
        remove_path(spark, staging)
    statistics = {
        "total_records_processed": counts["total"],
        "clean_records": counts["clean"],
        "rejected_records": counts["rejected"],
        "warehouse_inserts": new_reviews[0].n_rows,
        "reject_inserts": new_rejects[0].n_rows if new_rejects else 0,
    }
    save_metadata(run_metadata(spark, run_id, statistics), metadata_path, run_id)
    reviews.vacuum()
    return statistics


def process(
    spark: SparkSession, paths: Mapping[str, str | None], reviews_table: str, reject_path: str, metadata_path: str,
    fmt: str = "parquet", **options,
) -> dict[str, int]:
    """The reviews job from lake paths."""
    tables, _ = load_tables(spark, paths, fmt)
    return process_tables(tables, reviews_table, reject_path, metadata_path, **options)


def score_reviews(
    reviews: DataFrame,
    classes: DataFrame,
    lexicon: Lexicon = DEFAULT_LEXICON,
    weights: Mapping[str, float] = WEIGHTS,
    confidence: float = CONFIDENCE_THRESHOLD,
    relevance: float = RELEVANCE_THRESHOLD,
) -> DataFrame:
    """Clean reviews with all scores, topic and relevant status."""
    scored = with_precomputed(add_scores(reviews, lexicon, weights), classes)
    return scored.withColumn("relevant_status", relevant_status(confidence, relevance))
