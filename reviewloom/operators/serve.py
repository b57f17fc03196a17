"""Lookups and rankings the API and shop pages ask for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import contains_ignoring_case, image_list, number_or_zero
from .joins import PART_ITEMS, reviews_with_images

RELEVANT = "RELEVANT"


def run_query(spark: SparkSession, sql: str, **parameters) -> DataFrame:
    """SQL text with bound parameters (``:name``); values never enter the text."""
    return spark.sql(sql, args=parameters)


def lookup(df: DataFrame, **keys) -> DataFrame:
    """Rows whose key columns equal the given values."""
    for column, value in keys.items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def lookup_stripped(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose column equals the text without white space of any kind at its ends."""
    return lookup(df, **{column: text.strip()})


def page(df: DataFrame, key: str, skip: int = 0, limit: int = 100) -> DataFrame:
    return df.orderBy(key).offset(skip).limit(limit)


def search(df: DataFrame, column: str, text: str) -> DataFrame:
    return df.where(contains_ignoring_case(column, text))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def product_list(scored: DataFrame, limit: int = 100) -> DataFrame:
    return (
        scored.select("p_id", "product_name", "category").distinct()
        .orderBy(F.asc_nulls_first("product_name"), F.asc_nulls_first("p_id")).limit(limit)
    )


def buyer_products(scored: DataFrame, buyer_id: str | None = None) -> DataFrame:
    """Distinct products one buyer reviewed, or those of all buyers in one pass."""
    columns = ["p_id", "product_name", "category"]
    if buyer_id is None:
        return scored.where(F.col("buyer_id").isNotNull()).select("buyer_id", *columns).distinct()
    return scored.where(F.col("buyer_id") == buyer_id).select(*columns).distinct().orderBy("p_id")


def as_review(df: DataFrame) -> DataFrame:
    """The record the API returns: image list, ``r_desc`` name, real booleans."""
    flags = {c: F.coalesce(F.col(c), F.lit(False)).cast("boolean") for c in ("has_image", "has_orders")}
    return (
        df.withColumns(flags)
        .withColumn("is_extreme_rating", F.col("is_extreme_rating").cast("boolean"))
        .withColumn("images", image_list("review_img"))
        .withColumnRenamed("description", "r_desc")
        .drop("review_img")
    )


def _ranking(score: str) -> list[Column]:
    return [F.col(score).desc_nulls_last(), F.col("review_id").asc()]


def product_reviews(scored: DataFrame, p_id: str, limit: int = 10) -> DataFrame:
    """Best relevant reviews of one product by relevance score."""
    rows = scored.where((F.col("p_id") == p_id) & (F.col("relevant_status") == RELEVANT))
    return as_review(rows.orderBy(*_ranking("relevance_score")).limit(limit))


def best_reviews_per_product(
    scored: DataFrame, limit: int = 10, score: str = "relevance_score", products: DataFrame | None = None
) -> DataFrame:
    """The same for many products at once, with the rank.

    The rank filter lets Spark keep only ``limit`` rows per product before the shuffle,
    so a product with very many reviews sends no more than any other.
    """
    rows = scored.where(F.col("p_id").isNotNull() & (F.col("relevant_status") == RELEVANT))
    if products is not None:
        rows = rows.join(products.select("p_id"), "p_id", "left_semi")
    w = Window.partitionBy("p_id").orderBy(*_ranking(score))
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def review_ranking(scored: DataFrame, limit: int = 50) -> DataFrame:
    """The ``limit`` best relevant reviews of every product by each score: ``by``, ``rank`` and the review.

    Made once to be stored by product (``sources/layout.py``): no product has more than ``limit`` rows per score,
    however many reviews it has, and requests read them in order.
    """
    ranked = [
        best_reviews_per_product(scored, limit, score).withColumn("by", F.lit(score)) for score in ("relevance_score", "confidence_score")
    ]
    return ranked[0].unionByName(ranked[1])


def ranked_reviews(ranking: DataFrame, by: str, limit: int) -> DataFrame:
    """The first ``limit`` rows of a ranking of one score, for one product or many."""
    return ranking.where((F.col("by") == by) & (F.col("rank") <= limit))


def buyer_product_reviews(scored: DataFrame, buyer_id: str, p_id: str) -> DataFrame:
    rows = scored.where(
        (F.col("buyer_id") == buyer_id) & (F.col("p_id") == p_id) & (F.col("relevant_status") == RELEVANT)
    )
    return as_review(rows.orderBy(*_ranking("relevance_score")))


def _short(rows: DataFrame) -> list[Column]:
    return [
        F.col("review_id"), F.col("buyer_id"), F.col("description").alias("r_desc"), F.col("title"),
        F.col("rating"), F.col("has_image").cast("boolean").alias("has_image"),
        number_or_zero("confidence_score").alias("confidence_score"), F.col("product_name"),
    ]


def as_short(rows: DataFrame) -> DataFrame:
    """The short record of a review, confidence 0 where there is none."""
    return rows.select(*_short(rows))


def reviews_by_confidence(scored: DataFrame, p_id: str, limit: int = 5) -> DataFrame:
    rows = scored.where((F.col("p_id") == p_id) & (F.col("relevant_status") == RELEVANT))
    return rows.orderBy(*_ranking("confidence_score")).limit(limit).select(*_short(rows))


def buyer_reviews_with_images(
    scored: DataFrame, review_images: DataFrame, buyer_id: str | None = None, p_id: str | None = None,
    part_rows: int = PART_ITEMS,
) -> DataFrame:
    """Relevant reviews by confidence with all their images, for one (buyer, product) or for all."""
    rows = scored.where(F.col("relevant_status") == RELEVANT)
    if buyer_id is not None:
        rows = rows.where(F.col("buyer_id") == buyer_id)
    if p_id is not None:
        rows = rows.where(F.col("p_id") == p_id)
    out = reviews_with_images(rows.select("p_id", *_short(rows)), review_images, part_rows)
    return out.orderBy(F.col("confidence_score").desc(), "review_id") if buyer_id or p_id else out


def images_of_product(product_images: DataFrame, p_id: str) -> DataFrame:
    return lookup(product_images, p_id=p_id)
