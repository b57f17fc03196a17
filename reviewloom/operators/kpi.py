"""Aggregate reports over raw, clean and scored reviews.

Group keys may be very uneven: every report is a plain aggregate, so each map task
sends one partial row per group whatever the group's size. Top lists carry the
group key as last sort column, which makes them repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import n_rows
from .keysets import distinct_counts


def _relevant() -> Column:
    return F.col("relevant_status") == "RELEVANT"


def _flag_sum(column: str) -> Column:
    return F.sum(F.col(column).cast("int"))


# --- exploration ---------------------------------------------------------------
def rating_distribution(df: DataFrame) -> DataFrame:
    """Reviews per rating and their share, from one scan; the total is that of the few rows per rating."""
    counted = df.where(F.col("rating").isNotNull()).groupBy("rating").agg(n_rows().alias("nb_reviews"))
    total = F.sum("nb_reviews").over(Window.partitionBy())
    return counted.withColumn("percentage", F.col("nb_reviews") / total * 100).orderBy("rating")


def dataset_summary(df: DataFrame) -> DataFrame:
    """One row of counts, shares and text lengths.

    ``percentile`` keeps one counter per distinct text length; lengths are limited by
    the column's declared size, so that state is small at any number of rows.
    """
    return df.agg(
        n_rows().alias("total_reviews"),
        _flag_sum("has_image").alias("with_images"),
        (F.avg(F.col("has_image").cast("int")) * 100).alias("pct_images"),
        _flag_sum("has_orders").alias("with_orders"),
        (F.avg(F.col("has_orders").cast("int")) * 100).alias("pct_orders"),
        F.avg("text_length").alias("avg_length"),
        F.percentile("text_length", 0.5).alias("median_length"),
        F.min("text_length").alias("min_length"),
        F.max("text_length").alias("max_length"),
        F.avg("rating").alias("avg_rating"),
    )


def length_by_rating(df: DataFrame) -> DataFrame:
    return df.groupBy("rating").agg(F.avg("text_length").alias("avg_length")).orderBy("rating")


def images_by_rating(df: DataFrame) -> DataFrame:
    share = F.avg(F.col("has_image").cast("int")) * 100
    return df.groupBy("rating").agg(share.alias("pct_images")).orderBy("rating")


def class_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(n_rows().alias("nb_reviews")).orderBy(F.desc("nb_reviews"), column)


def mean_confidence(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("confidence_score").alias("avg_confidence"))


def orders_flag_counts(df: DataFrame) -> DataFrame:
    flag = F.col("has_orders").cast("int")
    return df.agg(F.count_if(flag == 1).alias("with_orders"), F.count_if(flag == 0).alias("without_orders"))


# --- warehouse views -----------------------------------------------------------
def reviews_by_product(reviews: DataFrame) -> DataFrame:
    return (
        reviews.groupBy("p_id", "product_name")
        .agg(
            n_rows().alias("total_reviews"),
            F.avg("rating").alias("avg_rating"),
            _flag_sum("has_image").alias("reviews_with_images"),
            F.min("ingestion_timestamp").alias("first_review"),
            F.max("ingestion_timestamp").alias("last_review"),
        )
        .orderBy(F.desc("total_reviews"), "p_id")
    )


def reviews_by_category(reviews: DataFrame, approximate: bool = False) -> DataFrame:
    """Reviews, mean rating and different products per category.

    Products are counted exactly through key sets per category, from the two columns they need; the rest is one plain aggregate.
    """
    rows = reviews.where(F.col("category").isNotNull())
    plain = [n_rows().alias("total_reviews"), F.avg("rating").alias("avg_rating")]
    if approximate:
        found = rows.groupBy("category").agg(*plain, F.approx_count_distinct("p_id").alias("unique_products"))
    else:
        products = distinct_counts(rows, ["p_id"], "category").withColumnRenamed("p_id", "unique_products")
        found = rows.groupBy("category").agg(*plain).join(products, "category", "left").fillna(0, ["unique_products"])
    return found.orderBy(F.desc("total_reviews"), "category")


def data_quality_view(reviews: DataFrame) -> DataFrame:
    """Counts of rows, of different ids, and of gaps; the three distinct counts come from one scan of the id columns."""
    ids = {"review_id": "unique_reviews", "buyer_id": "unique_buyers", "p_id": "unique_products"}
    different = distinct_counts(reviews, list(ids)).withColumnsRenamed(ids).select(F.struct(*ids.values())).scalar()
    return reviews.agg(
        n_rows().alias("total_reviews"),
        F.avg("rating").alias("avg_rating"),
        (_flag_sum("has_image") / n_rows() * 100).alias("pct_with_images"),
        F.count_if(F.col("description").isNull() | (F.col("description") == "")).alias("empty_descriptions"),
    ).withColumn("_d", different).select(
        "total_reviews", *[F.col(f"_d.{c}").alias(c) for c in ids.values()], "avg_rating", "pct_with_images", "empty_descriptions",
    )


WAREHOUSE_VIEWS = {
    "vw_reviews_by_product": reviews_by_product,
    "vw_reviews_by_category": reviews_by_category,
    "vw_data_quality": data_quality_view,
}


def create_views(reviews: DataFrame) -> None:
    for name, build in WAREHOUSE_VIEWS.items():
        build(reviews).createOrReplaceTempView(name)


# --- dashboard -----------------------------------------------------------------
def kpi_global(scored: DataFrame) -> DataFrame:
    return scored.agg(
        n_rows().alias("total_reviews"),
        F.count_if(_relevant()).alias("nb_relevant"),
        *[
            F.round(F.avg(c), 2).alias(f"avg_{c}")
            for c in ("rating", "relevance_score", "confidence_score", "text_length")
        ],
    )


def kpi_status(scored: DataFrame) -> DataFrame:
    return scored.groupBy("relevant_status").agg(n_rows().alias("nb_reviews"))


def kpi_category(scored: DataFrame) -> DataFrame:
    return (
        scored.groupBy("category")
        .agg(
            n_rows().alias("nb_reviews"),
            F.count_if(_relevant()).alias("nb_relevant"),
            F.round(F.count_if(_relevant()) / n_rows(), 3).alias("pourcentage_relevant"),
            F.round(F.avg("rating"), 2).alias("avg_rating"),
        )
        .orderBy(F.desc("nb_reviews"), "category")
    )


def _count_by(df: DataFrame, keys: list[str], name: str, limit: int | None, ascending: bool = False) -> DataFrame:
    order = F.asc(name) if ascending else F.desc(name)
    out = df.groupBy(*keys).agg(n_rows().alias(name)).orderBy(order, *keys)
    return out if limit is None else out.limit(limit)


def kpi1_top_products(scored: DataFrame, limit: int = 20) -> DataFrame:
    return _count_by(scored.where(_relevant()), ["product_name"], "nb_relevant_reviews", limit)


def kpi2_topics(scored: DataFrame) -> DataFrame:
    return _count_by(scored.where(_relevant()), ["category_review"], "nb_relevant", None)


def kpi3_top_buyers(scored: DataFrame, limit: int = 20) -> DataFrame:
    return _count_by(scored.where(_relevant()), ["buyer_id"], "nb_relevant_reviews", limit)


def kpi4_rare_products(scored: DataFrame, limit: int = 20) -> DataFrame:
    return _count_by(scored, ["product_name", "category_review"], "nb_reviews", limit, ascending=True)


def kpi4_rare_relevant_products(scored: DataFrame, limit: int = 20) -> DataFrame:
    return _count_by(scored.where(_relevant()), ["product_name"], "nb_reviews", limit, ascending=True)


def kpi5_active_buyers(scored: DataFrame, limit: int = 20) -> DataFrame:
    return (
        scored.groupBy("buyer_id")
        .agg(
            n_rows().alias("total_reviews"),
            F.count_if(_relevant()).alias("nb_relevant"),
            F.round(F.count_if(_relevant()) / n_rows(), 3).alias("pct_relevant"),
        )
        .orderBy(F.desc("total_reviews"), "buyer_id")
        .limit(limit)
    )


def kpi6_most_reviewed(scored: DataFrame, limit: int = 20) -> DataFrame:
    return _count_by(scored, ["product_name"], "nb_reviews", limit)


def kpi7_service_reviews(scored: DataFrame, topic: str = "customer service or support") -> DataFrame:
    return (
        scored.where(F.col("category_review") == topic)
        .orderBy("rating", "review_id")
        .select("product_name", "rating", "relevance_score", "confidence_score", "description")
    )
