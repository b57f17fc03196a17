"""Relevance score and status of a review, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sentiment import DEFAULT_LEXICON, Lexicon, keyword_score

# Fixed values of the scoring definition.
OPTIMAL_LENGTH, LENGTH_SPREAD = 300, 200
WEIGHTS: Mapping[str, float] = {
    "text_length_score": 0.30, "has_image": 0.20, "has_orders": 0.10, "is_extreme_rating": 0.15, "keyword_score": 0.25,
}
PROTOTYPE_TEST_WEIGHTS: Mapping[str, float] = {
    "text_length_score": 0.25, "has_image": 0.20, "has_orders": 0.15, "is_extreme_rating": 0.15, "keyword_score": 0.25,
}
PROTOTYPE_THRESHOLD = 80.0
CONFIDENCE_THRESHOLD, RELEVANCE_THRESHOLD = 78.3, 58.8


def text_length_score(column: str = "text_length") -> Column:
    gap = F.col(column).cast("double") - OPTIMAL_LENGTH
    return F.exp(-(gap * gap) / (2.0 * LENGTH_SPREAD * LENGTH_SPREAD))


def is_extreme_rating(column: str = "rating") -> Column:
    return F.when(F.col(column).isin(1, 5), 1).otherwise(0)


def relevance_score(weights: Mapping[str, float] = WEIGHTS) -> Column:
    total = F.lit(0.0)
    for column, weight in weights.items():
        total = total + F.col(column).cast("double") * weight
    return total * 100


def add_scores(
    df: DataFrame,
    lexicon: Lexicon = DEFAULT_LEXICON,
    weights: Mapping[str, float] = WEIGHTS,
    text: str = "description",
) -> DataFrame:
    """Component scores and the relevance score (0..100) of each review."""
    return df.withColumns(
        {
            "text_length_score": text_length_score(),
            "is_extreme_rating": is_extreme_rating(),
            "keyword_score": keyword_score(text, lexicon),
        }
    ).withColumn("relevance_score", relevance_score(weights))


def _at_least(column: str, threshold: float) -> Column:
    # NaN sorts above every number in Spark, so it is ruled out by name.
    value = F.col(column).cast("double")
    return F.coalesce((value >= threshold) & ~F.isnan(value), F.lit(False))


def class_label(threshold: float = PROTOTYPE_THRESHOLD) -> Column:
    return F.when(_at_least("relevance_score", threshold), "Relevant").otherwise("Irrelevant")


def relevant_status(
    confidence: float = CONFIDENCE_THRESHOLD, relevance: float = RELEVANCE_THRESHOLD
) -> Column:
    both = _at_least("confidence_score", confidence) & _at_least("relevance_score", relevance)
    return F.when(both, "RELEVANT").otherwise("IRRELEVANT")


def flags_to_boolean(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("boolean") for c in ("has_image", "has_orders", "is_extreme_rating")})
