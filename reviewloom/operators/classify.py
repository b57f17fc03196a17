"""Topic and confidence per review: precomputed, by keywords, or by a plugged-in model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import is_blank, split_words

# The four topics.
TOPICS = (
    "product quality or satisfaction",
    "product defect or damaged item",
    "delivery issue or shipping delay",
    "customer service or support",
)

KEYWORDS: Mapping[str, tuple[str, ...]] = {
    TOPICS[0]: ("quality", "love", "great", "good", "excellent", "perfect", "satisfied", "recommend", "nice", "works"),
    TOPICS[1]: ("broken", "defective", "damaged", "crack", "leak", "faulty", "stopped", "dead", "scratched", "missing"),
    TOPICS[2]: ("delivery", "shipping", "late", "delay", "arrived", "package", "carrier", "courier", "tracking", "shipped"),
    TOPICS[3]: ("service", "support", "seller", "refund", "contact", "response", "reply", "help", "customer", "return"),
}


def with_precomputed(df: DataFrame, classes: DataFrame) -> DataFrame:
    """Join (review_id, category_review, confidence_score on 0..100) computed earlier.

    The narrow classes are held in hash tables, so that the texts are shuffled but not sorted (and spilled) for the join.
    """
    known = classes.select("review_id", "category_review", "confidence_score")
    return df.join(known.hint("shuffle_hash"), "review_id", "left")


def scale_confidence(classes: DataFrame) -> DataFrame:
    """Model output is 0..1; everything downstream uses 0..100. Apply once, on load."""
    return classes.withColumn("confidence_score", F.col("confidence_score") * 100)


def classify_by_keywords(
    df: DataFrame, text: str = "description", keywords: Mapping[str, tuple[str, ...]] = KEYWORDS
) -> DataFrame:
    """Topic with most keyword hits and its share of all hits, in (0..1).

    The first topic wins a tie; a text without hits gets an equal share. A missing or
    blank text has no topic and confidence 0.0.
    """
    topics = list(keywords)
    known = [w for t in topics for w in keywords[t]]
    words = F.filter(split_words(F.lower(F.col(text))), lambda w: w.isin(known))

    def count(ws, topic):
        return F.size(F.filter(ws, lambda w: w.isin(*keywords[topic])))

    hits = F.transform(F.array(words), lambda ws: F.array(*[count(ws, t) for t in topics]))
    best = F.array_max("_hits")
    total = F.aggregate("_hits", F.lit(0), lambda a, x: a + x)
    names = F.array(*[F.lit(t) for t in topics])
    blank = is_blank(text)
    return (
        df.withColumn("_hits", F.element_at(hits, 1))
        .withColumns(
            {
                "category_review": F.when(
                    ~blank, F.element_at(names, F.array_position("_hits", best).cast("int"))
                ),
                "confidence_score": F.when(blank, 0.0)
                .when(total == 0, 1.0 / len(topics))
                .otherwise(best / total),
            }
        )
        .drop("_hits")
    )


Scorer = Callable[[list[str], tuple[str, ...]], list[tuple[str, float]]]


def classify_with_model(
    df: DataFrame, load: Callable[[], Scorer], text: str = "description", topics: tuple[str, ...] = TOPICS
) -> DataFrame:
    """Run a zero-shot model over Arrow batches; ``load`` is called once per Python task.

    The scorer takes the non-blank texts of one batch and returns (topic, confidence)
    for each, best topic first as such models do.
    """

    @F.pandas_udf("category_review string, confidence_score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = load()
        for batch in batches:
            usable = batch.notna() & (batch.fillna("").str.strip() != "")
            out = pd.DataFrame({"category_review": None, "confidence_score": 0.0}, index=batch.index)
            if usable.any():
                found = scorer(batch[usable].tolist(), topics)
                out.loc[usable, "category_review"] = [t for t, _ in found]
                out.loc[usable, "confidence_score"] = [float(c) for _, c in found]
            yield out

    return df.withColumn("_class", run(F.col(text))).select("*", "_class.*").drop("_class")
