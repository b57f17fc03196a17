"""Split joined reviews into clean and rejected rows, first matching rule wins."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import is_blank
from ..schemas import JOINED_COLUMNS
from .joins import join_parts
from .skew import HotKeys, first_of_hot, first_of_regular, mark_first, spread_hash

REASON = "rejection_reason"
REQUIRED_FIELDS = ("review_id", "rating")


@dataclass(frozen=True)
class Rule:
    """A reject reason: when it applies, what to say, and the column it needs (if any)."""

    reason: str
    applies: Callable[[], Column]
    details: Callable[[], Column]
    needs: str | None = None


def _missing_fields() -> Column:
    names = [F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED_FIELDS]
    return F.concat(F.lit("Missing required fields: "), F.concat_ws(", ", *names))


DUPLICATE = Rule(
    "duplicate_review_id", lambda: ~F.col("is_first"), lambda: F.lit("Duplicate review_id found")
)
MISSING = Rule(
    "missing_required_fields",
    lambda: F.col("review_id").isNull() | F.col("rating").isNull(),
    _missing_fields,
)
RATING = Rule(
    "invalid_rating",
    lambda: ~F.col("rating").between(1, 5),
    lambda: F.concat(F.lit("Invalid rating: "), F.col("rating").cast("string")),
)
DESCRIPTION = Rule(
    "empty_description", lambda: is_blank("description"), lambda: F.lit("Description is empty or null")
)
BUYER = Rule(
    "missing_buyer_id", lambda: F.col("buyer_id").isNull(), lambda: F.lit("Buyer ID is null"), needs="buyer_id"
)

FULL_RULES = (DUPLICATE, MISSING, RATING, DESCRIPTION)
LIGHT_RULES = (DUPLICATE, MISSING, RATING, BUYER)


def keep_order(columns: Sequence[str]) -> list[Column]:
    """Which copy of a review is kept: lowest p_id, nulls first, then the other columns."""
    ranked = ["p_id", "buyer_id", "rating", "title", "description"]
    return [F.col(c).asc_nulls_first() for c in ranked if c in columns]


def apply_rules(df: DataFrame, rules: tuple[Rule, ...] = FULL_RULES) -> DataFrame:
    """Reason and details of rows of which ``is_first`` says whether they are the kept copy."""
    active = [r for r in rules if r.needs is None or r.needs in df.columns]
    reason = details = None
    for rule in reversed(active):
        hit = F.coalesce(rule.applies(), F.lit(False))
        reason = F.when(hit, F.lit(rule.reason)).otherwise(F.lit(None) if reason is None else reason)
        details = F.when(hit, rule.details()).otherwise(F.lit(None) if details is None else details)
    return df.select("*", reason.alias(REASON), details.alias("error_details")).drop("is_first")


def flag_rejects(
    df: DataFrame, rules: tuple[Rule, ...] = FULL_RULES, hot_rows: int | None = None, hot: HotKeys | None = None
) -> DataFrame:
    """Add ``rejection_reason`` (null for a clean row) and ``error_details`` to any review DataFrame.

    ``hot``: hot review ids where they are known; otherwise they are counted over ``df``.
    """
    return apply_rules(mark_first(df, "review_id", keep_order(df.columns), hot_rows, hot=hot), rules)


def join_and_flag(
    tables: Mapping[str, DataFrame],
    product_id: str | None = None,
    rules: tuple[Rule, ...] = FULL_RULES,
    hot_rows: int | None = None,
) -> DataFrame:
    """Join and flag as one plan: the duplicate check reuses the partitioning of the join.

    A review id of one review has its first row from its links alone (which differ in nothing but the product); only ids of several
    reviews are put in order with their texts.
    """
    order = keep_order(JOINED_COLUMNS)
    parts, hot, keys = join_parts(tables, product_id, hot_rows, keep_order(["p_id"]))
    marked = [part if "is_first" in part.columns else first_of_regular(part, "review_id", order) for part in parts]
    if hot is not None:
        marked.append(first_of_hot(hot, order, keys, spread_hash("p_id", "buyer_id", "title", "description")))
    return apply_rules(reduce(DataFrame.unionByName, marked), rules)


def fill_defaults(df: DataFrame) -> DataFrame:
    """Defaults of clean rows; a missing image stays null."""
    return df.fillna({"title": "", "description": "", "category": "Unknown", "text_length": 0}).withColumns(
        {
            "text_length": F.col("text_length").cast("int"),
            "has_image": F.coalesce(F.col("has_image"), F.lit(0)).cast("boolean"),
            "has_orders": F.coalesce(F.col("has_orders"), F.lit(0)).cast("boolean"),
        }
    )


def clean_rows(flagged: DataFrame, fill: bool = True) -> DataFrame:
    rows = flagged.where(F.col(REASON).isNull()).drop(REASON, "error_details")
    return fill_defaults(rows) if fill else rows


def rejected_rows(flagged: DataFrame, rejected_at: Column | None = None) -> DataFrame:
    """Reject records: id, reason, time, the whole row as a struct, and a message."""
    data = [c for c in flagged.columns if c not in (REASON, "error_details")]
    at = F.current_timestamp() if rejected_at is None else rejected_at
    review_id = F.col("review_id") if "review_id" in data else F.lit("UNKNOWN")
    return flagged.where(F.col(REASON).isNotNull()).select(
        review_id.alias("review_id"),
        REASON,
        F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("rejected_at"),
        F.struct(*data).alias("original_data"),
        "error_details",
    )


def clean_and_validate(
    df: DataFrame, rules: tuple[Rule, ...] = FULL_RULES, hot_rows: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected) of any review DataFrame; the full rules also fill defaults."""
    flagged = flag_rejects(df, rules, hot_rows)
    return clean_rows(flagged, fill=rules is FULL_RULES), rejected_rows(flagged)
