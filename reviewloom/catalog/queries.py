"""Every job as a named query over the given tables, with its reference SQL.

A query takes (spark, folder). Where a result is compared, floating values are
rounded on both sides and nullable integers are given as text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import PIPELINE_VERSION
from ..functions import scalar, scoring, sentiment
from ..operators import classify, clean, distribution, joins, kpi, quality, serve, shop, skew, topics
from ..plans import jobs
from ..plans.warehouse import INGESTED_AT, Warehouse, warehouse
from ..schemas import COLUMNS, REVIEW_RELEVANT_COLUMNS, schema_of
from ..session import scratch_path, stored
from ..sources import extract, readers, snapshots, writers
from ..sources.driver_tables import CORPUS_KEYWORDS, CORPUS_LEXICON, DEAL_DAY
from .views import KEEP_ORDER, keyword_counts, sentiment_views, with_views

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None, plain: bool = False):
    """Register a builder taking the warehouse of a folder; ``plain``: the SQL is that of another query, with its views."""

    def add(build: Callable[[Warehouse], DataFrame]):
        REGISTRY[name] = Entry(
            lambda spark, folder: build(warehouse(spark, folder)), sql if plain or not sql else with_views(sql, extra)
        )
        return build

    return add


def _texts(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def _ints(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in columns})


# --- joins -----------------------------------------------------------------------
_JOINED = """SELECT buyer_id, CAST(review_id AS VARCHAR) AS review_id, title, description, CAST(rating AS VARCHAR) AS rating,
    review_img, CAST(text_length AS VARCHAR) AS text_length, has_image, has_orders, p_id, product_name, category FROM f_joined"""
_NULLABLE = ("review_id", "rating", "text_length")


@query("review_join", _JOINED)
def _(w):
    return _texts(joins.join_reviews(w.sources), *_NULLABLE)


@query("review_join_product", _JOINED + " WHERE linked_p_id = '11'")
def _(w):
    return _texts(joins.join_reviews(w.sources, product_id="11"), *_NULLABLE)


@query("review_join_hot_keys", _JOINED)
def _(w):
    # Same result with the hot-key path taken by most keys.
    return _texts(joins.join_reviews(w.sources, hot_rows=2), *_NULLABLE)


@query("first_image", "SELECT review_id, review_img FROM f_first_image")
def _(w):
    return joins.first_image(w.sources["review_images"])


@query("orders_per_buyer", "SELECT buyer_id, count(*) AS order_count FROM f_orders GROUP BY buyer_id")
def _(w):
    return joins.orders_per_buyer(w.sources["orders"])


# Links and ratings are counted apart; names and categories are looked up for the twenty that remain.
_TOP = """SELECT p_id, goods.p_name, goods.price, kind.name AS category, nb_reviews, avg_rating FROM (
        SELECT links.p_id, CAST(sum(told.n) AS BIGINT) AS nb_reviews, round(sum(told.stars) / sum(told.rated), 2) AS avg_rating
        FROM f_product_reviews links
        JOIN (SELECT review_id, count(*) AS n, sum(rating) AS stars, count(rating) AS rated FROM f_review GROUP BY review_id) told USING (review_id)
        WHERE links.p_id IN (SELECT p_id FROM f_product) GROUP BY links.p_id HAVING sum(told.n) >= 15) most
    JOIN f_product goods USING (p_id) LEFT JOIN f_category kind USING (category_id)
    QUALIFY row_number() OVER (ORDER BY nb_reviews DESC, p_id) <= 20"""
_SAMPLE = """SELECT DISTINCT review_id, told.buyer_id, told.title, told.r_desc AS description, told.rating, length(told.r_desc) AS text_length,
        CAST(review_id IN (SELECT review_id FROM f_review_images) AS INT) AS has_image,
        CAST(coalesce(told.buyer_id IN (SELECT buyer_id FROM f_orders), false) AS INT) AS has_orders, p_id, best.p_name AS product_name, best.category
    FROM (SELECT *, row_number() OVER (ORDER BY nb_reviews DESC, p_id) AS place FROM f_top) best
    JOIN f_product_reviews USING (p_id) JOIN f_review told USING (review_id) WHERE place <= 10"""
_SAMPLE_VIEWS = {"f_top": _TOP, "f_sample": _SAMPLE}


@query("top_products", _TOP)
def _(w):
    return joins.top_products(w.sources)


@query(
    "review_sample",
    "SELECT review_id, buyer_id, title, description, CAST(rating AS VARCHAR) AS rating, CAST(text_length AS VARCHAR) AS text_length, "
    "has_image, has_orders, p_id, product_name, category FROM f_sample",
    _SAMPLE_VIEWS,
)
def _(w):
    return _texts(joins.review_sample(w.sources), "rating", "text_length")


@query(
    "review_sample_unique",
    f"SELECT review_id, p_id, title FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY {KEEP_ORDER}) AS rn FROM f_sample) q WHERE rn = 1",
    _SAMPLE_VIEWS,
)
def _(w):
    sample = joins.review_sample(w.sources)
    known = w.sources.profiles.hot("review", "review_id")
    marked = skew.mark_first(sample, "review_id", clean.keep_order(sample.columns), hot=known)
    return marked.where("is_first").select("review_id", "p_id", "title")


# --- cleaning ----------------------------------------------------------------------
@query(
    "clean_reviews",
    "SELECT review_id, buyer_id, p_id, product_name, category, title, description, rating, text_length, has_image, has_orders, review_img FROM f_clean",
)
def _(w):
    return _ints(clean.clean_rows(clean.join_and_flag(w.sources)), "has_image", "has_orders")


@query(
    "rejected_reviews",
    """SELECT CAST(review_id AS VARCHAR) AS review_id, rejection_reason, buyer_id, p_id, description,
    CASE rejection_reason WHEN 'duplicate_review_id' THEN 'Duplicate review_id found'
      WHEN 'missing_required_fields' THEN 'Missing required fields: ' || concat_ws(', ', CASE WHEN review_id IS NULL THEN 'review_id' END, CASE WHEN rating IS NULL THEN 'rating' END)
      WHEN 'invalid_rating' THEN 'Invalid rating: ' || CAST(rating AS VARCHAR) ELSE 'Description is empty or null' END AS error_details
    FROM f_flagged WHERE rejection_reason IS NOT NULL""",
)
def _(w):
    records = clean.rejected_rows(clean.join_and_flag(w.sources))
    return records.select(
        F.col("review_id").cast("string").alias("review_id"), "rejection_reason",
        *[F.col(f"original_data.{c}").alias(c) for c in ("buyer_id", "p_id", "description")], "error_details",
    )


@query("flagged_hot_keys", "SELECT rejection_reason, count(*) AS nb_reviews, count(DISTINCT p_id) AS products FROM f_flagged GROUP BY rejection_reason")
def _(w):
    flagged = clean.join_and_flag(w.sources, hot_rows=2)
    return flagged.groupBy("rejection_reason").agg(
        scalar.n_rows().alias("nb_reviews"), F.count_distinct("p_id").alias("products")
    )


@query(
    "clean_reviews_light",
    """SELECT CAST(review_id AS VARCHAR) AS review_id, p_id, CASE WHEN rn > 1 THEN 'duplicate_review_id'
    WHEN review_id IS NULL OR rating IS NULL THEN 'missing_required_fields' WHEN rating < 1 OR rating > 5 THEN 'invalid_rating'
    WHEN buyer_id IS NULL THEN 'missing_buyer_id' END AS rejection_reason FROM f_ranked""",
)
def _(w):
    flagged = clean.join_and_flag(w.sources, rules=clean.LIGHT_RULES)
    return _texts(flagged, "review_id").select("review_id", "p_id", "rejection_reason")


@query("reject_reasons", "SELECT rejection_reason, count(*) AS nb_reviews FROM f_flagged WHERE rejection_reason IS NOT NULL GROUP BY ALL")
def _(w):
    return quality.reject_reasons(w.rejected)


@query(
    "reason_vocabulary",
    "SELECT rejection_reason, count(*) AS nb_reviews, rejection_reason <> 'empty_description' AS declared, true AS known "
    "FROM f_flagged WHERE rejection_reason IS NOT NULL GROUP BY rejection_reason",
)
def _(w):
    return quality.reason_vocabulary(w.rejected)


# --- source quality ------------------------------------------------------------------
# One row per review id with its number of copies and of rows with each problem; then sums over the ids.
_MOTIVES_VIEW = {
    "f_told": """SELECT review_id, count(*) AS copies, sum(CAST(rating IS NULL AS INT)) AS no_stars,
        sum(CAST(coalesce(rating NOT BETWEEN 1 AND 5, false) AS INT)) AS odd_stars, sum(CAST(buyer_id IS NULL AS INT)) AS no_buyer,
        sum(CAST(coalesce(trim(r_desc), '') = '' AS INT)) AS no_text FROM f_review GROUP BY review_id""",
    "f_motives": """SELECT CAST(sum(copies) AS BIGINT) AS total_reviews, count(*) FILTER (copies > 1) AS duplicates,
        CAST(sum(no_stars) AS BIGINT) AS null_ratings, CAST(sum(odd_stars) AS BIGINT) AS invalid_ratings,
        CAST(sum(no_buyer) AS BIGINT) AS null_buyers, CAST(sum(no_text) AS BIGINT) AS empty_descriptions,
        count(*) FILTER (review_id IS NOT NULL AND (copies > 1 OR no_stars + odd_stars + no_buyer + no_text > 0)) AS rejected_reviews FROM f_told""",
}


@query(
    "dq_statistics",
    "SELECT total_reviews, total_reviews - rejected_reviews AS clean_reviews, rejected_reviews, round(rejected_reviews * 100.0E0 / total_reviews, 6) AS rejection_rate, "
    "duplicates, null_ratings, invalid_ratings, null_buyers, empty_descriptions FROM f_motives",
    _MOTIVES_VIEW,
)
def _(w):
    return _rounded(quality.rejection_statistics(w.sources["review"]), rejection_rate=6)


@query(
    "dq_report",
    """SELECT motive, nb_reviews, round(nb_reviews * 100.0E0 / total_reviews, 6) AS percentage FROM (
    SELECT 'Doublons' AS motive, duplicates AS nb_reviews, total_reviews FROM f_motives
    UNION ALL SELECT 'Rating NULL', null_ratings, total_reviews FROM f_motives
    UNION ALL SELECT 'Rating invalide', invalid_ratings, total_reviews FROM f_motives
    UNION ALL SELECT 'Buyer ID NULL', null_buyers, total_reviews FROM f_motives
    UNION ALL SELECT 'Description vide', empty_descriptions, total_reviews FROM f_motives) q WHERE nb_reviews > 0""",
    _MOTIVES_VIEW,
)
def _(w):
    return _rounded(quality.rejection_report(w.sources["review"]), percentage=6)


@query("dup_count", "SELECT count(*) AS duplicates FROM (SELECT review_id FROM f_review GROUP BY review_id HAVING count(*) > 1) q")
def _(w):
    return quality.duplicate_count(w.sources["review"])


@query(
    "not_null",
    " UNION ALL ".join(
        f"SELECT '{c}_not_null' AS name, count(*) FILTER ({c} IS NULL) = 0 AS passed, count(*) FILTER ({c} IS NULL) AS failed, count(*) AS checked FROM f_review"
        for c in ("review_id", "rating", "buyer_id")
    ),
)
def _(w):
    return quality.expect_not_null(w.sources["review"], ["review_id", "rating", "buyer_id"])


@query(
    "joined_not_null",
    " UNION ALL ".join(
        f"SELECT '{c}_not_null' AS name, count(*) FILTER ({c} IS NULL) = 0 AS passed, count(*) FILTER ({c} IS NULL) AS failed, count(*) AS checked FROM f_joined"
        for c in ("p_id", "review_id")
    ),
)
def _(w):
    return quality.joined_checks(joins.join_reviews(w.sources))


def _ref_sql(child, column, parent, parent_column, name):
    return f"""SELECT '{name}' AS name, count(*) FILTER (k NOT IN (SELECT {parent_column} FROM {parent} WHERE {parent_column} IS NOT NULL)) AS failed,
        count(*) AS checked FROM (SELECT DISTINCT {column} AS k FROM {child} WHERE {column} IS NOT NULL) q"""


_REPORT_SQL = " UNION ALL ".join(
    [
        "SELECT 'product_not_empty' AS name, CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS failed, least(count(*), 1) AS checked FROM f_product",
        "SELECT 'rating_range', count(*) FILTER (rating < 1 OR rating > 5), count(*) FROM f_review",
        "SELECT 'review_id_unique', CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT), CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM f_review GROUP BY review_id) q",
        *[f"SELECT '{c}_not_null', count(*) FILTER ({c} IS NULL), count(*) FROM f_review" for c in ("review_id", "rating", "buyer_id")],
        "SELECT 'price_positive', count(*) FILTER (price < 0), count(*) FROM f_product",
        r"SELECT 'review_text_not_empty', count(*) FILTER (r_desc IS NULL OR regexp_full_match(r_desc, '[\s\p{Z}]*')), count(*) FROM f_review",
        "SELECT 'review_id_type', 0, 1",
        _ref_sql("f_product_reviews", "p_id", "f_product", "p_id", "product_references"),
        _ref_sql("f_review", "buyer_id", "f_buyer", "buyer_id", "buyer_references"),
        _ref_sql("f_product", "category_id", "f_category", "category_id", "category_references"),
    ]
)
_REPORT_SQL = (
    "SELECT name, CASE WHEN name = 'review_text_not_empty' THEN failed * 100.0 / checked < 10 ELSE failed = 0 END AS passed, failed, checked "
    f"FROM ({_REPORT_SQL}) r"
)


@query("quality_report", _REPORT_SQL)
def _(w):
    return quality.quality_report(w.sources)


@query(
    "quality_summary",
    "SELECT count(*) AS total_tests, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed, "
    "round(count(*) FILTER (passed) * 100.0E0 / count(*), 1) AS success_rate FROM f_report",
    {"f_report": _REPORT_SQL},
)
def _(w):
    return quality.report_summary(quality.quality_report(w.sources))


@query(
    "product_references",
    """SELECT count(*) AS keys, count(*) FILTER (bad) AS orphan_keys, CAST(coalesce(sum(n) FILTER (bad), 0) AS BIGINT) AS orphan_rows,
    round((1 - count(*) FILTER (bad) / count(*)) * 100, 6) AS valid_pct FROM (
    SELECT p_id NOT IN (SELECT p_id FROM f_product) AS bad, n FROM (SELECT p_id, count(*) AS n FROM f_product_reviews GROUP BY p_id) a) q""",
)
def _(w):
    found = quality.references(w.sources["product_reviews"], "p_id", w.sources["product"], "p_id")
    return _rounded(found, valid_pct=6)


@query(
    "stored_review_checks",
    " UNION ALL ".join(
        [
            *[
                f"SELECT '{c}_not_null' AS name, count(*) FILTER ({c} IS NULL) = 0 AS passed, count(*) FILTER ({c} IS NULL) AS failed, count(*) AS checked FROM f_clean"
                for c in ("review_id", "rating")
            ],
            "SELECT 'ingestion_timestamp_not_null', true, 0, count(*) FROM f_clean",
            "SELECT 'rating_range', count(*) FILTER (rating NOT BETWEEN 1 AND 5) = 0, count(*) FILTER (rating NOT BETWEEN 1 AND 5), count(*) FROM f_clean",
            "SELECT 'rating_type', true, 0, 1",
        ]
    ),
)
def _(w):
    return quality.stored_review_checks(w.reviews)


def _fk_sql() -> str:
    from ..schemas import FOREIGN_KEYS

    given = _given()
    parts = []
    for k in FOREIGN_KEYS:
        if k.table in given and k.parent in given and k.column in given[k.table] and k.parent_column in given[k.parent]:
            parts.append(
                f"""SELECT '{k.name}' AS foreign_key, count(*) AS keys, count(*) FILTER (bad) AS orphan_keys,
                CAST(coalesce(sum(n) FILTER (bad), 0) AS BIGINT) AS orphan_rows FROM (SELECT n, NOT EXISTS (
                SELECT 1 FROM f_{k.parent} p WHERE CAST(p.{k.parent_column} AS VARCHAR) = c.k) AS bad FROM (
                SELECT CAST({k.column} AS VARCHAR) AS k, count(*) AS n FROM f_{k.table} WHERE {k.column} IS NOT NULL GROUP BY ALL) c) q"""
            )
    return " UNION ALL ".join(parts)


def _given() -> dict[str, tuple[str, ...]]:
    """Columns of the derived source tables: all those declared but one, which nothing here holds."""
    left_out = {"shipment": ("actual_delivery_date",)}
    names = {t: [c.split()[0] for c in text.split(",")] for t, text in COLUMNS.items()}
    return {t: tuple(c for c in columns if c not in left_out.get(t, ())) for t, columns in names.items()}


@query("fk_orphans", _fk_sql())
def _(w):
    return quality.foreign_key_orphans(w.sources)


def _pk_sql() -> str:
    from ..schemas import PRIMARY_KEYS, UNIQUE_KEYS

    parts = []
    for table, columns in _given().items():
        for kind, keys in [("primary", PRIMARY_KEYS[table])] + [("unique", k) for k in UNIQUE_KEYS.get(table, ())]:
            if set(keys) <= set(columns):
                null = " OR ".join(f"{c} IS NULL" for c in keys)
                nulls = f"CAST(coalesce(sum(n) FILTER ({null}), 0) AS BIGINT)" if kind == "primary" else "0"
                parts.append(
                    f"SELECT '{table}' AS table_name, '{kind}' AS kind, '{','.join(keys)}' AS columns, "
                    f"count(*) FILTER (n > 1 AND NOT ({null})) AS repeated_keys, {nulls} AS null_rows "
                    f"FROM (SELECT {', '.join(keys)}, count(*) AS n FROM f_{table} GROUP BY ALL) q"
                )
    return " UNION ALL ".join(parts)


@query("pk_violations", _pk_sql())
def _(w):
    return quality.key_violations(w.sources)


def _rules_sql(rules) -> str:
    """rules: (table, rule name, violation predicate)."""
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{n}' AS rule, count(*) FILTER ({bad}) AS violations FROM f_{t}" for t, n, bad in rules
    )


def _rule_lists():
    from ..schemas import CHECKS, REQUIRED, TEXT_LIMITS

    given = _given()
    checks = [(t, n, f"NOT ({p})") for t, n, p in CHECKS if n in given.get(t, ())]
    required = [(t, c, f"{c} IS NULL") for t, cs in REQUIRED.items() for c in cs if c in given.get(t, ())]
    lengths = [
        (t, f"{c}({n})", f"length(CAST({c} AS VARCHAR)) > {n}")
        for t, cs in TEXT_LIMITS.items() for c, n in cs.items() if c in given.get(t, ())
    ]
    return checks, required, lengths


_CHECK_RULES, _REQUIRED_RULES, _LENGTH_RULES = _rule_lists()


@query("check_violations", _rules_sql(_CHECK_RULES))
def _(w):
    return quality.check_violations(w.sources)


@query("required_violations", _rules_sql(_REQUIRED_RULES))
def _(w):
    return quality.required_violations(w.sources)


@query("length_violations", _rules_sql(_LENGTH_RULES))
def _(w):
    return quality.length_violations(w.sources)


# --- exploration and views -----------------------------------------------------------
@query(
    "rating_dist",
    "SELECT rating, count(*) AS nb_reviews, round(count(*) * 100.0E0 / (SELECT count(*) FROM f_review WHERE rating IS NOT NULL), 6) AS percentage "
    "FROM f_review WHERE rating IS NOT NULL GROUP BY rating",
)
def _(w):
    return _rounded(kpi.rating_distribution(w.sources["review"]), percentage=6)


@query(
    "dataset_summary",
    """SELECT count(*) AS total_reviews, CAST(sum(has_image) AS BIGINT) AS with_images, round(avg(has_image) * 100, 6) AS pct_images,
    CAST(sum(has_orders) AS BIGINT) AS with_orders, round(avg(has_orders) * 100, 6) AS pct_orders, round(avg(text_length), 6) AS avg_length,
    CAST(median(text_length) AS DOUBLE) AS median_length, min(text_length) AS min_length, max(text_length) AS max_length,
    round(avg(rating), 6) AS avg_rating FROM f_clean""",
)
def _(w):
    found = kpi.dataset_summary(w.reviews)
    return _rounded(found, pct_images=6, pct_orders=6, avg_length=6, avg_rating=6)


@query("len_by_rating", "SELECT rating, round(avg(text_length), 6) AS avg_length FROM f_clean GROUP BY rating")
def _(w):
    return _rounded(kpi.length_by_rating(w.reviews), avg_length=6)


@query("img_by_rating", "SELECT rating, round(avg(has_image) * 100, 6) AS pct_images FROM f_clean GROUP BY rating")
def _(w):
    return _rounded(kpi.images_by_rating(w.reviews), pct_images=6)


@query("orders_flag_counts", "SELECT count(*) FILTER (has_orders = 1) AS with_orders, count(*) FILTER (has_orders = 0) AS without_orders FROM f_clean")
def _(w):
    return kpi.orders_flag_counts(w.reviews)


@query(
    "view_by_product",
    f"""SELECT p_id, product_name, count(*) AS total_reviews, round(avg(rating), 6) AS avg_rating, CAST(sum(has_image) AS BIGINT) AS reviews_with_images,
    '{INGESTED_AT}' AS first_review, '{INGESTED_AT}' AS last_review FROM f_clean GROUP BY p_id, product_name""",
)
def _(w):
    found = _rounded(kpi.reviews_by_product(w.reviews), avg_rating=6)
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_review", "last_review")})


@query("view_by_category", "SELECT category, count(*) AS total_reviews, round(avg(rating), 6) AS avg_rating, count(DISTINCT p_id) AS unique_products FROM f_clean GROUP BY category")
def _(w):
    return _rounded(kpi.reviews_by_category(w.reviews), avg_rating=6)


@query(
    "view_quality",
    """SELECT count(*) AS total_reviews, count(DISTINCT review_id) AS unique_reviews, count(DISTINCT buyer_id) AS unique_buyers,
    count(DISTINCT p_id) AS unique_products, round(avg(rating), 6) AS avg_rating, round(sum(has_image) * 100.0E0 / count(*), 6) AS pct_with_images,
    count(*) FILTER (description IS NULL OR description = '') AS empty_descriptions FROM f_clean""",
)
def _(w):
    return _rounded(kpi.data_quality_view(w.reviews), avg_rating=6, pct_with_images=6)


# --- scoring ------------------------------------------------------------------------
@query("anonymize", "SELECT CAST(review_id AS VARCHAR) AS review_id, sha256('default_salt' || buyer_id) AS buyer_id FROM f_review")
def _(w):
    return _texts(extract.anonymise_buyers(w.sources["review"]).select("review_id", "buyer_id"), "review_id")


@query(
    "anonymize_null_as_text",
    "SELECT CAST(review_id AS VARCHAR) AS review_id, sha256('default_salt' || coalesce(buyer_id, 'None')) AS buyer_id FROM f_review",
)
def _(w):
    hashed = extract.anonymise_buyers(w.sources["review"], null_as_text=True)
    return _texts(hashed.select("review_id", "buyer_id"), "review_id")


@query("sentiment", "SELECT doc_id, compound FROM f_doc_sentiment", sentiment_views("f_doc_sentiment", "documents", "doc_id", "text"))
def _(w):
    docs = w.base["documents"].select("doc_id", "text")
    return docs.select("doc_id", sentiment.compound("text", CORPUS_LEXICON).alias("compound"))


@query(
    "sentiment_default_lexicon",
    "SELECT doc_id, compound FROM f_doc_sentiment",
    sentiment_views("f_doc_sentiment", "documents", "doc_id", "text", sentiment.DEFAULT_LEXICON),
)
def _(w):
    docs = w.base["documents"].select("doc_id", "text")
    return docs.select("doc_id", sentiment.compound("text").alias("compound"))


@query(
    "fitted_valences",
    r"""SELECT * FROM (WITH told AS (SELECT CASE WHEN rating >= 4 THEN 1 WHEN rating <= 2 THEN 0 END AS kind, description FROM f_clean WHERE description IS NOT NULL),
    kinds AS (SELECT count(*) FILTER (kind = 1) AS p, count(*) FILTER (kind = 0) AS n FROM told),
    used AS (SELECT kind, unnest(list_distinct(regexp_extract_all(lower(description), '[\p{L}'']+'))) AS word FROM told WHERE kind IS NOT NULL),
    counted AS (SELECT word, count(*) FILTER (kind = 1) AS a, count(*) FILTER (kind = 0) AS b FROM used GROUP BY word HAVING count(*) >= 5 AND length(word) > 1)
    SELECT word, a AS n_positive, b AS n_negative, round(greatest(-4.0E0, least(4.0E0, 2.0E0 * (
        ln((a + 10.0E0 * (a + b) / (p + n)) / (p + 10.0E0)) - ln((b + 10.0E0 * (a + b) / (p + n)) / (n + 10.0E0))))), 6) AS valence FROM counted, kinds) q""",
)
def _(w):
    return _rounded(sentiment.fitted_valences(w.reviews), valence=6)


_SCORES = ("text_length_score", "keyword_score", "relevance_score")


@query(
    "scores",
    "SELECT review_id, round(text_length_score, 6) AS text_length_score, is_extreme_rating, round(keyword_score, 6) AS keyword_score, "
    "round(relevance_score, 6) AS relevance_score FROM f_scored",
)
def _(w):
    scored = scoring.add_scores(w.reviews, CORPUS_LEXICON)
    return _rounded(scored, **{c: 6 for c in _SCORES}).select("review_id", "is_extreme_rating", *_SCORES)


@query(
    "prototype_classes",
    """SELECT CASE WHEN 100 * (0.25E0 * text_length_score + 0.20E0 * has_image + 0.15E0 * has_orders + 0.15E0 * is_extreme_rating + 0.25E0 * keyword_score) >= 50
    THEN 'Relevant' ELSE 'Irrelevant' END AS label, count(*) AS nb_reviews FROM f_scored GROUP BY 1""",
)
def _(w):
    scored = scoring.add_scores(w.reviews, CORPUS_LEXICON, scoring.PROTOTYPE_TEST_WEIGHTS)
    return kpi.class_counts(scored.withColumn("label", scoring.class_label(50.0)), "label")


@query(
    "class_labels",
    "SELECT CASE WHEN relevance_score >= 80 THEN 'Relevant' ELSE 'Irrelevant' END AS label, count(*) AS nb_reviews FROM f_scored GROUP BY 1",
)
def _(w):
    return kpi.class_counts(w.review_relevant.withColumn("label", scoring.class_label()), "label")


_RELEVANT_SQL = """SELECT review_id, buyer_id, p_id, product_name, category, title, description, rating, text_length, has_image, has_orders,
    round(text_length_score, 6) AS text_length_score, is_extreme_rating, round(keyword_score, 6) AS keyword_score, round(relevance_score, 6) AS relevance_score,
    category_review, confidence_score, review_img, CASE WHEN confidence_score >= 78.3 AND relevance_score >= 58.8 THEN 'RELEVANT' ELSE 'IRRELEVANT' END AS relevant_status
    FROM f_scored"""


@query("relevant_status", _RELEVANT_SQL)
def _(w):
    scored = jobs.score_reviews(w.reviews, w.classes, CORPUS_LEXICON)
    relevant = _rounded(writers.as_review_relevant(scored), **{c: 6 for c in _SCORES})
    return _ints(relevant, "has_image", "has_orders", "is_extreme_rating")


@query("topic_counts", "SELECT category_review, count(*) AS nb_reviews FROM f_scored GROUP BY category_review")
def _(w):
    return kpi.class_counts(w.review_relevant, "category_review")


@query("mean_confidence", "SELECT round(avg(confidence_score), 6) AS avg_confidence FROM f_scored")
def _(w):
    return _rounded(kpi.mean_confidence(w.review_relevant), avg_confidence=6)


_HITS = keyword_counts("text")
_TOPIC_CASE = " ".join(f"WHEN h{i + 1} = best THEN '{t}'" for i, t in enumerate(CORPUS_KEYWORDS))


@query(
    "classify",
    f"""SELECT doc_id, CASE WHEN blank THEN NULL {_TOPIC_CASE} END AS category_review,
    round(CASE WHEN blank THEN 0.0E0 WHEN h1 + h2 + h3 + h4 = 0 THEN 0.25E0 ELSE best / (h1 + h2 + h3 + h4) END, 6) AS confidence_score
    FROM (SELECT *, greatest(h1, h2, h3, h4) AS best FROM (SELECT doc_id, text IS NULL OR regexp_full_match(text, '[\\s\\p{{Z}}]*') AS blank,
    {", ".join(f"{h} AS h{i + 1}" for i, h in enumerate(_HITS))} FROM documents) a) b""",
)
def _(w):
    docs = w.base["documents"].select("doc_id", "text")
    found = classify.classify_by_keywords(docs, "text", CORPUS_KEYWORDS)
    return _rounded(found, confidence_score=6).drop("text")


def _learned_sql() -> str:
    """One round: seeds, centroids, posterior."""
    k = range(len(CORPUS_KEYWORDS))
    each = lambda text: ", ".join(text.replace("#", str(t)) for t in k)
    seeds = ", ".join(f"sum(n) FILTER (word IN ({', '.join(repr(x) for x in words)})) AS h{t}" for t, words in zip(k, CORPUS_KEYWORDS.values()))
    hits = " + ".join(f"coalesce(h{t}, 0)" for t in k)
    total = " + ".join(f"e{t}" for t in k)
    topic = " ".join(f"WHEN e{t} = top THEN '{name}'" for t, name in zip(k, CORPUS_KEYWORDS))
    return rf"""SELECT * FROM (WITH used AS (
        SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM documents) w GROUP BY ALL),
    vocab AS (SELECT word, ln((SELECT count(DISTINCT doc_id) FROM used) / count(*)) AS idf FROM used GROUP BY word HAVING count(*) >= 5),
    weighed AS (SELECT doc_id, word, n * idf AS v FROM used JOIN vocab USING (word) WHERE n * idf > 0),
    vec AS (SELECT doc_id, word, v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)) AS v FROM weighed),
    hit AS (SELECT doc_id, {seeds} FROM used GROUP BY doc_id),
    share AS (SELECT doc_id, {each(f"CASE WHEN {hits} > 0 THEN coalesce(h#, 0) / ({hits}) ELSE 0.25E0 END AS s#")} FROM hit),
    sums AS (SELECT word, {each("sum(v * s#) AS c#")} FROM vec JOIN share USING (doc_id) GROUP BY word),
    size AS (SELECT {each("sqrt(sum(c# * c#)) AS l#")} FROM sums),
    prior AS (SELECT {each("sum(s#) / count(*) AS w#")} FROM share),
    cosine AS (SELECT doc_id, {each("sum(v * c# / l#) AS x#")} FROM vec JOIN sums USING (word) CROSS JOIN size GROUP BY doc_id),
    power AS (SELECT doc_id, {each("exp(12.0E0 * coalesce(x#, 0) + ln(w#)) AS e#")} FROM share LEFT JOIN cosine USING (doc_id) CROSS JOIN prior)
    SELECT d.doc_id, CASE {topic} END AS category_review, round(coalesce(top / ({total}), 0), 6) AS confidence_score
    FROM documents d LEFT JOIN (SELECT *, greatest({each("e#")}) AS top FROM power) p USING (doc_id)) q"""


@query("learned_topics", _learned_sql())
def _(w):
    docs = w.base["documents"].select("doc_id", "text")
    found = topics.learn(docs, "doc_id", "text", CORPUS_KEYWORDS, rounds=1)
    return _rounded(topics.assign(docs, "doc_id", "text", found), confidence_score=6)


def _sweep_sql() -> str:
    parts = [
        f"""SELECT '{n}' AS strategy, round(tc, 6) AS confidence_threshold, round(tr, 6) AS relevance_threshold,
        count(*) FILTER (confidence_score >= tc AND relevance_score >= tr) AS kept,
        round(count(*) FILTER (confidence_score >= tc AND relevance_score >= tr) * 100.0E0 / count(*), 6) AS kept_pct,
        count(*) - count(*) FILTER (confidence_score >= tc AND relevance_score >= tr) AS dropped
        FROM f_scored, (SELECT quantile_cont(confidence_score, {c}) AS tc, quantile_cont(relevance_score, {r}) AS tr FROM f_scored) t GROUP BY tc, tr"""
        for n, c, r in distribution.STRATEGIES
    ]
    return " UNION ALL ".join(parts)


@query("threshold_sweep", _sweep_sql())
def _(w):
    found = distribution.threshold_sweep(w.review_relevant)
    return _rounded(found, confidence_threshold=6, relevance_threshold=6, kept_pct=6)


_PROBABILITIES = (0.0, 0.1, 0.25, 0.5, 0.55, 0.75, 0.9, 0.99, 1.0)


@query(
    "score_quantiles",
    " UNION ALL ".join(f"SELECT {p}E0 AS p, round(quantile_cont(relevance_score, {p}), 6) AS value FROM f_scored" for p in _PROBABILITIES),
)
def _(w):
    return _rounded(distribution.exact_quantiles(w.review_relevant, "relevance_score", _PROBABILITIES), value=6)


def _histogram_sql(column: str, bins: int) -> str:
    return f"""SELECT CAST(b.bin AS INT) AS bin, round(lo + b.bin * w, 6) AS low, round(lo + (b.bin + 1) * w, 6) AS high, count(v) AS n FROM (
        SELECT min({column})::DOUBLE AS lo, (max({column})::DOUBLE - min({column})::DOUBLE) / {bins} AS w FROM f_scored) s
        CROSS JOIN range({bins}) b(bin) LEFT JOIN (SELECT {column}::DOUBLE AS v FROM f_scored) x
        ON least(floor((v - lo) / w), {bins - 1}) = b.bin GROUP BY b.bin, lo, w"""


# Nearly all values of this column lie within a billionth of its range.
_FAR = "CASE WHEN review_id % 200 = 1 THEN 1e12 * rating ELSE relevance_score END"


@query(
    "outlier_quantiles",
    " UNION ALL ".join(f"SELECT {p}E0 AS p, round(quantile_cont(x, {p}), 6) AS value FROM (SELECT {_FAR} AS x FROM f_scored) q" for p in _PROBABILITIES),
)
def _(w):
    far = w.review_relevant.select(F.expr(_FAR).alias("x"))
    return _rounded(distribution.exact_quantiles(far, "x", _PROBABILITIES), value=6)


@query("histogram", _histogram_sql("relevance_score", 50))
def _(w):
    return _rounded(distribution.histogram(w.review_relevant, "relevance_score", 50), low=6, high=6)


@query("length_histogram", _histogram_sql("text_length", 40))
def _(w):
    return _rounded(distribution.histogram(w.review_relevant, "text_length", 40), low=6, high=6)


@query(
    "density",
    """SELECT CAST(g.i AS INT) AS place, round(lo + (hi - lo) * g.i / 199, 6) AS x,
    round(sum(exp(-pow((lo + (hi - lo) * g.i / 199 - relevance_score) / h, 2) / 2)) / (n * h * sqrt(2 * pi())), 6) AS density
    FROM f_scored, (SELECT min(relevance_score) AS lo, max(relevance_score) AS hi, count(*) AS n, stddev_samp(relevance_score) * pow(count(*), -0.2) AS h FROM f_scored) s,
    range(200) g(i) GROUP BY g.i, lo, hi, n, h""",
)
def _(w):
    return _rounded(distribution.density(w.review_relevant, "relevance_score"), x=6, density=6)


# --- dashboard --------------------------------------------------------------------------
_REL = "relevant_status = 'RELEVANT'"


@query(
    "kpi_global",
    f"""SELECT count(*) AS total_reviews, count(*) FILTER ({_REL}) AS nb_relevant, round(avg(rating), 2) AS avg_rating,
    round(avg(relevance_score), 2) AS avg_relevance_score, round(avg(confidence_score), 2) AS avg_confidence_score,
    round(avg(text_length), 2) AS avg_text_length FROM f_scored""",
)
def _(w):
    return kpi.kpi_global(w.review_relevant)


@query("kpi_status", "SELECT relevant_status, count(*) AS nb_reviews FROM f_scored GROUP BY relevant_status")
def _(w):
    return kpi.kpi_status(w.review_relevant)


@query(
    "kpi_category",
    f"""SELECT category, count(*) AS nb_reviews, count(*) FILTER ({_REL}) AS nb_relevant,
    round(count(*) FILTER ({_REL}) / count(*), 3) AS pourcentage_relevant, round(avg(rating), 2) AS avg_rating FROM f_scored GROUP BY category""",
)
def _(w):
    return kpi.kpi_category(w.review_relevant)


def _count_sql(keys: str, name: str, where: str, direction: str, limit: str = "LIMIT 20") -> str:
    order = ", ".join(f"{k.strip()} NULLS FIRST" for k in keys.split(","))
    return f"SELECT {keys}, count(*) AS {name} FROM f_scored {where} GROUP BY {keys} ORDER BY {name} {direction}, {order} {limit}"


@query("kpi1", _count_sql("product_name", "nb_relevant_reviews", f"WHERE {_REL}", "DESC"))
def _(w):
    return kpi.kpi1_top_products(w.review_relevant)


@query("kpi2", _count_sql("category_review", "nb_relevant", f"WHERE {_REL}", "DESC", ""))
def _(w):
    return kpi.kpi2_topics(w.review_relevant)


@query("kpi3", _count_sql("buyer_id", "nb_relevant_reviews", f"WHERE {_REL}", "DESC"))
def _(w):
    return kpi.kpi3_top_buyers(w.review_relevant)


@query("kpi4a", _count_sql("product_name, category_review", "nb_reviews", "", "ASC"))
def _(w):
    return kpi.kpi4_rare_products(w.review_relevant)


@query("kpi4b", _count_sql("product_name", "nb_reviews", f"WHERE {_REL}", "ASC"))
def _(w):
    return kpi.kpi4_rare_relevant_products(w.review_relevant)


@query(
    "kpi5",
    f"""SELECT buyer_id, count(*) AS total_reviews, count(*) FILTER ({_REL}) AS nb_relevant, round(count(*) FILTER ({_REL}) / count(*), 3) AS pct_relevant
    FROM f_scored GROUP BY buyer_id ORDER BY total_reviews DESC, buyer_id NULLS FIRST LIMIT 20""",
)
def _(w):
    return kpi.kpi5_active_buyers(w.review_relevant)


@query("kpi6", _count_sql("product_name", "nb_reviews", "", "DESC"))
def _(w):
    return kpi.kpi6_most_reviewed(w.review_relevant)


@query(
    "kpi7",
    "SELECT product_name, rating, round(relevance_score, 6) AS relevance_score, confidence_score, description FROM f_scored "
    "WHERE category_review = 'customer service or support'",
)
def _(w):
    return _rounded(kpi.kpi7_service_reviews(w.review_relevant), relevance_score=6)


# --- serving ------------------------------------------------------------------------------
@query(
    "product_list",
    "SELECT DISTINCT p_id, product_name, category FROM f_scored ORDER BY product_name NULLS FIRST, p_id NULLS FIRST LIMIT 100",
)
def _(w):
    return serve.product_list(w.review_relevant)


@query("buyer_products", "SELECT DISTINCT buyer_id, p_id, product_name, category FROM f_scored WHERE buyer_id IS NOT NULL")
def _(w):
    return serve.buyer_products(w.review_relevant)


@query("buyer_products_one", "SELECT DISTINCT p_id, product_name, category FROM f_scored WHERE buyer_id = '13'")
def _(w):
    return serve.buyer_products(w.review_relevant, "13")


_IMAGES_SQL = "array_to_string(list_filter(list_transform(string_split(coalesce(review_img, ''), ','), lambda x: trim(x)), lambda x: x <> ''), '|')"
_REVIEW_SQL = f"""SELECT review_id, buyer_id, p_id, product_name, category, title, description AS r_desc, rating, text_length, has_image = 1 AS has_image,
    has_orders = 1 AS has_orders, round(relevance_score, 6) AS relevance_score, category_review, confidence_score, relevant_status,
    is_extreme_rating = 1 AS is_extreme_rating, {_IMAGES_SQL} AS images FROM f_scored WHERE {_REL}"""


def _flat_review(df: DataFrame) -> DataFrame:
    df = df.withColumn("images", F.array_join("images", "|")).withColumn("relevance_score", F.round("relevance_score", 6))
    return df.drop("text_length_score", "keyword_score")


@query("product_reviews", _REVIEW_SQL + " AND p_id = '11' ORDER BY f_scored.relevance_score DESC NULLS LAST, review_id LIMIT 10")
def _(w):
    return _flat_review(serve.product_reviews(w.review_relevant, "11"))


@query(
    "best_reviews_per_product",
    f"""SELECT p_id, review_id, rank FROM (SELECT p_id, review_id, row_number() OVER (PARTITION BY p_id ORDER BY relevance_score DESC NULLS LAST, review_id) AS rank
    FROM f_scored WHERE {_REL} AND p_id IS NOT NULL) q WHERE rank <= 10""",
)
def _(w):
    return serve.best_reviews_per_product(w.review_relevant).select("p_id", "review_id", "rank")


@query(
    "best_reviews_by_confidence",
    f"""SELECT p_id, review_id, rank, repeat('⭐', rating) AS stars FROM (SELECT *, row_number() OVER (PARTITION BY p_id ORDER BY confidence_score DESC NULLS LAST, review_id) AS rank
    FROM f_scored WHERE {_REL} AND p_id IS NOT NULL) q WHERE rank <= 5""",
)
def _(w):
    best = serve.best_reviews_per_product(w.review_relevant, 5, "confidence_score")
    return best.select("p_id", "review_id", "rank", scalar.stars("rating").alias("stars"))


@query("buyer_product_reviews", _REVIEW_SQL + " AND p_id = '11' AND buyer_id = (SELECT min(buyer_id) FROM f_scored WHERE p_id = '11' AND relevant_status = 'RELEVANT')")
def _(w):
    scored = w.review_relevant
    chosen = scored.where((F.col("p_id") == "11") & (F.col("relevant_status") == "RELEVANT"))
    buyer = chosen.agg(F.min("buyer_id").alias("b")).first()["b"]
    return _flat_review(serve.buyer_product_reviews(scored, buyer, "11"))


@query(
    "by_confidence",
    f"""SELECT review_id, buyer_id, description AS r_desc, title, rating, has_image = 1 AS has_image, coalesce(confidence_score, 0.0E0) AS confidence_score, product_name
    FROM f_scored WHERE {_REL} AND p_id = '11' ORDER BY f_scored.confidence_score DESC NULLS LAST, review_id LIMIT 5""",
)
def _(w):
    return serve.reviews_by_confidence(w.review_relevant, "11")


@query(
    "reviews_with_images",
    f"""SELECT s.review_id, s.p_id, s.buyer_id, s.confidence_score, 0 AS image_part, coalesce(i.images, '') AS images FROM f_scored s
    LEFT JOIN (SELECT review_id, string_agg(review_img, '|' ORDER BY review_img) AS images FROM f_review_images GROUP BY review_id) i
    ON s.review_id = i.review_id WHERE {_REL}""",
)
def _(w):
    found = serve.buyer_reviews_with_images(w.review_relevant, w.sources["review_images"])
    return found.select(
        "review_id", "p_id", "buyer_id", "confidence_score", "image_part", F.array_join("images", "|").alias("images")
    )


@query("image_list", f"SELECT review_id, {_IMAGES_SQL} AS images FROM (SELECT review_id, string_agg(review_img, ' , ' ORDER BY review_img) AS review_img FROM f_review_images GROUP BY review_id) q")
def _(w):
    lists = joins.collect_parts(w.sources["review_images"], "review_id", F.col("review_img"), "l", "part")
    text = lists.select("review_id", F.array_join("l", " , ").alias("review_img"))
    return text.select("review_id", F.array_join(scalar.image_list("review_img"), "|").alias("images"))


@query("search_products", "SELECT p_id, p_name, price FROM f_product WHERE contains(lower(p_name), 'ring')")
def _(w):
    return serve.search(w.sources["product"], "p_name", "RiNg").select("p_id", "p_name", "price")


@query("page_products", "SELECT p_id, p_name FROM f_product ORDER BY p_id LIMIT 50 OFFSET 100")
def _(w):
    return serve.page(w.sources["product"].select("p_id", "p_name"), "p_id", 100, 50)


@query("lookup_product", "SELECT p_id, p_name, price FROM f_product WHERE p_id = '11'")
def _(w):
    return serve.lookup_stripped(w.sources["product"], "p_id", "  11 ").select("p_id", "p_name", "price")


@query("lookup_shipments", "SELECT shipping_id, p_id, status FROM f_shipment WHERE order_id = 7")
def _(w):
    return serve.lookup(w.sources["shipment"], order_id=7).select("shipping_id", "p_id", "status")


@query("lookup_orders", "SELECT order_id, CAST(order_date AS VARCHAR) AS order_date FROM f_orders WHERE buyer_id = '13'")
def _(w):
    found = serve.lookup(w.sources["orders"], buyer_id="13")
    return found.select("order_id", F.col("order_date").cast("string").alias("order_date"))


@query("lookup_customer", "SELECT c_id, fname, email FROM f_customer WHERE email = 'Customer#000000013'")
def _(w):
    return serve.lookup(w.sources["customer"], email="Customer#000000013").select("c_id", "fname", "email")


@query("lookup_order", "SELECT order_id, buyer_id, CAST(order_date AS VARCHAR) AS order_date FROM f_orders WHERE order_id = 77")
def _(w):
    found = serve.lookup(w.sources["orders"], order_id=77)
    return _texts(found.select("order_id", "buyer_id", "order_date"), "order_date")


@query("lookup_product_images", "SELECT p_id, p_image FROM f_product_images WHERE p_id = '11'")
def _(w):
    return serve.images_of_product(w.sources["product_images"], "11")


@query(
    "best_reviews_of_products",
    f"""SELECT p_id, review_id, rank FROM (SELECT p_id, review_id, row_number() OVER (PARTITION BY p_id ORDER BY relevance_score DESC NULLS LAST, review_id) AS rank
    FROM f_scored WHERE {_REL} AND p_id IN (SELECT p_id FROM f_product WHERE p_desc LIKE 'STANDARD%')) q WHERE rank <= 10""",
)
def _(w):
    wanted = w.sources["product"].where(F.col("p_desc").startswith("STANDARD"))
    return serve.best_reviews_per_product(w.review_relevant, products=wanted).select("p_id", "review_id", "rank")


_BUYER_OF_11 = f"(SELECT min(buyer_id) FROM f_scored WHERE p_id = '11' AND {_REL})"


@query(
    "buyer_product_images",
    f"""SELECT s.review_id, s.confidence_score, coalesce(i.images, '') AS images FROM f_scored s
    LEFT JOIN (SELECT review_id, string_agg(review_img, '|' ORDER BY review_img) AS images FROM f_review_images GROUP BY review_id) i USING (review_id)
    WHERE {_REL} AND p_id = '11' AND buyer_id = {_BUYER_OF_11}""",
)
def _(w):
    scored = w.review_relevant
    buyer = scored.where((F.col("p_id") == "11") & (F.col("relevant_status") == "RELEVANT")).agg(F.min("buyer_id").alias("b")).first()["b"]
    found = serve.buyer_reviews_with_images(scored, w.sources["review_images"], buyer, "11")
    return found.select("review_id", "confidence_score", F.array_join("images", "|").alias("images"))

# --- the same requests from stored layouts: one bucket, the folders of a page, the words of a text --------------------
@query("served_product_reviews", REGISTRY["product_reviews"].sql, plain=True)
def _(w):
    return _flat_review(serve.as_review(serve.ranked_reviews(w.ranking.lookup("11"), "relevance_score", 10).drop("by", "rank")))


@query("served_by_confidence", REGISTRY["by_confidence"].sql, plain=True)
def _(w):
    return serve.as_short(serve.ranked_reviews(w.ranking.lookup("11"), "confidence_score", 5))


@query("served_best_of_products", REGISTRY["best_reviews_of_products"].sql, plain=True)
def _(w):
    wanted = w.sources["product"].where(F.col("p_desc").startswith("STANDARD"))
    return serve.ranked_reviews(w.ranking.lookup_many(wanted), "relevance_score", 10).select("p_id", "review_id", "rank")


@query("served_buyer_product_reviews", REGISTRY["buyer_product_reviews"].sql, plain=True)
def _(w):
    buyer = w.relevant_by_pair.rows.where(F.col("p_id") == "11").agg(F.min("buyer_id").alias("b")).first()["b"]
    return _flat_review(serve.as_review(w.relevant_by_pair.lookup(buyer, "11")))


@query("served_shipments", REGISTRY["lookup_shipments"].sql, plain=True)
def _(w):
    return w.keyed("shipment", "order_id").lookup(7).select("shipping_id", "p_id", "status")


@query("served_customer", REGISTRY["lookup_customer"].sql, plain=True)
def _(w):
    return w.keyed("customer", "email").lookup("Customer#000000013").select("c_id", "fname", "email")


@query("served_orders_of_buyers", "SELECT order_id, buyer_id FROM f_orders WHERE buyer_id IN (SELECT buyer_id FROM f_review WHERE rating = 5)")
def _(w):
    # A batch of keys: the orders stay in their buckets, the buyers come to them.
    wanted = w.sources["review"].where("rating = 5").select("buyer_id")
    return w.keyed("orders", "buyer_id").lookup_many(wanted).select("order_id", "buyer_id")


@query("served_page", "SELECT p_id, p_name FROM f_product ORDER BY p_id LIMIT 50 OFFSET 100")
def _(w):
    return w.product_pages.page(100, 50)


@query("served_last_page", "SELECT p_id, p_name FROM f_product ORDER BY p_id DESC LIMIT 30")
def _(w):
    last = sum(n for _, _, n in w.product_pages.starts)
    return w.product_pages.page(last - 30, 100)


@query("served_search", "SELECT p_id, p_name, price FROM f_product WHERE contains(lower(p_name), 'blue ')")
def _(w):
    return w.product_names.search("BLUE ")


@query(
    "product_labels",
    "SELECT p.p_id, p.p_name || ' (' || coalesce(c.name, 'N/A') || ')' AS label FROM f_product p LEFT JOIN f_category c ON p.category_id = c.category_id",
)
def _(w):
    named = w.sources["product"].join(w.sources["category"].withColumnRenamed("name", "category"), "category_id", "left")
    return named.select("p_id", scalar.product_label("p_name").alias("label"))


@query("parameter_query", "SELECT p_id, count(*) AS nb_reviews FROM f_scored WHERE rating >= 4 GROUP BY p_id HAVING count(*) >= 2")
def _(w):
    w.review_relevant.createOrReplaceTempView("review_relevant")
    return serve.run_query(
        w.spark,
        "SELECT p_id, count(*) AS nb_reviews FROM review_relevant WHERE rating >= :low GROUP BY p_id HAVING count(*) >= :least",
        low=4, least=2,
    )


# --- shop ---------------------------------------------------------------------------------
def _line_keys(w) -> shop.LineKeys:
    return {c: w.sources.profiles.hot("cart_items", c) for c in skew.JOIN_KEYS["cart_items"]}


@query(
    "cart_totals",
    """SELECT cart_id, CAST(coalesce(sum(qty) FILTER (known), 0) AS BIGINT) AS total_qty, round(coalesce(sum(price * qty), 0), 4) AS total_price,
    count(*) FILTER (NOT known) AS rejected_lines FROM f_lines GROUP BY cart_id""",
)
def _(w):
    return _rounded(shop.cart_totals(w.sources["cart_items"], w.sources["product"], hot=_line_keys(w)), total_price=4)


_UNKNOWN = "SELECT cart_id, p_id, qty, 'Product does not exist' AS error_details FROM f_lines WHERE NOT known"


@query("cart_rejected_lines", _UNKNOWN)
def _(w):
    return shop.rejected_lines(w.sources["cart_items"], w.sources["product"], hot=_line_keys(w))


_DEALS = """SELECT cart_id, round(gross, 4) AS total_before, round(cut, 4) AS discount_total, round(greatest(20000, gross - cut), 4) AS total_after FROM (
    SELECT cart_id, coalesce(sum(price * qty), 0) AS gross, coalesce(sum(price * qty * coalesce(discount, 0) / 100), 0) AS cut
    FROM f_lines LEFT JOIN (SELECT p_id, discount FROM f_daily_deals WHERE deal_date = DATE '2024-01-15') cheap USING (p_id) GROUP BY cart_id) q"""


def _deal_totals(w, **options):
    import datetime

    found = shop.deal_totals(
        w.sources["cart_items"], w.sources["product"], w.sources["daily_deals"],
        datetime.date.fromisoformat(DEAL_DAY), 20000.0, **options,
    )
    return _rounded(found, total_before=4, discount_total=4, total_after=4)


@query("deal_totals", _DEALS)
def _(w):
    return _deal_totals(w, hot=_line_keys(w))


@query("deal_totals_hot_keys", _DEALS)
def _(w):
    return _deal_totals(w, hot_rows=20)


@query(
    "cart_upsert",
    """SELECT cart_id, p_id, CAST(sum(qty) AS BIGINT) AS qty FROM (SELECT cart_id, p_id, qty FROM f_cart_items
    UNION ALL SELECT o_orderkey, CAST(o_custkey AS VARCHAR), 2 FROM orders) q GROUP BY cart_id, p_id""",
)
def _(w):
    added = w.base["orders"].select(
        F.col("o_orderkey").alias("cart_id"), F.col("o_custkey").cast("string").alias("p_id"), F.lit(2).alias("qty")
    )
    return shop.upsert_cart_items(w.sources["cart_items"], added)


def _checkout(w) -> shop.Checkout:
    s = w.sources
    day = F.lit(DEAL_DAY).cast("date")
    return shop.checkout(s["cart"], s["cart_items"], s["product"], day, first_order_id=1_000_000, hot=_line_keys(w))


@query(
    "checkout_items",
    "SELECT cart_id + 1000000 AS order_id, p_id, qty, price AS price_at_purchase FROM f_lines WHERE known",
)
def _(w):
    return _checkout(w).order_items


@query(
    "checkout_shipments",
    f"""SELECT (cart_id + 1000000) || '-' || p_id AS shipping_id, cart_id + 1000000 AS order_id, p_id, 'NP' AS shipment_type, 'processing' AS status,
    CAST(DATE '{DEAL_DAY}' + 7 AS VARCHAR) AS est_delivery_date FROM f_lines WHERE known""",
)
def _(w):
    sent = _checkout(w).shipments.drop("carrier_id", "actual_delivery_date")
    return _texts(sent, "est_delivery_date")


@query("checkout_rejected_lines", _UNKNOWN)
def _(w):
    return _checkout(w).rejected_lines


_FILLED = "(SELECT cart_id FROM f_lines WHERE known GROUP BY cart_id HAVING sum(qty) > 0)"


@query(
    "checkout_payments",
    f"""SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21) AS payment_id,
    order_id, 'card' AS method, 'completed' AS status FROM (
    SELECT cart_id + 1000000 AS order_id, md5('payment-' || (cart_id + 1000000)) AS h FROM f_cart WHERE cart_id IN {_FILLED}) q""",
)
def _(w):
    return _checkout(w).payments.drop("created_at")


@query(
    "checkout_emptied_carts",
    f"SELECT cart_id, buyer_id, 0 AS total_qty, 0.0E0 AS total_price FROM f_cart WHERE cart_id IN {_FILLED}",
)
def _(w):
    return _checkout(w).carts


@query(
    "checkout_rejected",
    f"""SELECT cart_id, buyer_id, CASE WHEN cart_id IN (SELECT cart_id FROM f_cart_items) THEN 'Cart has nothing to order'
    ELSE 'Cart is empty or does not exist' END AS error_details FROM f_cart WHERE cart_id NOT IN {_FILLED}""",
)
def _(w):
    return _checkout(w).rejected


@query(
    "cart_documents",
    """SELECT cart_id, buyer_id, total_qty, round(total_price, 4) AS total_price, 0 AS part, coalesce(i.items, '') AS items FROM f_cart LEFT JOIN (
    SELECT cart_id, string_agg(p_id || ':' || qty, '|' ORDER BY p_id, qty) AS items FROM f_cart_items GROUP BY cart_id) i USING (cart_id)""",
)
def _(w):
    nested = shop.cart_documents(w.sources["cart"], w.sources["cart_items"])
    items = F.transform("items", lambda i: F.concat(i["p_id"], F.lit(":"), i["qty"].cast("string")))
    return _rounded(nested.withColumn("items", F.array_join(items, "|")), total_price=4)


def _order_documents(w, **options) -> DataFrame:
    nested = shop.checkout_documents(_checkout(w), **options)
    items = F.transform("items", lambda i: F.concat(i["p_id"], F.lit(":"), i["qty"].cast("string")))
    sent = F.transform("shipments", lambda s: s["p_id"])
    return nested.select(
        "order_id", "buyer_id", "part", F.array_join(items, "|").alias("items"),
        F.array_join(sent, "|").alias("shipments"), F.col("payment.method").alias("method"),
    )


_ORDER_DOCUMENTS = f"""SELECT c.cart_id + 1000000 AS order_id, c.buyer_id, i.items, i.sent AS shipments, 'card' AS method FROM f_cart c JOIN (
    SELECT cart_id, string_agg(p_id || ':' || qty, '|' ORDER BY p_id, qty) AS items, string_agg(p_id, '|' ORDER BY p_id) AS sent
    FROM f_lines WHERE known GROUP BY cart_id) i ON c.cart_id = i.cart_id"""


@query("order_documents", f"SELECT *, 0 AS part FROM ({_ORDER_DOCUMENTS}) d")
def _(w):
    return _order_documents(w)


@query("order_document_parts", _ORDER_DOCUMENTS.replace("ORDER BY p_id, qty", "ORDER BY p_id || ':' || qty"))
def _(w):
    # Orders in parts of about two lines, put together again: no item is torn from its shipment, none is lost.
    parts = _order_documents(w, part_rows=2)
    torn = F.transform(F.split("items", r"\|"), lambda x: F.split(x, ":")[0]) != F.split("shipments", r"\|")
    whole = parts.withColumn("shipments", F.when(torn, "torn").otherwise(F.col("shipments")))
    together = lambda c: F.array_join(F.array_sort(F.flatten(F.collect_list(F.split(c, r"\|")))), "|").alias(c)
    return whole.groupBy("order_id", "buyer_id", "method").agg(together("items"), together("shipments"))


@query(
    "image_parts",
    """SELECT review_id, string_agg(review_img, '|' ORDER BY review_img) AS images, CAST(count(*) AS BIGINT) AS n FROM f_review_images
    WHERE review_img IS NOT NULL GROUP BY review_id""",
)
def _(w):
    lists = joins.collect_parts(w.sources["review_images"], "review_id", F.col("review_img"), "l", "part", 1)
    return lists.groupBy("review_id").agg(
        F.array_join(F.array_sort(F.flatten(F.collect_list("l"))), "|").alias("images"), F.sum(F.size("l")).alias("n")
    )


# --- lake and jobs ---------------------------------------------------------------------------
@query("csv_lake", "SELECT CAST(review_id AS VARCHAR) AS review_id, buyer_id, CASE WHEN r_desc = '   ' THEN '   ' ELSE r_desc END AS r_desc, title, CAST(rating AS VARCHAR) AS rating FROM f_review")
def _(w):
    path = writers.write_lake(w.sources["review"], scratch_path(w.spark, "review_csv"), "csv")
    back = readers.read_lake_table(w.spark, "review", path, "csv")
    return _texts(back.drop("seller_product_flag"), "review_id", "rating")


@query(
    "extract_reconcile",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS source_rows, count(*) AS sink_rows, 0 AS difference FROM f_{t}"
        for t in ("product", "category", "buyer", "review", "product_reviews", "review_images", "orders", "carrier")
    ),
)
def _(w):
    paths, _status = extract.extract_tables(w.spark, w.sources.__getitem__, scratch_path(w.spark, "lake"))
    return quality.reconcile({t: (w.sources[t], w.spark.read.parquet(p)) for t, p in paths.items()})


@query(
    "run_statistics",
    """SELECT count(*) AS total_records_processed, count(*) FILTER (rejection_reason IS NULL) AS clean_records,
    count(*) FILTER (rejection_reason IS NOT NULL) AS rejected_records, count(*) FILTER (rejection_reason IS NULL) AS warehouse_inserts,
    count(*) FILTER (rejection_reason IS NOT NULL) AS reject_inserts FROM f_flagged""",
)
def _(w):
    metadata = scratch_path(w.spark, "metadata")
    names = ("product", "category", "review", "product_reviews", "review_images", "orders")
    jobs.process_tables(
        {t: w.sources[t] for t in names}, scratch_path(w.spark, "reviews"), scratch_path(w.spark, "rejected"), metadata
    )
    runs = snapshots.read_published(w.spark, metadata)
    keys = ("total_records_processed", "clean_records", "rejected_records", "warehouse_inserts", "reject_inserts")
    return runs.select(*[F.col("statistics")[k].alias(k) for k in keys])


_RUN = "SELECT count(*) AS n, count(*) FILTER (rejection_reason IS NULL) AS ok FROM f_flagged"


def _statistics(w) -> DataFrame:
    clean_row = F.col("verdict") == "clean"
    return w.flagged.agg(
        scalar.n_rows().alias("total_records_processed"), F.count_if(~clean_row).alias("rejected_records"),
        F.count_if(clean_row).alias("warehouse_inserts"),
    )


@query("rejection_guard", f"SELECT round((n - ok) * 100.0E0 / n, 6) AS rejection_rate, CASE WHEN (n - ok) * 100.0E0 / n < 1 THEN 'ok' ELSE 'warning' END AS status FROM ({_RUN}) q")
def _(w):
    return _rounded(quality.rejection_guard(_statistics(w)), rejection_rate=6)


@query("load_guard", f"SELECT ok AS rows_loaded, CASE WHEN ok > 0 THEN 'success' ELSE 'warning' END AS status FROM ({_RUN}) q")
def _(w):
    return quality.load_guard(_statistics(w))


@query("table_shape", "SELECT count(*) AS n_rows, 19 AS n_columns FROM f_scored")
def _(w):
    return readers.shape(w.review_relevant)


# --- sources and sinks, written and read back ------------------------------------------------
@query("rejected_times", f"SELECT CAST(review_id AS VARCHAR) AS review_id, rejection_reason, '{INGESTED_AT}' AS rejected_at FROM f_flagged WHERE rejection_reason IS NOT NULL")
def _(w):
    return _texts(w.rejected.select("review_id", "rejection_reason", "rejected_at"), "review_id")


_STORED = f"""SELECT review_id, buyer_id, p_id, product_name, category, title, description, rating, text_length, has_image = 1 AS has_image,
    has_orders = 1 AS has_orders, review_img, '{INGESTED_AT}' AS ingestion_timestamp, '{PIPELINE_VERSION}' AS pipeline_version FROM f_clean"""


@query("stored_reviews", _STORED)
def _(w):
    path = scratch_path(w.spark, "stored")
    writers.save_reviews(w.clean, path, F.lit(INGESTED_AT))
    return _texts(snapshots.read_published(w.spark, path), "ingestion_timestamp")


@query(
    "stored_rejects",
    """SELECT CAST(review_id AS VARCHAR) AS review_id, rejection_reason, 'run' AS run_id, p_id, buyer_id, CAST(rating AS VARCHAR) AS rating
    FROM f_flagged WHERE rejection_reason IS NOT NULL""",
)
def _(w):
    path = scratch_path(w.spark, "rejects")
    for _ in range(2):  # the second attempt replaces the first
        writers.save_rejected(w.rejected, path, "run")
    back = snapshots.read_published(w.spark, path)
    row = [F.col(f"original_data.{c}").alias(c) for c in ("p_id", "buyer_id", "rating")]
    return _texts(back.select("review_id", "rejection_reason", "run_id", *row), "review_id", "rating")


@query("saved_review_relevant", "SELECT review_id, p_id, rating, has_image = 1 AS has_image, round(relevance_score, 6) AS relevance_score, confidence_score, relevant_status FROM f_scored")
def _(w):
    path = scratch_path(w.spark, "relevant")
    writers.save_review_relevant(w.review_relevant, path)
    saved = snapshots.read_published(w.spark, path)
    return _rounded(saved, relevance_score=6).select("review_id", "p_id", "rating", "has_image", "relevance_score", "confidence_score", "relevant_status")


@query("scoring_input", "SELECT review_id, buyer_id, p_id, product_name, category, title, description, rating, text_length, has_image = 1 AS has_image, has_orders = 1 AS has_orders, review_img FROM f_clean")
def _(w):
    w.reviews.createOrReplaceTempView("reviews_to_score")
    return readers.read_for_scoring(w.spark, "reviews_to_score")


@query("precomputed_scores", "SELECT review_id, category_review, round(confidence_score, 6) AS confidence_score FROM f_review_class")
def _(w):
    path = scratch_path(w.spark, "scores")
    share = w.classes.withColumn("confidence_score", F.col("confidence_score") / 100)
    writers.write_lake(share.select("review_id", "category_review", "confidence_score"), path, "csv")
    back = readers.read_precomputed_scores(w.spark, path, share.select("review_id", "category_review", "confidence_score").schema)
    return _rounded(back, confidence_score=6)


@query("indexed_csv", "SELECT p_id, p_name, price FROM f_product")
def _(w):
    path = scratch_path(w.spark, "indexed")
    plain = w.sources["product"].select("p_id", "p_name", "price")
    writers.write_lake(plain.select(F.monotonically_increasing_id().alias("_c0"), "*"), path, "csv")
    return readers.read_indexed_csv(w.spark, path, plain.schema)


@query("stage_nulls", "SELECT CAST(review_id AS VARCHAR) AS review_id, CASE WHEN review_id % 5 IN (0, 1) THEN NULL ELSE title END AS title, CAST(rating AS VARCHAR) AS rating FROM f_review")
def _(w):
    path = scratch_path(w.spark, "stage")
    review = w.sources["review"].select("review_id", "title", "rating")
    spelled = F.when(F.col("review_id") % 5 == 0, "NULL").when(F.col("review_id") % 5 == 1, "null").otherwise(F.col("title"))
    writers.write_lake(review.withColumn("title", spelled), path, "csv")
    return _texts(readers.read_stage_csv(w.spark, path, review.schema), "review_id", "rating")


@query(
    "load_without_images",
    """SELECT 'review_images' AS table_name, false AS loaded, CAST(0 AS BIGINT) AS n_rows UNION ALL SELECT 'product', true, count(*) FROM f_product
    UNION ALL SELECT 'category', true, count(*) FROM f_category UNION ALL SELECT 'review', true, count(*) FROM f_review
    UNION ALL SELECT 'product_reviews', true, count(*) FROM f_product_reviews UNION ALL SELECT 'orders', true, count(*) FROM f_orders""",
)
def _(w):
    root = scratch_path(w.spark, "lake")
    paths = readers.lake_paths(root)
    for table, path in paths.items():
        if table != "review_images":  # optional: its place stays empty
            writers.write_lake(_declared(w, table), path)
    tables, status = readers.load_tables(w.spark, paths)
    counts = reduce(DataFrame.unionAll, [df.agg(F.lit(t).alias("table_name"), scalar.n_rows().alias("n_rows")) for t, df in tables.items()])
    return status.select("table_name", F.col("error").isNull().alias("loaded")).join(counts, "table_name")


def _declared(w, table: str) -> DataFrame:
    """A source table with all its declared columns, in order."""
    df = w.sources[table]
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema_of(table)])


#: What a loaded table is compared by: rows, and a sum over all values of each column as text.
_WEIGHT = "length(CAST({0} AS VARCHAR)) + 7 * ascii(CAST({0} AS VARCHAR))"


def _loaded_sql() -> str:
    parts = []
    for table, columns in _given().items():
        parts += [
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(nullif(CAST({c} AS VARCHAR), '')) AS n_values, CAST(coalesce(sum({_WEIGHT.format(c)}), 0) AS BIGINT) AS weight FROM f_{table}"
            for c in columns if (table, c) not in _REAL
        ]
    return " UNION ALL ".join(parts)


#: Columns of real numbers: their spelling as text is a matter of the engine. They are compared by their sums.
_REAL = {(t, c.split()[0]) for t, text in COLUMNS.items() for c in text.split(",") if c.split()[1] in ("double", "float") or c.split()[1].startswith("decimal")}


@query("bulk_load", _loaded_sql())
def _(w):
    """CSV files loaded into a database, compared by column; the database is dropped when its figures are taken.

    An empty text is null after that, as CSV tells no difference here.
    """
    database = f"bulk_{uuid.uuid4().hex[:12]}"
    w.spark.sql(f"CREATE DATABASE {database}")
    try:
        root = scratch_path(w.spark, "bulk")
        files = {t: writers.write_lake(_declared(w, t), f"{root}/{t}", "csv", "gzip") for t in COLUMNS}
        extract.bulk_load(w.spark, files, database)
        given = _given()
        listed = [r["tableName"] for r in readers.list_tables(w.spark, database).where("NOT isTemporary").collect()]
        parts = []
        for table in listed:
            names = [c for c in given[table] if (table, c) not in _REAL]
            text = {c: F.col(c).cast("string") for c in names}
            rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.count(c).alias("n_values"), F.coalesce(F.sum(F.length(text[c]) + 7 * F.ascii(text[c])), F.lit(0)).cast("long").alias("weight")) for c in names])
            one = w.spark.table(f"{database}.{table}").agg(rows.alias("r"))
            parts.append(one.select(F.lit(table).alias("table_name"), F.inline("r")))
        return stored(reduce(DataFrame.unionAll, parts), "bulk-figures")
    finally:
        w.spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


@query("failed_tables", "SELECT 2 AS failed, 8 AS total, 'orders, review_images' AS names, (SELECT count(*) FROM f_review) AS reviews_loaded")
def _(w):
    """An extraction of which two tables fail, one as it is asked for and one as its rows are read, and the report of it."""
    def read(table):
        if table == "orders":
            raise ConnectionError("source does not answer")
        df = w.sources[table]
        broken = F.raise_error(F.lit("page cannot be read"))
        return df.withColumn("review_img", F.when(F.col("review_id") >= 0, broken.cast("string"))) if table == "review_images" else df

    paths, status = extract.extract_tables(w.spark, read, scratch_path(w.spark, "lake"))
    reviews = w.spark.read.parquet(paths["review"]).agg(scalar.n_rows()).scalar()
    return quality.failed_tables(status).withColumn("reviews_loaded", reviews)


@query("sampled_rows", "SELECT 50 AS n, 50 AS different, 50 AS known FROM f_product LIMIT 1")
def _(w):
    # The same rows however the table is laid out, all of them rows of the table.
    product = w.sources["product"].select("p_id", "p_name")
    first, second = (readers.sample_rows(df, 50, 3, "p_id") for df in (product, product.repartition(7)))
    both = first.join(second, ["p_id", "p_name"]).join(product, ["p_id", "p_name"])
    return both.agg(scalar.n_rows().cast("int").alias("n"), F.count_distinct("p_id").cast("int").alias("different"), scalar.n_rows().cast("int").alias("known"))


@query("csv_lines", "SELECT CAST(review_id AS VARCHAR) AS review_id, r_desc, title FROM f_review")
def _(w):
    path = writers.write_lake(w.sources["review"], scratch_path(w.spark, "review_lines"), "csv-lines")
    return _texts(readers.read_lake_table(w.spark, "review", path, "csv-lines").select("review_id", "r_desc", "title"), "review_id")


@query("lower_case_names", "SELECT review_id, p_id, rating FROM f_clean")
def _(w):
    loud = w.reviews.toDF(*[c.upper() for c in w.reviews.columns])
    return serve.lower_names(loud).select("review_id", "p_id", "rating")


@query(
    "columns_to_add",
    """SELECT unnest(['text_length_score', 'is_extreme_rating', 'keyword_score', 'relevance_score', 'category_review', 'confidence_score',
    'relevant_status']) AS name, count(*) AS n_rows FROM f_clean""",
)
def _(w):
    missing = serve.missing_columns(w.reviews, list(REVIEW_RELEVANT_COLUMNS))
    return w.reviews.agg(scalar.n_rows().alias("n_rows")).select(F.explode(F.array(*map(F.lit, missing))).alias("name"), "n_rows")
