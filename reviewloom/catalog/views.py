"""Reference SQL for the derived tables, as named views a query can be prefixed with.

The SQL states each step independently of the DataFrame jobs and serves to compare
results in another engine.
"""

from __future__ import annotations

import re

from ..functions.scalar import PUNCTUATION
from ..functions.sentiment import (
    AFTER_CONTRAST, BEFORE_CONTRAST, CAPITALS, DEGREE, DISTANCE_FACTORS, EXCLAMATION, MANY_QUESTIONS,
    MAX_EXCLAMATIONS, MAX_QUESTIONS, NEGATION, NORMALISER, QUESTION, Lexicon,
)
from ..sources.driver_tables import CORPUS_KEYWORDS, CORPUS_LEXICON, DEAL_DAY, STORED_CONFIDENCE, STORED_RELEVANCE

def _words(words) -> str:
    return ", ".join(sorted("'" + w.replace("'", "''") + "'" for w in words))


def _step(lexicon: Lexicon, d: int, factor: float) -> str:
    degree = f"CASE WHEN p{d} IN ({_words(lexicon.raising)}) THEN {DEGREE} WHEN p{d} IN ({_words(lexicon.lowering)}) THEN -{DEGREE} END"
    loud = f"CASE WHEN mixed AND s{d} THEN {CAPITALS} ELSE 0 END"
    usable = f"(p{d} IS NOT NULL AND NOT k{d})"
    negates = f"(p{d} IN ({_words(lexicon.negating)}) OR contains(p{d}, 'n''t'))"
    return (
        f"(x{d - 1} + CASE WHEN {usable} THEN coalesce(({degree}) + {loud}, 0) * sign(v) * {factor} ELSE 0 END)"
        f" * CASE WHEN {usable} AND {negates} THEN {NEGATION} ELSE 1 END AS x{d}"
    )


_PUNCT = PUNCTUATION.replace("'", "''")


def sentiment_views(prefix: str, source: str, key: str, text: str, lexicon: Lexicon = CORPUS_LEXICON) -> dict[str, str]:
    """Views ending in ``{prefix}`` with (key, compound) for every row of ``source``."""
    rows = ", ".join(f"({_words([w])}, CAST({v} AS DOUBLE))" for w, v in lexicon.valence.items())
    return {
        f"{prefix}_tokens": f"""SELECT {key}, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM (
            SELECT {key}, list_filter(string_split_regex({text}, '\\s+'), lambda x: length(x) > 1) AS ws FROM {source} WHERE {text} IS NOT NULL) q""",
        f"{prefix}_words": f"""SELECT {key}, pos, word, lower(word) AS lw, upper(word) = word AND lower(word) <> word AS loud
            FROM (SELECT *, CASE WHEN trim(w, '{_PUNCT}') = '' THEN w ELSE trim(w, '{_PUNCT}') END AS word FROM {prefix}_tokens) q""",
        f"{prefix}_near": f"""SELECT t.{key}, t.pos, l.v, t.loud,
            lag(t.lw, 1) OVER o AS p1, lag(t.lw, 2) OVER o AS p2, lag(t.lw, 3) OVER o AS p3,
            lag(t.loud, 1) OVER o AS s1, lag(t.loud, 2) OVER o AS s2, lag(t.loud, 3) OVER o AS s3,
            lag(l.v IS NOT NULL, 1) OVER o AS k1, lag(l.v IS NOT NULL, 2) OVER o AS k2, lag(l.v IS NOT NULL, 3) OVER o AS k3,
            bool_or(t.loud) OVER a AND bool_or(NOT t.loud) OVER a AS mixed,
            min(CASE WHEN t.lw = '{lexicon.contrast}' THEN t.pos END) OVER a AS contrast_at
            FROM {prefix}_words t LEFT JOIN (VALUES {rows}) l(word, v) ON t.lw = l.word
            WINDOW o AS (PARTITION BY t.{key} ORDER BY t.pos), a AS (PARTITION BY t.{key})""",
        f"{prefix}_sum": f"""SELECT {key}, sum(x3 * CASE WHEN contrast_at IS NULL OR pos = contrast_at THEN 1
              WHEN pos < contrast_at THEN {BEFORE_CONTRAST} ELSE {AFTER_CONTRAST} END) AS total FROM (
            SELECT *, {_step(lexicon, 3, DISTANCE_FACTORS[2])} FROM (SELECT *, {_step(lexicon, 2, DISTANCE_FACTORS[1])} FROM (
            SELECT *, {_step(lexicon, 1, DISTANCE_FACTORS[0])} FROM (
            SELECT *, v + CASE WHEN mixed AND loud THEN sign(v) * {CAPITALS} ELSE 0 END AS x0
            FROM {prefix}_near WHERE v IS NOT NULL) a) b) c) d GROUP BY {key}""",
        f"{prefix}_loud": f"""SELECT d.{key}, coalesce(s.total, 0) AS total,
            least(length({text}) - length(replace({text}, '!', '')), {MAX_EXCLAMATIONS}) * {EXCLAMATION}E0
            + CASE WHEN q <= 1 THEN 0 WHEN q <= {MAX_QUESTIONS} THEN q * {QUESTION}E0 ELSE {MANY_QUESTIONS}E0 END AS emphasis
            FROM (SELECT *, length({text}) - length(replace({text}, '?', '')) AS q FROM {source} WHERE {text} IS NOT NULL) d
            LEFT JOIN {prefix}_sum s ON d.{key} = s.{key}""",
        prefix: f"""SELECT {key}, round(x / sqrt(x * x + {NORMALISER}), 4) AS compound
            FROM (SELECT {key}, total + sign(total) * emphasis AS x FROM {prefix}_loud) q""",
    }


KEEP_ORDER = (
    "p_id NULLS FIRST, buyer_id NULLS FIRST, rating NULLS FIRST, title NULLS FIRST, description NULLS FIRST"
)

VIEWS: dict[str, str] = {
    "f_review": """SELECT CASE WHEN doc_id % 97 = 96 THEN NULL ELSE doc_id END AS review_id,
        CASE WHEN doc_id % 59 = 0 THEN NULL ELSE CAST((doc_id * 13) % (SELECT count(*) + count(*) // 2 FROM customer) AS VARCHAR) END AS buyer_id,
        CASE WHEN doc_id % 47 = 0 THEN NULL WHEN doc_id % 53 = 0 THEN '   ' ELSE text END AS r_desc,
        CASE WHEN doc_id % 29 = 0 THEN NULL ELSE concat_ws(' ', source, lang) END AS title,
        CAST(CASE WHEN doc_id % 41 = 0 THEN NULL WHEN doc_id % 37 = 0 THEN 0 WHEN doc_id % 43 = 0 THEN 6 ELSE 1 + doc_id % 5 END AS INT) AS rating,
        'P' AS seller_product_flag FROM documents""",
    "f_product": """SELECT CAST(p_partkey AS VARCHAR) AS p_id, p_name, p_type AS p_desc, p_retailprice AS price, p_size AS qty,
        CAST(CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_partkey % 27 END AS INT) AS category_id FROM part""",
    "f_category": "SELECT n_nationkey AS category_id, n_name AS name, repeat(n_name, n_regionkey) AS c_desc FROM nation",
    "f_product_reviews": """SELECT CASE WHEN lang = 'en' THEN substr(source, 4)
          ELSE CAST((doc_id * 11) % (SELECT count(*) + 20 FROM part) AS VARCHAR) END AS p_id, doc_id AS review_id FROM documents
        UNION ALL SELECT CAST((doc_id * 11 + 1) % (SELECT count(*) + 20 FROM part) AS VARCHAR), doc_id FROM labels WHERE toxic = 1""",
    "f_review_images": """SELECT page_id * 3 AS review_id, url AS review_img FROM pages
        UNION ALL SELECT page_id * 3, url || '?v=2' FROM pages WHERE url LIKE 'https%'""",
    "f_orders": """SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS buyer_id,
        CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 30 AS INT) END AS discount_id,
        CAST(o_custkey * 2 + o_orderkey % 5 % 2 AS INT) AS payment_id, CAST(o_orderdate AS DATE) AS order_date FROM orders""",
    "f_review_class": """SELECT doc_id AS review_id, CASE doc_id % 4 WHEN 0 THEN 'product quality or satisfaction'
          WHEN 1 THEN 'product defect or damaged item' WHEN 2 THEN 'delivery issue or shipping delay'
          ELSE 'customer service or support' END AS category_review,
        CAST(40 + (doc_id * 37) % 61 AS DOUBLE) AS confidence_score FROM documents""",
    # A null image comes first; where there is none, the smallest.
    "f_first_image": """SELECT review_id, CASE WHEN bool_or(review_img IS NULL) THEN NULL ELSE min(review_img) END AS review_img
        FROM f_review_images GROUP BY review_id""",
    "f_linked": """SELECT l.review_id AS of_review, l.p_id AS linked_p_id, goods.p_id, goods.p_name AS product_name, kind.name AS category
        FROM f_product_reviews l LEFT JOIN (f_product goods LEFT JOIN f_category kind USING (category_id)) ON goods.p_id = l.p_id""",
    "f_joined": """SELECT buyer_id, review_id, title, r_desc AS description, rating, picture AS review_img, length(r_desc) AS text_length,
        CAST(picture IS NOT NULL AS INT) AS has_image, CAST(EXISTS (FROM f_orders o WHERE o.buyer_id = told.buyer_id) AS INT) AS has_orders,
        p_id, product_name, category, linked_p_id
        FROM (SELECT *, (SELECT review_img FROM f_first_image i WHERE i.review_id = v.review_id) AS picture FROM f_review v) told
        LEFT JOIN f_linked ON of_review = review_id""",
    "f_ranked": f"SELECT *, ROW_NUMBER() OVER (PARTITION BY review_id ORDER BY {KEEP_ORDER}) AS rn FROM f_joined",
    "f_flagged": r"""SELECT *, CASE WHEN rn > 1 THEN 'duplicate_review_id'
        WHEN review_id IS NULL OR rating IS NULL THEN 'missing_required_fields'
        WHEN rating < 1 OR rating > 5 THEN 'invalid_rating'
        WHEN description IS NULL OR regexp_full_match(description, '[\s\p{Z}]*') THEN 'empty_description' END AS rejection_reason FROM f_ranked""",
    "f_clean": """SELECT review_id, buyer_id, p_id, product_name, COALESCE(category, 'Unknown') AS category, COALESCE(title, '') AS title,
        description, rating, COALESCE(text_length, 0) AS text_length, has_image, has_orders, review_img FROM f_flagged WHERE rejection_reason IS NULL""",
    **sentiment_views("f_sentiment", "f_clean", "review_id", "description"),
    "f_scored": f"""SELECT s.*, CASE WHEN confidence_score >= {STORED_CONFIDENCE} AND relevance_score >= {STORED_RELEVANCE} THEN 'RELEVANT' ELSE 'IRRELEVANT' END AS relevant_status FROM (
        SELECT c.*, exp(-pow(c.text_length - 300, 2) / 80000.0) AS text_length_score,
        CASE WHEN c.rating IN (1, 5) THEN 1 ELSE 0 END AS is_extreme_rating, (n.compound + 1) / 2 AS keyword_score,
        100 * (0.30E0 * exp(-pow(c.text_length - 300, 2) / 80000.0) + 0.20E0 * c.has_image + 0.10E0 * c.has_orders
          + 0.15E0 * (CASE WHEN c.rating IN (1, 5) THEN 1 ELSE 0 END) + 0.25E0 * (n.compound + 1) / 2) AS relevance_score,
        k.category_review, k.confidence_score FROM f_clean c JOIN f_sentiment n ON c.review_id = n.review_id
        LEFT JOIN f_review_class k ON c.review_id = k.review_id) s""",
    "f_cart": """SELECT o_orderkey AS cart_id, CAST(o_custkey AS VARCHAR) AS buyer_id,
        CAST(CASE WHEN o_orderkey % 71 = 0 THEN -1 ELSE o_orderkey % 9 END AS INT) AS total_qty, o_totalprice AS total_price FROM orders""",
    "f_cart_items": """SELECT cart_id, p_id, CAST(sum(l_quantity) AS INT) AS qty FROM (SELECT l_orderkey AS cart_id, l_quantity,
        CASE WHEN l_partkey % 50 = 7 OR l_orderkey % 40 = 3 THEN 'X' || l_partkey ELSE CAST(l_partkey AS VARCHAR) END AS p_id FROM lineitem) q
        GROUP BY cart_id, p_id""",
    "f_lines": """SELECT cart_id, p_id, qty, price, price IS NOT NULL AS known FROM f_cart_items LEFT JOIN (SELECT p_id, price FROM f_product) goods USING (p_id)""",
    "f_daily_deals": f"""SELECT CAST(p_partkey AS VARCHAR) AS p_id, DATE '{DEAL_DAY}' AS deal_date, CAST(p_partkey % 30 AS DOUBLE) AS discount
        FROM part WHERE p_size <= 25 UNION ALL SELECT CAST(p_partkey AS VARCHAR), DATE '2024-01-16', 5.0 FROM part""",
    "f_buyer": "SELECT CAST(c_custkey AS VARCHAR) AS buyer_id FROM customer",
    "f_customer": """SELECT CAST(c_custkey AS VARCHAR) AS c_id, c_name AS fname, c_mktsegment AS lname, c_name AS email,
        CAST(c_acctbal AS VARCHAR) AS phone, md5(c_name) AS pwd FROM customer""",
    "f_seller": "SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, s_name AS seller_type FROM supplier",
    "f_seller_products": "SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS seller_id, CAST(l_partkey AS VARCHAR) AS p_id FROM lineitem",
    "f_carrier": "SELECT r_regionkey AS carrier_id, r_name AS carrier_name FROM region",
    "f_shipment": """SELECT l_orderkey * 10 + l_linenumber AS shipping_id, l_orderkey AS order_id, CAST(l_partkey AS VARCHAR) AS p_id,
        CAST(l_linenumber % 6 AS INT) AS carrier_id, CASE WHEN l_linestatus = 'O' THEN 'NP' ELSE 'PP' END AS shipment_type,
        l_returnflag AS status, CAST(l_shipdate AS DATE) AS est_delivery_date FROM lineitem""",
    "f_returns": """SELECT l_orderkey * 10 + l_linenumber AS return_id, CAST(l_suppkey * 40 AS VARCHAR) AS buyer_id,
        CAST(l_partkey AS VARCHAR) AS p_id, l_orderkey AS order_id
        FROM lineitem WHERE l_returnflag = 'R'""",
    "f_wishlist_item": """SELECT DISTINCT CAST(event_id % (SELECT count(*) + 20 FROM part) AS VARCHAR) AS product_id,
        CAST(user_id AS VARCHAR) AS buyer_id FROM events""",
    "f_customer_payment": """SELECT CAST(c_custkey * 2 + c_custkey % 11 % 2 AS INT) AS payment_id,
        CAST(c_custkey + CASE WHEN c_custkey % 97 = 0 THEN 1000000 ELSE 0 END AS VARCHAR) AS c_id,
        CASE WHEN c_custkey % 50 = 0 THEN 'X' ELSE CAST(c_custkey % 2 AS VARCHAR) END AS is_default FROM customer""",
    "f_customer_shipping": """SELECT CAST(c_custkey + CASE WHEN c_custkey % 89 = 0 THEN 1000000 ELSE 0 END AS INT) AS address_id,
        CAST(c_custkey AS VARCHAR) AS c_id, CASE WHEN c_custkey % 60 = 0 THEN NULL WHEN c_custkey % 61 = 0 THEN '10'
        ELSE CAST(c_custkey % 2 AS VARCHAR) END AS is_default FROM customer""",
    "f_discount": """SELECT n_nationkey AS discount_id, repeat(n_name, n_regionkey + 1) AS discount_name, n_name AS d_desc,
        CAST(n_regionkey - 1 AS DOUBLE) AS discount_amt FROM nation""",
    "f_payment_details": """SELECT CAST(c_custkey * 2 AS INT) AS payment_id, CASE WHEN c_custkey % 101 = 0 THEN NULL ELSE c_custkey * 1000003 END AS card_no,
        CAST(c_custkey % 1000 AS SMALLINT) AS cvv, DATE '2026-01-01' + CAST(c_custkey % 900 AS INT) AS expiry_date,
        c_mktsegment || ', ' || c_name AS billing_address FROM customer""",
    "f_product_images": """SELECT CAST(p_partkey + CASE WHEN p_partkey % 83 = 0 THEN 1000000 ELSE 0 END AS VARCHAR) AS p_id,
        p_name || '.jpg' AS p_image FROM part""",
    "f_seller_reviews": "SELECT CAST(doc_id % (SELECT count(*) + 5 FROM supplier) AS VARCHAR) AS seller_id, doc_id AS review_id FROM documents",
    "f_shipping_details": """SELECT CAST(c_custkey AS INT) AS address_id, c_name AS street_address, c_mktsegment AS city,
        CAST(c_nationkey AS VARCHAR) AS state, CAST(c_custkey * 997 AS VARCHAR) AS zip, 'FR' AS country, CAST(c_acctbal AS VARCHAR) AS phone FROM customer""",
    "f_subscription": """SELECT CAST(o_orderkey AS INT) AS subscription_id, CAST(o_custkey + o_orderkey % 3 AS VARCHAR) AS c_id,
        CAST(o_orderdate AS DATE) AS start_date, CASE WHEN o_orderkey % 45 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 365 END AS end_date FROM orders""",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the views it uses, directly or through others, in order."""
    views = {**VIEWS, **(extra or {})}
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name in views:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(views[name])
    ordered = [n for n in views if n in needed]
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({views[n]})" for n in ordered) + "\n" + body


def keyword_counts(text: str) -> list[str]:
    """Hits per topic as SQL expressions."""
    words = f"list_transform(string_split_regex(lower({text}), '\\s+'), lambda w: trim(w, '{_PUNCT}'))"
    return [f"len(list_filter({words}, lambda w: w IN ({_words(ws)})))" for ws in CORPUS_KEYWORDS.values()]
