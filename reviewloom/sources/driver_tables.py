"""Review-shaped source tables derived from the given star-schema tables.

Each derived row comes from a given row; defects (missing ids, ratings out of range,
blank texts, unknown products, buyers without orders, carts without lines) are set
on whole tables, none of which is cut down.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sentiment import Lexicon

BASE = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)
DEAL_DAY = "2024-01-15"
# Thresholds of the stored scores: low enough for products with more relevant reviews than the reports show.
STORED_CONFIDENCE, STORED_RELEVANCE = 50.0, 15.0

# The given texts are invented prose, so scoring them needs words that occur in it.
CORPUS_LEXICON = Lexicon(
    valence={
        "the": 0.3, "that": 0.9, "this": 1.4, "from": -0.7, "was": -1.1, "with": 0.5, "la": 0.4, "des": -0.6,
        "que": 0.8, "der": -0.4, "und": 0.7, "die": -0.5, "el": 1.2, "les": -0.9, "best": 3.0, "for": -0.2,
    },
    raising=frozenset({"of", "er", "en", "le"}),
    lowering=frozenset({"to", "on", "de"}),
    negating=frozenset({"no", "nicht", "pas", "by"}),
    contrast="are",
)
CORPUS_KEYWORDS = {
    "product quality or satisfaction": ("the", "la", "der", "el"),
    "product defect or damaged item": ("of", "de", "und", "von"),
    "delivery issue or shipping delay": ("and", "en", "die", "les"),
    "customer service or support": ("to", "que", "den", "des"),
}


class BaseTables(Mapping[str, DataFrame]):
    """The given tables of a folder, each opened at first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
        return self._open[name]

    def __iter__(self) -> Iterator[str]:
        return iter(BASE)

    def __len__(self) -> int:
        return len(BASE)


def _rows(df: DataFrame) -> int:
    """Rows of a given table, from the file footers."""
    return df.count()


def _text(column: Column) -> Column:
    return column.cast("string")


def review(base) -> DataFrame:
    d = F.col("doc_id")
    buyers = _rows(base["customer"])
    return base["documents"].select(
        F.when(d % 97 == 96, None).otherwise(d).alias("review_id"),
        F.when(d % 59 == 0, None).otherwise(_text((d * 13) % (buyers + buyers // 2))).alias("buyer_id"),
        F.when(d % 47 == 0, None).when(d % 53 == 0, "   ").otherwise(F.col("text")).alias("r_desc"),
        F.when(d % 29 == 0, None).otherwise(F.concat_ws(" ", "source", "lang")).alias("title"),
        F.when(d % 41 == 0, None).when(d % 37 == 0, 0).when(d % 43 == 0, 6).otherwise(1 + d % 5)
        .cast("int").alias("rating"),
        F.lit("P").alias("seller_product_flag"),
    )


def product(base) -> DataFrame:
    k = F.col("p_partkey")
    return base["part"].select(
        _text(k).alias("p_id"), "p_name", F.col("p_type").alias("p_desc"), F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("qty"), F.when(k % 50 == 0, None).otherwise(k % 27).cast("int").alias("category_id"),
    )


def category(base) -> DataFrame:
    return base["nation"].select(
        F.col("n_nationkey").alias("category_id"), F.col("n_name").alias("name"),
        F.repeat(F.col("n_name"), F.col("n_regionkey")).alias("c_desc"),
    )


def product_reviews(base) -> DataFrame:
    parts = _rows(base["part"])
    # English texts go to twenty popular products, one per source.
    spread = _text((F.col("doc_id") * 11) % (parts + 20))
    first = base["documents"].select(
        F.when(F.col("lang") == "en", F.expr("substring(source, 4)")).otherwise(spread).alias("p_id"),
        F.col("doc_id").alias("review_id"),
    )
    second = base["labels"].where(F.col("toxic") == 1).select(
        _text((F.col("doc_id") * 11 + 1) % (parts + 20)).alias("p_id"), F.col("doc_id").alias("review_id")
    )
    return first.unionByName(second)


def review_images(base) -> DataFrame:
    review_id = (F.col("page_id") * 3).alias("review_id")
    pages = base["pages"]
    more = pages.where(F.col("url").startswith("https")).select(review_id, F.concat("url", F.lit("?v=2")).alias("review_img"))
    return pages.select(review_id, F.col("url").alias("review_img")).unionByName(more)


def orders(base) -> DataFrame:
    return base["orders"].select(
        F.col("o_orderkey").alias("order_id"), _text(F.col("o_custkey")).alias("buyer_id"),
        F.when(F.col("o_orderkey") % 3 == 0, (F.col("o_orderkey") % 30).cast("int")).alias("discount_id"),
        (F.col("o_custkey") * 2 + F.col("o_orderkey") % 5 % 2).cast("int").alias("payment_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


def review_class(base) -> DataFrame:
    d = F.col("doc_id")
    topic = (
        F.when(d % 4 == 0, "product quality or satisfaction").when(d % 4 == 1, "product defect or damaged item")
        .when(d % 4 == 2, "delivery issue or shipping delay").otherwise("customer service or support")
    )
    confidence = (40 + (d * 37) % 61).cast("double")
    return base["documents"].select(
        d.alias("review_id"), topic.alias("category_review"), confidence.alias("confidence_score")
    )


def cart(base) -> DataFrame:
    return base["orders"].select(
        F.col("o_orderkey").alias("cart_id"), _text(F.col("o_custkey")).alias("buyer_id"),
        F.when(F.col("o_orderkey") % 71 == 0, -1).otherwise(F.col("o_orderkey") % 9).cast("int").alias("total_qty"),
        F.col("o_totalprice").alias("total_price"),
    )


def cart_items(base) -> DataFrame:
    # One part in fifty is no longer sold; a cart in forty holds nothing else.
    gone = (F.col("l_partkey") % 50 == 7) | (F.col("l_orderkey") % 40 == 3)
    sold = F.when(gone, F.concat(F.lit("X"), _text(F.col("l_partkey")))).otherwise(_text(F.col("l_partkey")))
    return (
        base["lineitem"].groupBy(F.col("l_orderkey").alias("cart_id"), sold.alias("p_id"))
        .agg(F.sum("l_quantity").cast("int").alias("qty"))
    )


def daily_deals(base) -> DataFrame:
    k = F.col("p_partkey")
    part = base["part"]
    today = part.where(F.col("p_size") <= 25).select(
        _text(k).alias("p_id"), F.lit(DEAL_DAY).cast("date").alias("deal_date"), (k % 30).cast("double").alias("discount")
    )
    later = part.select(
        _text(k).alias("p_id"), F.lit("2024-01-16").cast("date").alias("deal_date"), F.lit(5.0).alias("discount")
    )
    return today.unionByName(later)


def buyer(base) -> DataFrame:
    return base["customer"].select(_text(F.col("c_custkey")).alias("buyer_id"))


def customer(base) -> DataFrame:
    return base["customer"].select(
        _text(F.col("c_custkey")).alias("c_id"), F.col("c_name").alias("fname"), F.col("c_mktsegment").alias("lname"),
        F.col("c_name").alias("email"), _text(F.col("c_acctbal")).alias("phone"), F.md5("c_name").alias("pwd"),
    )


def seller(base) -> DataFrame:
    return base["supplier"].select(_text(F.col("s_suppkey")).alias("seller_id"), F.col("s_name").alias("seller_type"))


def seller_products(base) -> DataFrame:
    return base["lineitem"].select(
        _text(F.col("l_suppkey")).alias("seller_id"), _text(F.col("l_partkey")).alias("p_id")
    ).distinct()


def carrier(base) -> DataFrame:
    return base["region"].select(F.col("r_regionkey").alias("carrier_id"), F.col("r_name").alias("carrier_name"))


def shipment(base) -> DataFrame:
    return base["lineitem"].select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("shipping_id"), F.col("l_orderkey").alias("order_id"),
        _text(F.col("l_partkey")).alias("p_id"), (F.col("l_linenumber") % 6).cast("int").alias("carrier_id"),
        F.when(F.col("l_linestatus") == "O", "NP").otherwise("PP").alias("shipment_type"),
        F.col("l_returnflag").alias("status"), F.col("l_shipdate").cast("date").alias("est_delivery_date"),
    )


def returns(base) -> DataFrame:
    return base["lineitem"].where(F.col("l_returnflag") == "R").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("return_id"),
        _text(F.col("l_suppkey") * 40).alias("buyer_id"), _text(F.col("l_partkey")).alias("p_id"), F.col("l_orderkey").alias("order_id"),
    )


def wishlist_item(base) -> DataFrame:
    return base["events"].select(
        _text(F.col("event_id") % (_rows(base["part"]) + 20)).alias("product_id"), _text(F.col("user_id")).alias("buyer_id")
    ).distinct()


def customer_payment(base) -> DataFrame:
    c = F.col("c_custkey")
    return base["customer"].select(
        (c * 2 + c % 11 % 2).cast("int").alias("payment_id"), _text(c + F.when(c % 97 == 0, 1_000_000).otherwise(0)).alias("c_id"),
        F.when(c % 50 == 0, "X").otherwise(_text(c % 2)).alias("is_default"),
    )


def customer_shipping(base) -> DataFrame:
    c = F.col("c_custkey")
    return base["customer"].select(
        (c + F.when(c % 89 == 0, 1_000_000).otherwise(0)).cast("int").alias("address_id"), _text(c).alias("c_id"),
        F.when(c % 60 == 0, None).when(c % 61 == 0, "10").otherwise(_text(c % 2)).alias("is_default"),
    )


def discount(base) -> DataFrame:
    n = base["nation"]
    return n.select(
        F.col("n_nationkey").alias("discount_id"), F.repeat("n_name", F.col("n_regionkey") + 1).alias("discount_name"),
        F.col("n_name").alias("d_desc"), (F.col("n_regionkey") - 1).cast("double").alias("discount_amt"),
    )


def payment_details(base) -> DataFrame:
    c = F.col("c_custkey")
    return base["customer"].select(
        (c * 2).cast("int").alias("payment_id"), F.when(c % 101 == 0, None).otherwise(c * 1_000_003).alias("card_no"),
        (c % 1000).cast("smallint").alias("cvv"), F.date_add(F.lit("2026-01-01").cast("date"), (c % 900).cast("int")).alias("expiry_date"),
        F.concat_ws(", ", "c_mktsegment", "c_name").alias("billing_address"),
    )


def product_images(base) -> DataFrame:
    k = F.col("p_partkey")
    known = _text(k + F.when(k % 83 == 0, 1_000_000).otherwise(0)).alias("p_id")
    return base["part"].select(known, F.concat(F.col("p_name"), F.lit(".jpg")).alias("p_image"))


def seller_reviews(base) -> DataFrame:
    d = F.col("doc_id")
    sellers = _rows(base["supplier"])
    return base["documents"].select(_text(d % (sellers + 5)).alias("seller_id"), d.alias("review_id"))


def shipping_details(base) -> DataFrame:
    return base["customer"].select(
        F.col("c_custkey").cast("int").alias("address_id"), F.col("c_name").alias("street_address"),
        F.col("c_mktsegment").alias("city"), _text(F.col("c_nationkey")).alias("state"), _text(F.col("c_custkey") * 997).alias("zip"),
        F.lit("FR").alias("country"), _text(F.col("c_acctbal")).alias("phone"),
    )


def subscription(base) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return base["orders"].select(
        F.col("o_orderkey").cast("int").alias("subscription_id"), _text(F.col("o_custkey") + F.col("o_orderkey") % 3).alias("c_id"),
        day.alias("start_date"), F.when(F.col("o_orderkey") % 45 == 0, None).otherwise(F.date_add(day, 365)).alias("end_date"),
    )


BUILDERS = {
    f.__name__: f
    for f in (
        review, product, category, product_reviews, review_images, orders, cart, cart_items, daily_deals, buyer,
        customer, seller, seller_products, carrier, shipment, returns, wishlist_item, customer_payment,
        customer_shipping, discount, payment_details, product_images, seller_reviews, shipping_details, subscription,
    )
}


def source_tables(spark: SparkSession, folder: str, names: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    base = BaseTables(spark, folder)
    return {n: BUILDERS[n](base) for n in (names or tuple(BUILDERS))}
