"""Review joins: the six-table join, the prototype sample and image lookups."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import JOINED_COLUMNS
from .skew import HotKeys, first_of_regular, profiles_of, salted_join, split_hot, spread_hash, two_sided_join

# Items that one row of a list holds, about: a list of n items comes in ceil(n / PART_ITEMS) parts.
PART_ITEMS = 100_000


def first_image(review_images: DataFrame) -> DataFrame:
    """One image per review, the smallest; a null image sorts first.

    ``min`` over a struct keeps null-first order and combines map-side, so a review
    with very many images costs one row per map task.
    """
    return (
        review_images.groupBy("review_id")
        .agg(F.min(F.struct("review_img")).alias("_m"))
        .select("review_id", F.col("_m.review_img").alias("review_img"))
    )


def orders_per_buyer(orders: DataFrame) -> DataFrame:
    return orders.groupBy("buyer_id").agg(F.count(F.lit(1)).alias("order_count"))


def product_links(
    tables: Mapping[str, DataFrame], hot: HotKeys, popular: HotKeys, product_id: str | None = None
) -> DataFrame:
    """(review_id, p_id, product_name, category) per link.

    Built from the narrow side first, so that the review text takes no part in the
    shuffle on the product key. A link whose product is unknown keeps null columns. ``hot``: products with many
    links; ``popular``: categories with many products (few hold most, and many products have none).
    """
    links = tables["product_reviews"].select("p_id", "review_id")
    product = tables["product"].select("p_id", F.col("p_name").alias("product_name"), "category_id")
    category = tables["category"].select("category_id", F.col("name").alias("category"))
    if product_id is not None:
        links = links.where(F.col("p_id") == product_id)
        product = product.where(F.col("p_id") == product_id)
    named = salted_join(product, category, popular, spread_hash("p_id")).select(
        "p_id", F.lit(True).alias("_known"), "product_name", "category"
    )
    joined = salted_join(links, named, hot, spread_hash("review_id"))
    return joined.select(
        "review_id", F.when(F.col("_known"), F.col("p_id")).alias("p_id"), "product_name", "category"
    )


def _with_orders_flag(reviews: DataFrame, orders: DataFrame, hot_buyers: HotKeys) -> DataFrame:
    buyers = orders_per_buyer(orders).select("buyer_id", F.lit(1).alias("has_orders"))
    return salted_join(reviews, buyers, hot_buyers, spread_hash("review_id")).withColumn(
        "has_orders", F.coalesce("has_orders", F.lit(0))
    )


def _ordering_buyers(review: DataFrame, orders: DataFrame, hot_buyers: HotKeys) -> DataFrame:
    """(review_id, _buyers): per review id those of its buyers who ordered. Only ids take part; usually one buyer."""
    ids = review.where(F.col("review_id").isNotNull()).select("review_id", "buyer_id")
    known = _with_orders_flag(ids, orders, hot_buyers).where("has_orders = 1")
    return known.groupBy("review_id").agg(F.collect_set("buyer_id").alias("_buyers"))


def _repeated_ids(review: DataFrame) -> DataFrame:
    """(review_id) of several reviews. Only ids take part."""
    return review.groupBy("review_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("review_id")


def _project(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "buyer_id",
        "review_id",
        "title",
        F.col("r_desc").alias("description"),
        "rating",
        "review_img",
        F.length("r_desc").alias("text_length"),
        F.when(F.col("review_img").isNotNull(), 1).otherwise(0).alias("has_image"),
        "has_orders",
        "p_id",
        "product_name",
        "category",
        *more,
    ).select(*JOINED_COLUMNS, *more)


def join_parts(
    tables: Mapping[str, DataFrame], product_id: str | None = None, hot_rows: int | None = None,
    first_by: list[Column] | None = None,
) -> tuple[list[DataFrame], DataFrame | None, HotKeys]:
    """The six-table join in parts: ordinary reviews with and without an id, and hot review ids (if any) with their keys.

    All other sides are first brought to narrow rows per review id. The text of the ordinary part is shuffled by
    review_id once, for all joins, and leaves partitioned by it, so that a window over review_id (see clean.py)
    needs no further shuffle. It passes by the other sides' rows, held in hash tables, and isn't sorted. Reviews without
    an id meet nothing but the orders of their buyer.

    ``first_by``: the order of a review's links. With it, ids of a single review are a part of their own, with ``is_first``
    for the row of the first link (or of none): found among the links, it takes no sort of the texts either.
    """
    review = tables["review"].select("review_id", "buyer_id", "r_desc", "title", "rating")
    known = profiles_of(tables, "review", "product_reviews", "product", hot_rows=hot_rows)
    many_rows, hot_buyers = (known.hot("review", c, hot_rows) for c in ("review_id", "buyer_id"))
    many_links, hot_products = (known.hot("product_reviews", c, hot_rows) for c in ("review_id", "p_id"))
    many_links = many_links.without_null()
    links = product_links(tables, hot_products, known.hot("product", "category_id", hot_rows), product_id)
    images = first_image(tables["review_images"].where(F.col("review_id").isNotNull()))
    how = "left" if product_id is None else "inner"
    keys = many_rows.merge(many_links)

    regular, hot = split_hot(review, keys)
    buyers = _ordering_buyers(regular, tables["orders"], hot_buyers)
    named, unnamed = regular.where(F.col("review_id").isNotNull()), regular.where(F.col("review_id").isNull())
    ordered = F.coalesce(F.array_contains("_buyers", F.col("buyer_id")), F.lit(False)).cast("int")
    # Links of hot ids stay out of the hash tables, which hold few rows per id.
    few_links = split_hot(links.where(F.col("review_id").isNotNull()), keys)[0]

    def met(rows: DataFrame, links: DataFrame, *more: str) -> DataFrame:
        rows = rows.join(links.hint("shuffle_hash"), "review_id", how)
        rows = rows.join(images.hint("shuffle_hash"), "review_id", "left").join(buyers.hint("shuffle_hash"), "review_id", "left")
        return _project(rows.withColumn("has_orders", ordered), *more)

    if first_by is None:
        parts = [met(named, few_links)]
    else:
        repeated = _repeated_ids(named).hint("shuffle_hash")
        single = met(named.join(repeated, "review_id", "left_anti"), first_of_regular(few_links, "review_id", first_by), "is_first")
        single = single.withColumn("is_first", F.coalesce("is_first", F.lit(True)))
        parts = [single, met(named.join(repeated, "review_id", "left_semi"), few_links)]
    if how == "left":
        empty = [F.lit(None).cast("string").alias(c) for c in ("p_id", "product_name", "category", "review_img")]
        parts.append(_project(_with_orders_flag(unnamed, tables["orders"], hot_buyers).select("*", *empty)))
    if hot is None:
        return parts, None, keys

    hot = _with_orders_flag(hot, tables["orders"], hot_buyers)
    hot = two_sided_join(
        hot, links, many_rows, many_links, spread_hash("buyer_id", "title", "r_desc"), spread_hash("p_id"), how
    )
    # one image row per hot review id
    hot_images = images.join(keys.table(images.sparkSession).withColumnRenamed("_hot_key", "review_id"), "review_id", "left_semi")
    return parts, _project(salted_join(hot, hot_images, keys, spread_hash("buyer_id", "title", "p_id"))), keys


def join_reviews(
    tables: Mapping[str, DataFrame], product_id: str | None = None, hot_rows: int | None = None
) -> DataFrame:
    """One row per (review, product): review with first image, product, category and buyer flag."""
    parts, hot, _ = join_parts(tables, product_id, hot_rows)
    return reduce(DataFrame.unionByName, parts if hot is None else [*parts, hot])


def top_products(
    tables: Mapping[str, DataFrame], min_reviews: int = 15, limit: int = 20, hot_rows: int | None = None
) -> DataFrame:
    """Products with most reviews.

    Both sides are counted before they meet and the product is joined to the counts,
    so a product with a third of all reviews is one row by then.
    """
    ratings = tables["review"].groupBy("review_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("rating").alias("_sum"), F.count("rating").alias("_rated")
    )
    links = tables["product_reviews"].select("p_id", "review_id")
    many_links = profiles_of(tables, "product_reviews", hot_rows=hot_rows).hot("product_reviews", "review_id", hot_rows)
    pairs = salted_join(links, ratings, many_links, spread_hash("p_id"), "inner")
    counts = (
        pairs.groupBy("p_id")
        .agg(F.sum("_rows").alias("nb_reviews"), F.sum("_sum").alias("_sum"), F.sum("_rated").alias("_rated"))
        .where(F.col("nb_reviews") >= min_reviews)
    )
    category = tables["category"].select("category_id", F.col("name").alias("category"))
    return (
        counts.join(tables["product"].select("p_id", "p_name", "price", "category_id"), "p_id")
        .join(category, "category_id", "left")
        .select(
            "p_id", "p_name", "price", "category", "nb_reviews",
            F.round(F.col("_sum") / F.col("_rated"), 2).alias("avg_rating"),
        )
        .orderBy(F.desc("nb_reviews"), "p_id")
        .limit(limit)
    )


def review_sample(
    tables: Mapping[str, DataFrame], min_reviews: int = 15, top: int = 10, hot_rows: int | None = None
) -> DataFrame:
    """Distinct reviews of the ``top`` products by review count, with their flags."""
    # at most `top` rows
    chosen = top_products(tables, min_reviews, min(top, 20), hot_rows)
    chosen = F.broadcast(chosen.select("p_id", F.col("p_name").alias("product_name"), "category"))
    links = tables["product_reviews"].join(chosen, "p_id").select("review_id", "p_id", "product_name", "category")
    review = tables["review"].select("review_id", "buyer_id", "title", "r_desc", "rating")
    known = profiles_of(tables, "review", hot_rows=hot_rows)
    hot, hot_buyers = (known.hot("review", c, hot_rows) for c in ("review_id", "buyer_id"))
    spread = spread_hash("buyer_id", "title", "r_desc")
    rows = salted_join(review, links.distinct(), hot, spread, "inner")
    images = tables["review_images"].select("review_id").distinct().withColumn("has_image", F.lit(1))
    rows = salted_join(rows, images, hot, spread)
    rows = _with_orders_flag(rows, tables["orders"], hot_buyers)
    return rows.select(
        "review_id", "buyer_id", "title", F.col("r_desc").alias("description"), "rating",
        F.length("r_desc").alias("text_length"), F.coalesce("has_image", F.lit(0)).alias("has_image"),
        "has_orders", "p_id", "product_name", "category",
    ).distinct()


def reviews_with_images(reviews: DataFrame, review_images: DataFrame, part_rows: int = PART_ITEMS) -> DataFrame:
    """All images of each review in one pass; ``reviews`` has one row per review_id.

    ``images`` is sorted. A review with more than ``part_rows`` images has several rows (``image_part`` 0, 1, ...);
    every other review has part 0 alone, and a review without images has an empty list.
    """
    lists = collect_parts(review_images, "review_id", F.col("review_img"), "images", "image_part", part_rows)
    return (
        reviews.join(lists, "review_id", "left")
        .withColumn("images", F.coalesce("images", F.array().cast("array<string>")))
        .withColumn("image_part", F.coalesce("image_part", F.lit(0)))
    )


def collect_parts(
    df: DataFrame, key: str, value: Column, items: str, part: str, part_rows: int = PART_ITEMS, whole: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Sorted lists of ``value`` per key, of about ``part_rows`` items each; null values are left out.

    A key of n items has ceil(n / part_rows) parts, numbered from 0, of which some may be empty and
    missing. The part of an item follows from the item and its number among equal ones, never from where it
    was read, so the rows are the same for any layout of the input. Items are counted per (key, item) first:
    many equal ones travel as one row, and no task holds a key's items beyond a part. ``whole``: what an item
    stands for, where more follows from it and the key; it decides the part and doesn't travel.
    """
    counted = df.select(key, value.alias("_item")).where(F.col("_item").isNotNull())
    counted = counted.groupBy(key, "_item").agg(F.count(F.lit(1)).alias("_c"))
    sizes = counted.groupBy(F.col(key).alias("_key")).agg(F.ceil(F.sum("_c") / part_rows).alias("_parts"))
    rows = counted.join(sizes, F.col(key).eqNullSafe(F.col("_key")))
    rows = rows.withColumn("_number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_c"))))
    rows = rows.withColumn(part, F.pmod(F.xxhash64(whole(F.col("_item")) if whole else "_item", "_number"), F.col("_parts")).cast("int"))
    return rows.groupBy(key, part).agg(F.sort_array(F.collect_list("_item")).alias(items))
