"""Carts, deals and checkout as set-based jobs over all carts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import estimated_delivery
from ..session import stored
from .joins import PART_ITEMS, collect_parts
from .skew import HotKeys, hot_keys, salted_join, spread_hash

#: Hot products and carts of the cart lines, as ``Profiles`` keep them; worked out from the lines where not given.
LineKeys = Mapping[str, HotKeys]
UNKNOWN_PRODUCT = "Product does not exist"
NO_CART, NOTHING = "Cart is empty or does not exist", "Cart has nothing to order"


def price_items(lines: DataFrame, offers: DataFrame, hot: HotKeys) -> DataFrame:
    """All cart lines with the columns of their product and ``known``; a best-seller's lines are cut into shares.

    The columns of a line whose product is unknown are null, ``known`` is false.
    """
    marked = offers.withColumn("known", F.lit(True))
    met = salted_join(lines.select("cart_id", "p_id", "qty"), marked, hot, spread_hash("cart_id"))
    return met.withColumn("known", F.coalesce("known", F.lit(False)))


def _best_sellers(cart_items: DataFrame, hot_rows: int | None, hot: LineKeys | None) -> HotKeys:
    return (hot or hot_keys(cart_items, ["p_id"], hot_rows))["p_id"]


def rejected_lines(
    cart_items: DataFrame, product: DataFrame, hot_rows: int | None = None, hot: LineKeys | None = None
) -> DataFrame:
    """Cart lines without a known product; they are in no total and no order."""
    priced = price_items(cart_items, product.select("p_id"), _best_sellers(cart_items, hot_rows, hot))
    return priced.where(~F.col("known")).select("cart_id", "p_id", "qty", F.lit(UNKNOWN_PRODUCT).alias("error_details"))


def upsert_cart_items(cart_items: DataFrame, added: DataFrame) -> DataFrame:
    """Add quantities to existing lines, insert the others; several additions to a line add up."""
    columns = ["cart_id", "p_id", "qty"]
    both = cart_items.select(*columns).unionByName(added.select(*columns))
    return both.groupBy("cart_id", "p_id").agg(F.sum("qty").alias("qty"))


def cart_totals(
    cart_items: DataFrame, product: DataFrame, hot_rows: int | None = None, hot: LineKeys | None = None
) -> DataFrame:
    """Totals over the lines with a known product, and how many lines have none (see ``rejected_lines``)."""
    priced = price_items(cart_items, product.select("p_id", "price"), _best_sellers(cart_items, hot_rows, hot))
    zero = F.lit(0)
    return priced.groupBy("cart_id").agg(
        F.coalesce(F.sum(F.when(F.col("known"), F.col("qty"))), zero).alias("total_qty"),
        F.coalesce(F.sum(F.col("price") * F.col("qty")), F.lit(0.0)).alias("total_price"),
        F.count_if(~F.col("known")).alias("rejected_lines"),
    )


def deal_totals(
    cart_items: DataFrame,
    product: DataFrame,
    daily_deals: DataFrame,
    day,
    minimum_price: float = 0.0,
    totals: DataFrame | None = None,
    hot_rows: int | None = None,
    hot: LineKeys | None = None,
) -> DataFrame:
    """Cart totals after the deals of one day, never below the minimum price.

    Deals join the products first (one row per product), so the cart lines are joined
    once. Discounts are not negative, hence flooring the final total equals flooring
    after each line. Lines without a known product count nothing; ``rejected_lines`` has them.
    """
    deals = daily_deals.where(F.col("deal_date") == F.lit(day)).select("p_id", "discount")
    offers = product.select("p_id", "price").join(deals, "p_id", "left").withColumn(
        "discount", F.coalesce("discount", F.lit(0.0))
    )
    lines = price_items(cart_items, offers, _best_sellers(cart_items, hot_rows, hot))
    gross = F.col("price") * F.col("qty")
    per_cart = lines.groupBy("cart_id").agg(
        F.coalesce(F.sum(gross), F.lit(0.0)).alias("gross"),
        F.coalesce(F.sum(gross * F.col("discount") / 100), F.lit(0.0)).alias("discount_total"),
    )
    if totals is not None:
        per_cart = per_cart.join(totals.select("cart_id", "total_price"), "cart_id").withColumn(
            "gross", F.col("total_price")
        )
    return per_cart.select(
        "cart_id", F.col("gross").alias("total_before"), "discount_total",
        F.greatest(F.lit(minimum_price), F.col("gross") - F.col("discount_total")).alias("total_after"),
    )


@dataclass(frozen=True)
class Checkout:
    orders: DataFrame
    order_items: DataFrame
    shipments: DataFrame
    payments: DataFrame
    carts: DataFrame
    rejected: DataFrame
    rejected_lines: DataFrame
    #: (order_id, p_id, item, shipment): each ordered line with what is sent for it.
    lines: DataFrame
    #: Of the orders.
    day: Column


def checkout(
    cart: DataFrame,
    cart_items: DataFrame,
    product: DataFrame,
    day: Column,
    method: str = "card",
    first_order_id: int = 0,
    hot_rows: int | None = None,
    hot: LineKeys | None = None,
) -> Checkout:
    """Order every cart with something to order, all at once.

    A line whose product is unknown is rejected, a cart without any other line is rejected as a whole; items and
    rejected lines together are all lines, and only items are shipped. Everything stays on the cart id, whose
    order id is ``first_order_id`` + cart id, to the end. Ids derive from the cart id, so a repeated task writes the
    same ids: a shipping id is "order-product" (one shipment per line), payment ids are name-based UUIDs of the order.
    """
    hot = hot or hot_keys(cart_items, ["p_id", "cart_id"], hot_rows)
    priced = price_items(cart_items, product.select("p_id", "price"), hot["p_id"])
    known = F.when(F.col("known"), F.col("qty"))
    filled = priced.groupBy("cart_id").agg(F.sum(known).alias("_qty"), F.count(F.lit(1)).alias("_lines"))
    carts = cart.select("cart_id", "buyer_id").join(filled, "cart_id", "left")
    full = F.coalesce(F.col("_qty") > 0, F.lit(False))
    met = salted_join(priced, carts.select("cart_id", full.alias("ordered")), hot["cart_id"], spread_hash("p_id"))
    good = F.col("known") & F.coalesce("ordered", F.lit(False))
    lines = met.where(good)
    order_id = F.col("cart_id") + F.lit(first_order_id)
    orders = carts.where(full).select(
        order_id.alias("order_id"), "buyer_id", F.lit(None).cast("int").alias("discount_id"),
        F.lit(None).cast("int").alias("payment_id"), day.alias("order_date"),
    )
    order_items = lines.select(order_id.alias("order_id"), "p_id", "qty", F.col("price").alias("price_at_purchase"))
    shipments = lines.select(*shipment_columns(order_id, day))
    sent = lines.select(
        order_id.alias("order_id"), "p_id", F.struct("p_id", "qty", F.col("price").alias("price_at_purchase")).alias("item"),
        F.struct(*shipment_columns(order_id, day)).alias("shipment"),
    )
    digest = F.md5(F.concat(F.lit("payment-"), F.col("order_id").cast("string")))
    parts = [F.substring(digest, *p) for p in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    payments = orders.select(
        F.concat_ws("-", *parts).alias("payment_id"), "order_id", F.lit(method).alias("method"),
        F.lit("completed").alias("status"), F.col("order_date").cast("timestamp").alias("created_at"),
    )
    emptied = carts.where(full).select(
        "cart_id", "buyer_id", F.lit(0).alias("total_qty"), F.lit(0.0).alias("total_price")
    )
    why = F.when(F.col("_lines").isNull(), NO_CART).otherwise(NOTHING)
    rejected = carts.where(~full).select("cart_id", "buyer_id", why.alias("error_details"))
    refused = F.when(~F.col("known"), UNKNOWN_PRODUCT).when(F.col("ordered").isNull(), NO_CART).otherwise(NOTHING)
    unknown = met.where(~good).select("cart_id", "p_id", "qty", refused.alias("error_details"))
    return Checkout(orders, order_items, shipments, payments, emptied, rejected, unknown, sent, day)


def shipment_columns(order_id: Column, day: Column, p_id: Column | None = None) -> list[Column]:
    """The shipment of an order line."""
    p_id = F.col("p_id") if p_id is None else p_id
    return [
        F.concat_ws("-", order_id.cast("string"), p_id).alias("shipping_id"), order_id.alias("order_id"), p_id.alias("p_id"),
        F.lit(None).cast("int").alias("carrier_id"), F.lit("NP").alias("shipment_type"), F.lit("processing").alias("status"),
        estimated_delivery(day).alias("est_delivery_date"), F.lit(None).cast("date").alias("actual_delivery_date"),
    ]


#: What a document tells of an item and of a shipment.
ITEM = ("p_id", "qty", "price_at_purchase")
SHIPMENT = ("p_id", "shipping_id", "carrier_id", "shipment_type", "status", "est_delivery_date")


def order_documents(
    orders: DataFrame,
    order_items: DataFrame,
    payments: DataFrame,
    shipments: DataFrame,
    part_rows: int = PART_ITEMS,
) -> DataFrame:
    """Orders with nested items, payment and shipments; an order of more than ``part_rows`` lines comes in several parts.

    An item and its shipment are brought together first and stay in one part.
    """
    sent = shipments.select("order_id", "p_id", F.struct(*SHIPMENT).alias("shipment"))
    both = order_items.select("order_id", "p_id", F.struct(*ITEM).alias("item")).join(sent, ["order_id", "p_id"], "full")
    return _documents(orders, payments, both, part_rows)


def checkout_documents(done: Checkout, part_rows: int = PART_ITEMS) -> DataFrame:
    """``order_documents`` of a checkout: shipments follow from their lines, so lines alone travel and nothing is joined for them.

    The lines are stored, since they are read twice.
    """
    lines = stored(done.lines.select("order_id", *[F.col(f"item.{c}") for c in ITEM]), "ordered-lines")
    sent = lambda x: F.struct(*[F.struct(*shipment_columns(F.col("order_id"), done.day, x["p_id"]))[c].alias(c) for c in SHIPMENT])
    both = lambda x: F.struct(x.alias("item"), sent(x).alias("shipment"))
    items = collect_parts(lines, "order_id", F.struct(*ITEM), "items", "part", part_rows, both)
    return _with_payments(done.orders, done.payments, items).withColumn("shipments", F.transform("items", sent))


def _documents(orders: DataFrame, payments: DataFrame, both: DataFrame, part_rows: int) -> DataFrame:
    lines = collect_parts(both, "order_id", F.struct("item", "shipment"), "lines", "part", part_rows)
    present = lambda name: F.filter(F.transform("lines", lambda x: x[name]), lambda x: x.isNotNull())
    nested = lines.select("order_id", "part", present("item").alias("items"), present("shipment").alias("shipments"))
    return _with_payments(orders, payments, nested)


def _with_payments(orders: DataFrame, payments: DataFrame, nested: DataFrame) -> DataFrame:
    paid = payments.select("order_id", F.struct("payment_id", "method", "status", "created_at").alias("payment"))
    return orders.join(paid, "order_id", "left").join(nested, "order_id", "left").withColumn(
        "part", F.coalesce("part", F.lit(0))
    )


def cart_documents(cart: DataFrame, cart_items: DataFrame, part_rows: int = PART_ITEMS) -> DataFrame:
    """Carts with nested items; an empty cart has an empty list."""
    items = collect_parts(cart_items, "cart_id", F.struct("p_id", "qty"), "items", "part", part_rows)
    empty = F.array().cast(items.schema["items"].dataType)
    return cart.join(items, "cart_id", "left").withColumns(
        {"items": F.coalesce("items", empty), "part": F.coalesce("part", F.lit(0))}
    )
