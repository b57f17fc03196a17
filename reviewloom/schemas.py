"""Declared schemas and integrity rules of the source tables.

The names, types, keys, limits and checks below are fixed values: they describe
the relational source and must equal it for the integrity jobs to be right.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- columns per source table (Spark DDL) -----------------------------------
COLUMNS: dict[str, str] = {
    "buyer": "buyer_id string",
    "carrier": "carrier_id int, carrier_name string",
    "cart": "cart_id bigint, buyer_id string, total_qty int, total_price double",
    "cart_items": "cart_id bigint, p_id string, qty int",
    "category": "category_id int, name string, c_desc string",
    "customer": "c_id string, fname string, lname string, phone string, email string, pwd string",
    "customer_payment": "payment_id int, c_id string, is_default string",
    "customer_shipping": "address_id int, c_id string, is_default string",
    "daily_deals": "p_id string, deal_date date, discount double",
    "discount": "discount_id int, discount_name string, d_desc string, discount_amt double",
    "orders": "order_id bigint, buyer_id string, discount_id int, payment_id int, order_date date",
    "payment_details": "payment_id int, card_no bigint, cvv smallint, expiry_date date, billing_address string",
    "product": "p_id string, p_name string, p_desc string, price double, qty int, category_id int",
    "product_images": "p_id string, p_image string",
    "product_reviews": "p_id string, review_id bigint",
    "returns": "return_id bigint, buyer_id string, p_id string, order_id bigint",
    "review": "review_id bigint, buyer_id string, r_desc string, title string, rating int, seller_product_flag string",
    "review_images": "review_id bigint, review_img string",
    "seller": "seller_id string, seller_type string",
    "seller_products": "seller_id string, p_id string",
    "seller_reviews": "seller_id string, review_id bigint",
    "shipment": "shipping_id bigint, order_id bigint, p_id string, carrier_id int, shipment_type string, "
    "status string, est_delivery_date date, actual_delivery_date date",
    "shipping_details": "address_id int, street_address string, city string, state string, zip string, "
    "country string, phone string",
    "subscription": "subscription_id int, c_id string, start_date date, end_date date",
    "wishlist_item": "product_id string, buyer_id string",
}

# --- keys --------------------------------------------------------------------
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "buyer": ("buyer_id",),
    "carrier": ("carrier_id",),
    "cart": ("cart_id",),
    "cart_items": ("cart_id", "p_id"),
    "category": ("category_id",),
    "customer": ("c_id",),
    "customer_payment": ("c_id", "payment_id"),
    "customer_shipping": ("address_id", "c_id"),
    "daily_deals": ("p_id", "deal_date"),
    "discount": ("discount_id",),
    "orders": ("order_id",),
    "payment_details": ("payment_id",),
    "product": ("p_id",),
    "product_images": ("p_id", "p_image"),
    "product_reviews": ("p_id", "review_id"),
    "returns": ("return_id",),
    "review": ("review_id",),
    "review_images": ("review_id", "review_img"),
    "seller": ("seller_id",),
    "seller_products": ("seller_id", "p_id"),
    "seller_reviews": ("seller_id", "review_id"),
    "shipment": ("shipping_id",),
    "shipping_details": ("address_id",),
    "subscription": ("subscription_id",),
    "wishlist_item": ("product_id", "buyer_id"),
}

UNIQUE_KEYS: dict[str, tuple[tuple[str, ...], ...]] = {"customer": (("email",), ("phone",))}


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str
    parent: str
    parent_column: str

    @property
    def name(self) -> str:
        return f"{self.table}.{self.column}->{self.parent}.{self.parent_column}"


FOREIGN_KEYS: tuple[ForeignKey, ...] = (
    ForeignKey("buyer", "buyer_id", "customer", "c_id"),
    ForeignKey("cart", "buyer_id", "buyer", "buyer_id"),
    ForeignKey("cart_items", "cart_id", "cart", "cart_id"),
    ForeignKey("cart_items", "p_id", "product", "p_id"),
    ForeignKey("customer_payment", "c_id", "customer", "c_id"),
    ForeignKey("customer_payment", "payment_id", "payment_details", "payment_id"),
    ForeignKey("customer_shipping", "address_id", "shipping_details", "address_id"),
    ForeignKey("customer_shipping", "c_id", "customer", "c_id"),
    ForeignKey("daily_deals", "p_id", "product", "p_id"),
    ForeignKey("orders", "buyer_id", "buyer", "buyer_id"),
    ForeignKey("orders", "discount_id", "discount", "discount_id"),
    ForeignKey("orders", "payment_id", "payment_details", "payment_id"),
    ForeignKey("product", "category_id", "category", "category_id"),
    ForeignKey("product_images", "p_id", "product", "p_id"),
    ForeignKey("product_reviews", "p_id", "product", "p_id"),
    ForeignKey("product_reviews", "review_id", "review", "review_id"),
    ForeignKey("returns", "buyer_id", "buyer", "buyer_id"),
    ForeignKey("returns", "order_id", "orders", "order_id"),
    ForeignKey("returns", "p_id", "product", "p_id"),
    ForeignKey("review", "buyer_id", "buyer", "buyer_id"),
    ForeignKey("review_images", "review_id", "review", "review_id"),
    ForeignKey("seller", "seller_id", "customer", "c_id"),
    ForeignKey("seller_products", "p_id", "product", "p_id"),
    ForeignKey("seller_products", "seller_id", "seller", "seller_id"),
    ForeignKey("seller_reviews", "review_id", "review", "review_id"),
    ForeignKey("seller_reviews", "seller_id", "seller", "seller_id"),
    ForeignKey("shipment", "carrier_id", "carrier", "carrier_id"),
    ForeignKey("shipment", "order_id", "orders", "order_id"),
    ForeignKey("shipment", "p_id", "product", "p_id"),
    ForeignKey("subscription", "c_id", "customer", "c_id"),
    ForeignKey("wishlist_item", "buyer_id", "buyer", "buyer_id"),
    ForeignKey("wishlist_item", "product_id", "product", "p_id"),
)

# --- row checks: (table, name, SQL predicate); NULL passes, as in SQL ---------
CHECKS: tuple[tuple[str, str, str], ...] = (
    ("cart", "total_qty", "total_qty >= 0"),
    ("cart_items", "qty", "qty >= 0"),
    ("customer_payment", "is_default", "is_default IN ('0', '1')"),
    ("customer_shipping", "is_default", "is_default IN ('0', '1')"),
    ("discount", "discount_amt", "discount_amt >= 0"),
    ("product", "qty", "qty >= 0"),
    ("review", "rating", "rating BETWEEN 1 AND 5"),
    ("review", "seller_product_flag", "seller_product_flag IN ('S', 'P')"),
    ("shipment", "shipment_type", "shipment_type IN ('PP', 'NP')"),
)

# --- columns declared NOT NULL beyond the primary keys -------------------------
REQUIRED: dict[str, tuple[str, ...]] = {
    "cart": ("total_qty", "total_price"),
    "cart_items": ("qty",),
    "daily_deals": ("discount",),
    "discount": ("discount_amt",),
    "orders": ("order_date",),
    "payment_details": ("card_no", "cvv", "expiry_date"),
    "product": ("price", "qty"),
    "subscription": ("start_date", "end_date"),
}

# --- longest text per column ---------------------------------------------------
TEXT_LIMITS: dict[str, dict[str, int]] = {
    "buyer": {"buyer_id": 40},
    "carrier": {"carrier_name": 30},
    "cart": {"buyer_id": 40},
    "cart_items": {"p_id": 10},
    "category": {"name": 30, "c_desc": 20},
    "customer": {"c_id": 40, "fname": 200, "lname": 30, "phone": 10, "email": 250, "pwd": 60},
    "customer_payment": {"c_id": 40, "is_default": 1},
    "customer_shipping": {"c_id": 40, "is_default": 1},
    "daily_deals": {"p_id": 10},
    "discount": {"discount_name": 20, "d_desc": 100},
    "orders": {"buyer_id": 40},
    "payment_details": {"billing_address": 500},
    "product": {"p_id": 10, "p_name": 1000, "p_desc": 5000},
    "product_images": {"p_id": 10, "p_image": 100},
    "product_reviews": {"p_id": 10},
    "returns": {"buyer_id": 40, "p_id": 10},
    "review": {"buyer_id": 40, "r_desc": 20000, "title": 300, "seller_product_flag": 1},
    "review_images": {"review_img": 200},
    "seller": {"seller_id": 40, "seller_type": 100},
    "seller_products": {"seller_id": 40, "p_id": 10},
    "seller_reviews": {"seller_id": 40},
    "shipment": {"p_id": 10, "shipment_type": 2, "status": 10},
    "shipping_details": {
        "street_address": 100, "city": 100, "state": 100, "zip": 10, "country": 60, "phone": 10,
    },
    "subscription": {"c_id": 40},
    "wishlist_item": {"product_id": 10, "buyer_id": 40},
}

# --- tables of the batch pipeline ------------------------------------------------
EXTRACT_TABLES = (
    "product", "category", "buyer", "review", "product_reviews", "review_images", "orders", "carrier",
)
JOIN_TABLES = ("product", "category", "review", "product_reviews", "review_images", "orders")
REQUIRED_TABLES = ("product", "review", "product_reviews")

# --- derived record layouts ------------------------------------------------------
JOINED_COLUMNS = (
    "buyer_id", "review_id", "title", "description", "rating", "review_img",
    "text_length", "has_image", "has_orders", "p_id", "product_name", "category",
)
REVIEWS_COLUMNS = (
    "review_id", "buyer_id", "p_id", "product_name", "category", "title", "description", "rating",
    "text_length", "has_image", "has_orders", "review_img", "ingestion_timestamp", "pipeline_version",
)
SCORING_COLUMNS = (
    "review_id", "buyer_id", "p_id", "product_name", "category", "title", "description", "rating",
    "text_length", "has_image", "has_orders", "review_img",
)
REVIEW_RELEVANT_COLUMNS = (
    "review_id", "buyer_id", "p_id", "product_name", "category", "title", "description", "rating",
    "text_length", "has_image", "has_orders", "text_length_score", "is_extreme_rating",
    "keyword_score", "relevance_score", "category_review", "confidence_score", "review_img",
    "relevant_status",
)

# Reasons the reject store declares, plus the two the cleaning rules also emit.
DECLARED_REASONS = (
    "duplicate_review_id", "missing_required_fields", "invalid_rating",
    "data_quality_issue", "join_failure", "other",
)
KNOWN_REASONS = DECLARED_REASONS + ("empty_description", "missing_buyer_id")


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(COLUMNS[table])
