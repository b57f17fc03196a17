"""Expectations on small frames, carts, deals and checkout against plain Python."""

import datetime
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import kpi, quality, serve, shop
from reviewloom.schemas import schema_of


def passed(df):
    return {r["name"]: (r["passed"], r["failed"], r["checked"]) for r in df.collect()}


def test_expectations(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 0, " "), (None, None, None)], "id bigint, rating int, text string")
    empty = df.limit(0)
    assert passed(quality.expect_rows(df))["not_empty"][0] and not passed(quality.expect_rows(empty))["not_empty"][0]
    assert passed(quality.expect_between(df, "rating", 1, 5))["rating_range"] == (False, 1, 3)
    assert passed(quality.expect_unique(df, ["id"]))["id_unique"] == (False, 2, 3)
    assert passed(quality.expect_not_null(df, ["id", "rating"])) == {
        "id_not_null": (False, 1, 3), "rating_not_null": (False, 1, 3),
    }
    assert passed(quality.expect_text(df, "text"))["text_not_empty"] == (False, 2, 3)
    assert passed(quality.expect_text(df, "text", 70))["text_not_empty"][0]
    assert passed(quality.expect_text(empty, "text"))["text_not_empty"][0]
    assert passed(quality.expect_type(df, "id", "bigint"))["id_type"][0]
    assert not passed(quality.expect_type(df, "id", "string"))["id_type"][0]


def test_references(spark):
    child = spark.createDataFrame([("a",), ("a",), ("z",), ("z",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",), (None,)], "p string")
    found = quality.references(child, "k", parent, "p").first()
    assert (found["keys"], found["orphan_keys"], found["orphan_rows"], found["valid_pct"]) == (2, 1, 2, 50.0)
    nothing = quality.references(child.limit(0), "k", parent, "p").first()
    assert nothing["valid_pct"] == 100.0


def test_constraints_on_broken_tables(spark):
    make = spark.createDataFrame
    tables = {
        "review": make([(1, "B", "x" * 20001, "t", 6, "Q"), (1, None, None, None, None, None)], schema_of("review")),
        "customer": make(
            [("c1", "f", "l", "1", "e", "p"), ("c2", "f", "l", "1", None, "p"), (None, "f", "l", None, None, "p")],
            schema_of("customer"),
        ),
        "cart": make([(1, "B", -1, None)], schema_of("cart")),
    }
    checks = {(r["table_name"], r["rule"]): r["violations"] for r in quality.check_violations(tables).collect()}
    assert checks == {("review", "rating"): 1, ("review", "seller_product_flag"): 1, ("cart", "total_qty"): 1}
    keys = {(r["table_name"], r["columns"]): (r["repeated_keys"], r["null_rows"]) for r in quality.key_violations(tables).collect()}
    assert keys[("review", "review_id")] == (1, 0) and keys[("customer", "c_id")] == (0, 1)
    assert keys[("customer", "phone")] == (1, 0) and keys[("customer", "email")] == (0, 0)
    lengths = {(r["table_name"], r["rule"]): r["violations"] for r in quality.length_violations(tables).collect()}
    assert lengths[("review", "r_desc(20000)")] == 1 and sum(lengths.values()) == 1
    required = {(r["table_name"], r["rule"]): r["violations"] for r in quality.required_violations(tables).collect()}
    assert required == {("cart", "total_qty"): 0, ("cart", "total_price"): 1}


def test_empty_source_statistics(spark):
    row = quality.rejection_statistics(spark.createDataFrame([], schema_of("review"))).first()
    assert row["total_reviews"] == 0 and row["rejection_rate"] == 0.0
    assert quality.rejection_report(spark.createDataFrame([], schema_of("review"))).collect() == []


@pytest.fixture(scope="module")
def shop_data(spark):
    rng = random.Random(11)
    products = {f"p{i}": round(rng.uniform(1, 50), 2) for i in range(8)}
    items = {}
    for cart in range(12):
        for p in rng.sample(sorted(products), rng.randint(0, 5)):
            items[(cart, p)] = rng.randint(1, 4)
    for cart in range(12):
        items[(cart, "p0")] = 2  # in every cart
    del items[(11, "p0")]
    items = {k: v for k, v in items.items() if k[0] != 11}
    deals = {p: float(rng.randint(0, 60)) for p in ("p0", "p3", "p5")}
    day = datetime.date(2024, 1, 15)
    make = spark.createDataFrame
    return (
        products, items, deals, day,
        make([(c, f"B{c}", 0, 0.0) for c in range(12)], schema_of("cart")),
        make([(c, p, q) for (c, p), q in items.items()], schema_of("cart_items")),
        make([(p, p, None, price, 1, None) for p, price in products.items()], schema_of("product")),
        make(
            [(p, day, d) for p, d in deals.items()] + [("p1", day + datetime.timedelta(days=1), 90.0)],
            schema_of("daily_deals"),
        ),
    )


@pytest.mark.parametrize("hot_rows", [2, 10**6])
@pytest.mark.parametrize("floor", [0.0, 60.0])
def test_deals(shop_data, hot_rows, floor):
    products, items, deals, day, _cart, cart_items, product, daily_deals = shop_data
    found = {r["cart_id"]: r for r in shop.deal_totals(cart_items, product, daily_deals, day, floor, hot_rows=hot_rows).collect()}
    for cart in {c for c, _ in items}:
        total = sum(products[p] * q for (c, p), q in items.items() if c == cart)
        assert found[cart]["total_before"] == pytest.approx(total)
        for (c, p), q in items.items():  # one item after the other
            if c == cart:
                total = max(floor, total - sum(deals.get(p, 0.0) / 100 * products[p] for _ in range(q)))
        assert found[cart]["total_after"] == pytest.approx(max(floor, total))
    totals = {r["cart_id"]: r["total_price"] for r in shop.cart_totals(cart_items, product, hot_rows).collect()}
    assert totals == {c: pytest.approx(found[c]["total_before"]) for c in totals}


@pytest.mark.parametrize("hot_rows", [2, 10**6])
def test_checkout(spark, shop_data, hot_rows):
    products, items, _, day, cart, cart_items, product, _ = shop_data
    done = shop.checkout(cart, cart_items, product, F.lit(day), "card", 500, hot_rows)
    lines = sorted((r["order_id"] - 500, r["p_id"], r["qty"], r["price_at_purchase"]) for r in done.order_items.collect())
    assert lines == sorted((c, p, q, products[p]) for (c, p), q in items.items())
    sent = done.shipments.collect()
    assert len(sent) == len(items) == len({r["shipping_id"] for r in sent})
    assert {r["est_delivery_date"] for r in sent} == {day + datetime.timedelta(days=7)}
    full = {c for c, _ in items}
    assert {r["order_id"] - 500 for r in done.orders.collect()} == full
    paid = done.payments.collect()
    assert len({r["payment_id"] for r in paid}) == len(full) and {r["status"] for r in paid} == {"completed"}
    assert {r["cart_id"] for r in done.rejected.collect()} == {11}
    assert {(r["total_qty"], r["total_price"]) for r in done.carts.collect()} == {(0, 0.0)}

    documents = shop.order_documents(done.orders, done.order_items, done.payments, done.shipments, hot_rows).collect()
    assert sorted((d["order_id"] - 500, i["p_id"]) for d in documents for i in d["items"] or []) == sorted(items)
    assert sorted((d["order_id"] - 500, i["p_id"]) for d in documents for i in d["shipments"] or []) == sorted(items)
    together = shop.checkout_documents(done, hot_rows).collect()
    assert sorted(map(repr, together)) == sorted(map(repr, documents))
    carts = shop.cart_documents(cart, cart_items, hot_rows).collect()
    assert sorted((d["cart_id"], i["p_id"], i["qty"]) for d in carts for i in d["items"]) == sorted((c, p, q) for (c, p), q in items.items())
    assert [d["items"] for d in carts if d["cart_id"] == 11] == [[]]


@pytest.mark.parametrize("hot_rows", [2, 10**6])
def test_lines_of_unknown_products_are_rejected(spark, shop_data, hot_rows):
    products, items, deals, day, cart, cart_items, product, daily_deals = shop_data
    odd = spark.createDataFrame([(0, "gone", 2), (11, "gone", 1), (99, "p0", 1)], schema_of("cart_items"))
    lines = cart_items.unionByName(odd)
    done = shop.checkout(cart, lines, product, F.lit(day), "card", 500, hot_rows)
    ordered = sorted((r["order_id"] - 500, r["p_id"]) for r in done.order_items.collect())
    refused = sorted((r["cart_id"], r["p_id"], r["error_details"]) for r in done.rejected_lines.collect())
    assert ordered == sorted(items) == sorted((r["order_id"] - 500, r["p_id"]) for r in done.shipments.collect())
    unknown = shop.UNKNOWN_PRODUCT
    assert refused == [(0, "gone", unknown), (11, "gone", unknown), (99, "p0", "Cart is empty or does not exist")]
    assert len(ordered) + len(refused) == lines.count()
    assert [(r["cart_id"], r["error_details"]) for r in done.rejected.collect()] == [(11, "Cart has nothing to order")]
    totals = {r["cart_id"]: r for r in shop.cart_totals(lines, product, hot_rows).collect()}
    assert (totals[11]["total_qty"], totals[11]["total_price"], totals[11]["rejected_lines"]) == (0, 0.0, 1)
    assert totals[0]["rejected_lines"] == 1 and totals[0]["total_qty"] == sum(q for (c, _), q in items.items() if c == 0)
    assert sorted(r["cart_id"] for r in shop.rejected_lines(lines, product, hot_rows).collect()) == [0, 11]
    assert len(shop.deal_totals(lines, product, daily_deals, day, hot_rows=hot_rows).collect()) == len(totals)


@pytest.mark.parametrize("partitions", [2, 7])
def test_parts_of_an_order_are_whole(spark, shop_data, partitions):
    _, items, _, day, cart, cart_items, product, _ = shop_data
    done = shop.checkout(cart, cart_items.repartition(partitions), product, F.lit(day))
    documents = shop.order_documents(done.orders, done.order_items, done.payments, done.shipments, 2).collect()
    for d in documents:
        assert [i["p_id"] for i in d["items"]] == [s["p_id"] for s in d["shipments"]]
    assert sum(len(d["items"]) for d in documents) == len(items)


def test_upsert(spark, shop_data):
    _, items, _, _, _, cart_items, _, _ = shop_data
    added = [(0, "p0", 3), (0, "p0", 1), (11, "p7", 2)]
    found = {(r["cart_id"], r["p_id"]): r["qty"] for r in shop.upsert_cart_items(cart_items, spark.createDataFrame(added, schema_of("cart_items"))).collect()}
    want = defaultdict(int, items)
    for c, p, q in added:
        want[(c, p)] += q
    assert found == dict(want)


def test_views_and_null_confidence(spark):
    rows = [(1, "B", "p", "n", "c", "t", "d", 5, 10, True, False, "i.png", datetime.datetime(2024, 1, 1), "1.0.0")]
    columns = (
        "review_id bigint, buyer_id string, p_id string, product_name string, category string, title string, description string, "
        "rating int, text_length int, has_image boolean, has_orders boolean, review_img string, ingestion_timestamp timestamp_ntz, pipeline_version string"
    )
    reviews = spark.createDataFrame(rows, columns)
    kpi.create_views(reviews)
    assert spark.table("vw_reviews_by_product").first()["reviews_with_images"] == 1
    assert spark.table("vw_reviews_by_category").first()["unique_products"] == 1
    assert kpi.reviews_by_category(reviews, approximate=True).first()["unique_products"] == 1
    assert spark.table("vw_data_quality").first()["pct_with_images"] == 100.0
    scored = reviews.withColumns({"relevant_status": F.lit("RELEVANT"), "confidence_score": F.lit(None).cast("double")})
    assert serve.reviews_by_confidence(scored, "p").first()["confidence_score"] == 0.0
