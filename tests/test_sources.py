"""Readers, writers, extraction and the reviews job, round trip."""

import datetime

import pytest
from pyspark.sql import functions as F

from reviewloom.functions.sentiment import compound
from reviewloom.operators import quality, serve
from reviewloom.plans import jobs
from reviewloom.schemas import COLUMNS, FOREIGN_KEYS, PRIMARY_KEYS, REVIEWS_COLUMNS, schema_of
from reviewloom.sources.snapshots import read_published
from reviewloom.sources import extract, readers, writers

REVIEWS = [
    (1, "B1", 'He said "fine", then\nleft', "a,b", 5, "P"),
    (2, None, "  padded  ", None, 4, "P"),
    (3, "B2", None, "NA", None, "S"),
    (3, "B2", "again", "null", 9, "S"),
]


@pytest.fixture
def tables(spark):
    make = spark.createDataFrame
    return {
        "review": make(REVIEWS, schema_of("review")),
        "product": make([("p1", "Lamp", None, 9.5, 3, 1), ("p2", "Mug", None, 4.0, 0, None)], schema_of("product")),
        "category": make([(1, "Home", None)], schema_of("category")),
        "product_reviews": make([("p1", 1), ("p2", 1), ("p9", 2)], schema_of("product_reviews")),
        "review_images": make([(1, "b.png"), (1, "a.png"), (2, None)], schema_of("review_images")),
        "orders": make([(1, "B1", None, None, datetime.date(2024, 1, 1))] * 2, schema_of("orders")),
        "buyer": make([("B1",)], schema_of("buyer")),
        "carrier": make([(1, "Post")], schema_of("carrier")),
    }


def test_declared_rules_fit_the_schemas(spark):
    assert len(COLUMNS) == len(PRIMARY_KEYS) == 25 and len(FOREIGN_KEYS) == 32
    for table, keys in PRIMARY_KEYS.items():
        assert set(keys) <= set(schema_of(table).names)
    for key in FOREIGN_KEYS:
        assert key.column in schema_of(key.table).names and key.parent_column in schema_of(key.parent).names


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_lake_round_trip(spark, tables, tmp_path, fmt):
    path = writers.write_lake(tables["review"], str(tmp_path / "review"), fmt)
    back = readers.read_lake_table(spark, "review", path, fmt)
    assert back.schema.simpleString() == schema_of("review").simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, tables["review"].collect()))
    writers.write_lake(tables["review"].limit(1), path, fmt)
    assert readers.read_lake_table(spark, "review", path, fmt).count() == 1


def test_csv_nulls(spark, tmp_path):
    (tmp_path / "c.csv").write_text('category_id,name,c_desc\n1,,NULL\n2,null,""\n3,NA,x\n')
    path = str(tmp_path / "c.csv")
    plain = [tuple(r) for r in readers.read_csv(spark, path, schema_of("category")).orderBy("category_id").collect()]
    assert plain == [(1, None, "NULL"), (2, "null", None), (3, "NA", "x")]
    stage = [tuple(r) for r in readers.read_stage_csv(spark, path, schema_of("category")).orderBy("category_id").collect()]
    assert stage == [(1, None, None), (2, None, None), (3, "NA", "x")]


def test_indexed_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_bytes(b",category_id,name,c_desc\r\n0,1,All Beauty,beauty general\r\n1,2,Premium Beauty,beauty premium\r\n")
    found = readers.read_indexed_csv(spark, str(tmp_path / "c.csv"), schema_of("category"))
    assert [tuple(r) for r in found.collect()] == [(1, "All Beauty", "beauty general"), (2, "Premium Beauty", "beauty premium")]


def test_bulk_load(spark, tmp_path):
    (tmp_path / "carrier.csv").write_text("carrier_id,carrier_name\n1,Post\n2,\n")
    (tmp_path / "bad.csv").write_text("carrier_id,carrier_name\nx,Post\n")
    assert extract.bulk_load(spark, {"carrier": str(tmp_path / "carrier.csv")}) == ["carrier"]
    assert spark.table("carrier").count() == 2
    assert "carrier" in [r["tableName"] for r in readers.list_tables(spark).collect()]
    with pytest.raises(Exception):
        extract.bulk_load(spark, {"carrier": str(tmp_path / "bad.csv")})


def test_extraction_isolates_failures(spark, tables, tmp_path):
    def read(table):
        if table == "orders":
            raise ConnectionError("gone")
        return tables[table]

    paths, status = extract.extract_tables(spark, read, str(tmp_path), fmt="csv")
    assert paths["orders"] is None and sum(p is not None for p in paths.values()) == 7
    report = quality.failed_tables(status).first()
    assert (report["failed"], report["total"], report["names"]) == (1, 8, "orders")
    hashed = readers.read_lake_table(spark, "review", paths["review"], "csv").where("review_id = 1").first()["buyer_id"]
    assert hashed == "0885ccd1969a4b52b7c097b24be3fb74467e25cdabad9203f5441b63d293b318"
    assert readers.lake_paths(str(tmp_path))["review"] == paths["review"]

    loaded, status = readers.load_tables(spark, {t: paths[t] for t in readers.JOIN_TABLES}, "csv")
    assert loaded["orders"].count() == 0 and loaded["orders"].columns == schema_of("orders").names
    assert quality.failed_tables(status).first()["names"] == "orders"
    with pytest.raises(FileNotFoundError, match="review"):
        readers.load_tables(spark, {**paths, "review": None}, "csv")


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_reviews_job(spark, tables, tmp_path, hot_rows):
    paths, _ = extract.extract_tables(spark, tables.__getitem__, str(tmp_path / "lake"))
    target = [str(tmp_path / n) for n in ("reviews", "rejected", "runs")]
    lake = {t: paths[t] for t in readers.JOIN_TABLES}
    for _ in range(2):
        statistics = jobs.process(spark, lake, *target, hot_rows=hot_rows)
    # Review 1 has two products, review 3 two copies.
    assert statistics == {
        "total_records_processed": 5, "clean_records": 2, "rejected_records": 3, "warehouse_inserts": 2, "reject_inserts": 3,
    }
    reviews, rejected, runs = (read_published(spark, t) for t in target)
    assert tuple(reviews.columns) == REVIEWS_COLUMNS and reviews.count() == 2
    first = reviews.where("review_id = 1").first()
    assert (first["p_id"], first["review_img"], first["has_image"], first["has_orders"]) == ("p1", "a.png", True, True)
    second = reviews.where("review_id = 2").first()
    assert (second["p_id"], second["category"], second["title"], second["has_image"]) == (None, "Unknown", "", False)
    assert rejected.count() == 6 and rejected.select("run_id").distinct().count() == 2
    assert "original_data" in rejected.columns
    assert runs.count() == 2 and len({str(r["statistics"]) for r in runs.collect()}) == 1
    assert quality.stored_review_checks(reviews).where("not passed").count() == 0
    pairs = {"reviews": (reviews, reviews.limit(1))}
    assert tuple(quality.reconcile(pairs).first()) == ("reviews", 2, 1, 1)


def test_reviews_job_for_one_product(spark, tables, tmp_path):
    target = [str(tmp_path / n) for n in ("reviews", "rejected", "runs")]
    statistics = jobs.process_tables(tables, *target, product_id="p9")
    assert statistics["total_records_processed"] == 1 and statistics["clean_records"] == 1


def test_guards(spark):
    runs = spark.createDataFrame([(200, 1, 199), (200, 2, 0)], "total_records_processed int, rejected_records int, warehouse_inserts int")
    assert [r["status"] for r in quality.rejection_guard(runs).collect()] == ["ok", "warning"]
    assert [r["status"] for r in quality.load_guard(runs).collect()] == ["success", "warning"]


def test_catalog_and_precomputed_scores(spark, tables, tmp_path):
    (tmp_path / "s.csv").write_text("review_id,category_review,confidence_score\n1,x,0.5\n")
    schema = "review_id bigint, category_review string, confidence_score double"
    from pyspark.sql.types import StructType

    scores = readers.read_precomputed_scores(spark, str(tmp_path / "s.csv"), StructType.fromDDL(schema))
    assert scores.first()["confidence_score"] == 50.0
    assert tuple(readers.shape(scores).first()) == (1, 3)
    assert readers.sample_rows(tables["review"], 2).count() == 2 and readers.sample_rows(tables["review"], 9).count() == 4
    (tmp_path / "lex.txt").write_text("plouf\t2.0\t0.5\t[1, 2]\n:)\t1.5\t0.1\t[]\n")
    lexicon = readers.read_lexicon(spark, str(tmp_path / "lex.txt"))
    df = spark.createDataFrame([("plouf :)",), ("good",)], "t string")
    found = [r[0] for r in df.select(compound("t", lexicon)).collect()]
    assert found[0] > 0.6 and found[1] == 0.0
    writers.replace_table(scores, "scored_reviews")
    writers.replace_table(scores, "scored_reviews")
    assert spark.table("scored_reviews").count() == 1


def test_lookups(spark, tables):
    product = tables["product"]
    assert serve.lookup(product, p_id="p1", qty=3).count() == 1
    assert serve.lookup(product, p_id="none").collect() == []
    assert serve.lookup_stripped(product, "p_id", " p1 ").count() == 1
    assert [r["p_id"] for r in serve.page(product, "p_id", 1, 5).collect()] == ["p2"]
    assert serve.missing_columns(product, ["p_id", "brand", "price"]) == ["brand"]
    upper = product.toDF(*[c.upper() for c in product.columns])
    assert serve.lower_names(upper).columns == product.columns
    product.createOrReplaceTempView("shop_product")
    found = serve.run_query(spark, "SELECT p_id FROM shop_product WHERE p_name = :name", name="x' OR '1'='1")
    assert found.collect() == []
    images = spark.createDataFrame([("p1", "x.png"), ("p2", "y.png")], schema_of("product_images"))
    assert [r["p_image"] for r in serve.images_of_product(images, "p1").collect()] == ["x.png"]


def test_null_image_sorts_first(spark):
    from reviewloom.operators.joins import first_image

    images = spark.createDataFrame([(1, None), (1, "a"), (2, "c"), (2, "b")], schema_of("review_images"))
    assert sorted(tuple(r) for r in first_image(images).collect()) == [(1, None), (2, "b")]


def test_jdbc_options():
    whole = readers.relation_options("jdbc:x", "t")
    assert whole == {"url": "jdbc:x", "dbtable": "t"}
    parts = readers.relation_options("jdbc:x", "t", "SELECT 1", "id", (3, 90), 8)
    assert parts["dbtable"] == "(SELECT 1) AS q"
    assert [parts[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == ["id", "3", "90", "8"]


def test_errors_are_told_in_full(spark, tables, tmp_path, monkeypatch):
    paths, _ = extract.extract_tables(spark, tables.__getitem__, str(tmp_path))
    plain = readers.read_lake_table

    def read(spark, table, *rest):
        if table == "orders":
            raise ValueError
        if table == "category":
            raise ValueError("first line\n" + "x" * 900)
        return plain(spark, table, *rest)

    monkeypatch.setattr(readers, "read_lake_table", read)
    _, status = readers.load_tables(spark, {t: paths[t] for t in readers.JOIN_TABLES})
    errors = {r["table_name"]: r["error"] for r in status.collect() if r["error"]}
    assert errors == {"orders": "ValueError", "category": "first line\n" + "x" * 900}


def test_modifier_words_from_files(spark, tmp_path):
    for name, text in (("v", "plouf\t2.0\n"), ("up", "tres\n"), ("no", "pas\n\n")):
        (tmp_path / name).write_text(text)
    lexicon = readers.read_lexicon(spark, str(tmp_path / "v"), raising=str(tmp_path / "up"), negating=str(tmp_path / "no"))
    assert lexicon.raising == {"tres"} and lexicon.negating == {"pas"} and "barely" in lexicon.lowering


def test_staging_is_deleted(spark, tables, tmp_path):
    target = [str(tmp_path / n) for n in ("reviews", "rejected", "runs")]
    jobs.process_tables(tables, *target, staging=str(tmp_path / "staged"))
    assert not (tmp_path / "staged").exists() and (tmp_path / "reviews").exists()


def test_splittable_csv(spark, tables, tmp_path):
    path = writers.write_lake(tables["category"], str(tmp_path / "c"), "csv")
    assert readers.read_lake_table(spark, "category", path, "csv", multiline=False).count() == tables["category"].count()


def test_one_line_csv(spark, tmp_path):
    texts = ["a\nb", "a\\nb", "\\", "\\\\n\r\n", "\r", 'q"\\"', "\\b", "plain", None]
    df = spark.createDataFrame([(i, t, "d") for i, t in enumerate(texts)], schema_of("category"))
    path = writers.write_lake(df.coalesce(1), str(tmp_path / "c"), "csv-lines")
    lines = next((tmp_path / "c").glob("*.csv")).read_text().split("\n")
    assert len([x for x in lines if x]) == len(texts) + 1
    found = readers.read_lake_table(spark, "category", path, "csv-lines")
    assert {r[0]: r[1] for r in found.collect()} == dict(enumerate(texts))


def test_samples_do_not_depend_on_the_layout(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    draws = [sorted(readers.sample_rows(df.repartition(n), 40, seed).collect()) for n in (1, 5) for seed in (1, 2)]
    assert draws[0] == draws[2] != draws[1] == draws[3] and len(draws[0]) == 40


def test_reviews_of_a_pair_are_in_order(spark):
    """Several reviews of one buyer and product, equal scores among them."""
    rows = [(i, "b", "p", s, "RELEVANT" if i % 5 else "IRRELEVANT", True, False, 1, "a.png, b.png", "d") for i, s in enumerate([3.0, None, 9.0, 9.0, 1.0, 7.0, 3.0, 3.0])]
    columns = "review_id long, buyer_id string, p_id string, relevance_score double, relevant_status string, has_image boolean, has_orders boolean, is_extreme_rating int, review_img string, description string"
    found = serve.buyer_product_reviews(spark.createDataFrame(rows, columns).repartition(3), "b", "p").collect()
    assert [r["review_id"] for r in found] == [2, 3, 6, 7, 4, 1] and found[0]["images"] == ["a.png", "b.png"]


def test_bulk_load_of_compressed_files(spark, tmp_path):
    from reviewloom.sources import writers

    df = spark.createDataFrame([(1, 'quick "post"\nand more'), (2, None), (None, "a,b")], "carrier_id int, carrier_name string").coalesce(1)
    path = writers.write_lake(df, str(tmp_path / "carrier"), "csv", "gzip")
    assert [p.name.endswith(".csv.gz") for p in (tmp_path / "carrier").glob("part-*")] == [True]
    spark.sql("CREATE DATABASE IF NOT EXISTS zipped")
    try:
        extract.bulk_load(spark, {"carrier": path}, "zipped")
        assert sorted(map(tuple, spark.table("zipped.carrier").collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    finally:
        spark.sql("DROP DATABASE zipped CASCADE")
