"""Salted joins equal plain joins, whatever the share of the hottest key."""

import random

import pytest

from reviewloom.operators.joins import collect_parts
from reviewloom.operators.skew import FAIR, Profiles, find_hot, guaranteed, hot_keys, salted_join, spread_hash, two_sided_join
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def sides(spark):
    random.seed(3)
    left = [(random.choice([None, "hot", "hot", "a", "b", "c", "only left"]), i) for i in range(400)]
    right = [("hot", 1), ("a", 2), ("b", 3), ("only right", 4)]
    many = [(random.choice(["hot", "wide", "a", "only right"]), i) for i in range(120)]
    make = spark.createDataFrame
    return (
        make(left, "k string, l int").repartition(5), make(right, "k string, r int"),
        make(many, "k string, r int").repartition(3),
    )


def _rows(df):
    return sorted(map(str, df.select("k", "l", "r").collect()))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_rows", [1, 7, 50, 10**6])
def test_salted_join(sides, how, hot_rows):
    left, right, _ = sides
    hot = find_hot(left, "k", hot_rows)
    assert bool(hot) == (hot_rows < 10**6)
    assert _rows(salted_join(left, right, hot, spread_hash("l"), how)) == _rows(left.join(right, "k", how))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_rows", [1, 7, 20])
def test_two_sided_join(sides, how, hot_rows):
    left, _, many = sides
    hot_left, hot_right = find_hot(left, "k", hot_rows), find_hot(many, "k", hot_rows)
    both = list(hot_left.merge(hot_right).shares)
    keep = F.col("k").isin([k for k in both if k]) | (F.col("k").isNull() & F.lit(None in both))
    part = left.where(keep)
    found = two_sided_join(part, many, hot_left, hot_right, spread_hash("l"), spread_hash("r"), how)
    assert _rows(found) == _rows(part.join(many, "k", how))


@pytest.mark.parametrize("part_rows", [1, 10, 10**6])
def test_collect_parts_keeps_every_item(sides, part_rows):
    _, _, many = sides
    parts = collect_parts(many, "k", F.col("r"), "items", "part", part_rows).collect()
    found = sorted((p["k"], i) for p in parts for i in p["items"])
    assert found == sorted((r["k"], r["r"]) for r in many.collect())
    assert all(p["items"] == sorted(p["items"]) for p in parts)
    if part_rows == 10**6:
        assert all(p["part"] == 0 for p in parts)


def test_hot_keys_of_several_columns_in_one_job(spark):
    df = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 10 == 1, None).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 4 == 1, "often").otherwise(F.col("id").cast("string")).alias("s"),
    )
    group = "hot keys of several columns"
    spark.sparkContext.setJobGroup(group, group)
    found = hot_keys(df, ["k", "s"], 20_000)
    ran = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # One query; the adaptive planner runs its two shuffles as jobs of their own.
    assert len(ran) <= 3
    assert found["k"].shares == {-1: 7, None: 2} and found["s"].shares.keys() == {"often"} and found["s"].shares["often"] in (5, 6)
    assert not find_hot(df, "k", 150_000) and not find_hot(df.where("k = 0"), "k", 1)


@pytest.mark.parametrize("seed", range(3))
def test_every_key_above_the_threshold_is_found(spark, seed):
    """Far more distinct keys than counters, and hot ones of all sizes from the threshold up, in any order of rows."""
    draw = random.Random(seed)
    rows, filler = 0, 1_200_000
    sizes = {}
    for key in range(60):
        sizes[-key - 1] = draw.randint(400, 3_000)
    hot = spark.createDataFrame(list(sizes.items()), "k long, n int").select("k", F.explode(F.sequence(F.lit(1), "n"))).select("k")
    df = spark.range(filler).select(F.col("id").alias("k")).unionAll(hot).repartition(7).sortWithinPartitions(F.xxhash64("k", F.lit(seed)))
    rows = filler + sum(sizes.values())
    least = max(350, -(-rows // FAIR))
    found = find_hot(df, "k", 350).shares
    assert {k for k, n in sizes.items() if n >= least} <= set(found) and len(found) <= FAIR
    assert all(found[k] >= -(-n // least) for k, n in sizes.items() if k in found)


def test_bound_of_the_summaries():
    assert guaranteed() and not guaranteed(FAIR * 2) and guaranteed(FAIR * 2, 65_536)


def test_as_many_hot_keys_as_can_be(spark):
    left = spark.range(60_000).select((F.col("id") % 4_000).alias("k"), F.col("id").alias("l"))
    right = spark.range(30_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("r"))
    hot = find_hot(left, "k", 2)
    assert len(hot.shares) == 4_000
    found = salted_join(left, right, hot, spread_hash("l"))
    assert found.count() == 60_000 and found.where("r <> 2 * k OR r IS NULL").count() == 0
    # No key of these holds a 4096th of the rows.
    assert not find_hot(spark.range(60_000).select((F.col("id") % 25_000).alias("k")), "k", 2)


def test_profiles_ask_each_table_once(spark):
    class Counted(dict):
        asked = 0

        def __getitem__(self, name):
            Counted.asked += 1
            return super().__getitem__(name)

    tables = Counted(
        review=spark.createDataFrame([(1, "a"), (1, "b"), (2, "b")], "review_id long, buyer_id string"),
        product_reviews=spark.createDataFrame([("p", 1), ("p", None)], "p_id string, review_id long"),
    )
    known = Profiles(tables).prepare("review", "product_reviews", hot_rows=2)
    for _ in range(3):
        assert known.hot("review", "review_id", 2).shares == {1: 1} and known.hot("review", "buyer_id", 2).shares == {"b": 1}
        assert known.hot("product_reviews", "p_id", 2).shares == {"p": 1}
    assert Counted.asked == 2


@pytest.mark.parametrize("part_rows", [1, 10, 1000])
def test_parts_do_not_depend_on_the_layout(spark, part_rows):
    rows = [(k, f"item {i % 700}") for k in ("a", "b") for i in range(3000 if k == "a" else 9)]
    df = spark.createDataFrame(rows, "k string, v string")
    found = [
        sorted((r["k"], r["part"], tuple(r["items"])) for r in collect_parts(df.repartition(n), "k", F.col("v"), "items", "part", part_rows).collect())
        for n in (2, 7, 16)
    ]
    assert found[0] == found[1] == found[2]
    assert max(len(items) for k, _, items in found[0]) <= part_rows + 6 * part_rows**0.5 + 6


def test_items_that_stand_for_more_travel_alone_and_fall_into_the_same_parts(spark):
    rows = spark.range(300).selectExpr("id % 7 AS k", "cast(id % 11 as string) AS v")
    whole = lambda v: F.struct(v.alias("v"), F.concat(F.lit("sent-"), v).alias("more"))
    wide = collect_parts(rows, "k", whole(F.col("v")), "items", "part", 5).withColumn("items", F.transform("items", lambda x: x["v"]))
    narrow = collect_parts(rows, "k", F.col("v"), "items", "part", 5, whole)
    found = [sorted((r["k"], r["part"], r["items"]) for r in df.collect()) for df in (wide, narrow)]
    assert found[0] == found[1] and len(found[0]) > 14
