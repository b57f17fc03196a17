"""Cleaning rules on literal frames, on random frames, and on hot keys."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reviewloom.operators.classify import with_precomputed
from reviewloom.operators.clean import FULL_RULES, LIGHT_RULES, clean_and_validate, flag_rejects, join_and_flag
from reviewloom.operators.joins import join_reviews
from reviewloom.operators.quality import reason_vocabulary
from reviewloom.plans.jobs import stage_flagged

SCHEMA = (
    "review_id bigint, rating int, title string, description string, buyer_id string, p_id string, "
    "product_name string, category string, text_length int, has_image int, has_orders int"
)


def frame(spark, ids, ratings, titles, texts, buyers):
    n = len(ids)
    rows = [
        (ids[i], ratings[i], titles[i], texts[i], buyers[i], f"P{i + 1}", f"Product {i + 1}", "Books", 5, i % 2, 1)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA)


TITLES = ["Great", "Good", "OK", "Bad", "Terrible"]
TEXTS = ["Excellent", "Nice", "Average", "Not good", "Waste"]
BUYERS = ["B1", "B2", "B3", "B4", "B5"]
FRAMES = {
    "sample": ([1, 2, 3, 4, 5], [5, 4, 3, 2, 1], TITLES, TEXTS, BUYERS),
    "duplicates": ([1, 2, 2, 3, 4], [5, 4, 4, 3, 2], TITLES, TEXTS, BUYERS),
    "nulls": (
        [1, 2, None, 4, 5], [5, None, 3, 2, 1], TITLES[:4] + [None], TEXTS[:3] + [None, "Waste"],
        ["B1", "B2", "B3", None, "B5"],
    ),
    "ratings": ([1, 2, 3, 4, 5], [5, 6, 0, -1, 3], TITLES, TEXTS, BUYERS),
    "mixed": (
        [1, 2, 2, None, 5, 6], [5, 4, 4, 3, 0, 6], TITLES + ["Late"], TEXTS + ["Late"], BUYERS[:5] + [None],
    ),
}
CLEAN = {"sample": [1, 2, 3, 4, 5], "duplicates": [1, 2, 3, 4], "nulls": [1, 5], "ratings": [1, 5], "mixed": [1, 2]}
SAME = {
    "sample": [],
    "duplicates": [(2, "duplicate_review_id")],
    "ratings": [(2, "invalid_rating"), (3, "invalid_rating"), (4, "invalid_rating")],
    "mixed": [
        (None, "missing_required_fields"), (2, "duplicate_review_id"), (5, "invalid_rating"), (6, "invalid_rating"),
    ],
}
LIGHT = {**SAME, "nulls": [(None, "missing_required_fields"), (2, "missing_required_fields"), (4, "missing_buyer_id")]}
FULL = {**SAME, "nulls": [(None, "missing_required_fields"), (2, "missing_required_fields"), (4, "empty_description")]}


def _ids(df):
    return sorted(r["review_id"] for r in df.collect())


def _rejects(df):
    return sorted(((r["review_id"], r["rejection_reason"]) for r in df.collect()), key=lambda x: (x[0] or 0, x[1]))


@pytest.mark.parametrize("name", FRAMES)
@pytest.mark.parametrize("rules, expected", [(LIGHT_RULES, LIGHT), (FULL_RULES, FULL)], ids=["light", "full"])
def test_literal_frames(spark, name, rules, expected):
    df = frame(spark, *FRAMES[name])
    clean, rejected = clean_and_validate(df, rules)
    assert _ids(clean) == CLEAN[name]
    assert _rejects(rejected) == expected[name]
    if rules is LIGHT_RULES:
        assert clean.columns == df.columns


def test_details_and_original_row(spark):
    _, rejected = clean_and_validate(frame(spark, *FRAMES["nulls"]))
    found = {r["review_id"]: r for r in rejected.collect()}
    assert found[None]["error_details"] == "Missing required fields: review_id"
    assert found[2]["error_details"] == "Missing required fields: rating"
    assert found[4]["original_data"]["p_id"] == "P4" and found[4]["original_data"]["description"] is None
    _, rejected = clean_and_validate(frame(spark, *FRAMES["ratings"]))
    assert {r["error_details"] for r in rejected.collect()} == {f"Invalid rating: {n}" for n in (6, 0, -1)}


def test_defaults_are_filled(spark):
    df = spark.createDataFrame([(1, 5, None, "x", "B", None, None, None, None, None, None)], SCHEMA)
    row = clean_and_validate(df)[0].first()
    assert (row["title"], row["category"], row["text_length"], row["has_image"], row["has_orders"]) == (
        "", "Unknown", 0, False, False,
    )


@pytest.mark.parametrize("text", [None, "", "   ", "\t", "\n \r\n", " ", "  "])
def test_blank_texts(spark, text):
    df = frame(spark, [1], [5], ["t"], [text], ["B1"])
    assert _rejects(clean_and_validate(df)[1]) == [(1, "empty_description")]


def test_no_buyer_column(spark):
    df = frame(spark, *FRAMES["nulls"]).drop("buyer_id")
    assert _ids(clean_and_validate(df, LIGHT_RULES)[0]) == [1, 4, 5]


def test_vocabulary(spark):
    _, rejected = clean_and_validate(frame(spark, *FRAMES["nulls"]))
    found = {r["rejection_reason"]: (r["declared"], r["known"]) for r in reason_vocabulary(rejected).collect()}
    assert found == {"missing_required_fields": (True, True), "empty_description": (False, True)}


row = st.tuples(
    st.one_of(st.none(), st.integers(1, 6)), st.one_of(st.none(), st.integers(-1, 7)),
    st.one_of(st.none(), st.sampled_from(["", " ", "\t", "text"])), st.one_of(st.none(), st.sampled_from(["B1", "B2"])),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, max_size=25), st.sampled_from([1, 2, 1000]))
def test_invariants(spark, rows, hot_rows):
    df = frame(spark, [r[0] for r in rows], [r[1] for r in rows], ["t"] * len(rows), [r[2] for r in rows], [r[3] for r in rows])
    flagged = flag_rejects(df, hot_rows=hot_rows).collect()
    clean = [r for r in flagged if r["rejection_reason"] is None]
    assert len(flagged) == len(rows)
    assert len({r["review_id"] for r in clean}) == len(clean)
    assert all(r["review_id"] is not None and 1 <= r["rating"] <= 5 and r["description"].strip() for r in clean)
    firsts = [r for r in flagged if r["rejection_reason"] != "duplicate_review_id"]
    assert sorted(map(str, {r["review_id"] for r in firsts})) == sorted(str(r["review_id"]) for r in firsts)


@pytest.mark.parametrize("hot_rows", [5, 10**6])
def test_a_third_of_all_rows_are_copies(spark, hot_rows):
    random.seed(1)
    rows = [(7, 5, "t", "same text", "B", "P1", "n", "c", 9, 0, 1)] * 200
    rows += [(None, 4, "t", "no id", "B", "P1", "n", "c", 9, 0, 1)] * 50
    rows += [(100 + i, 3, "t", f"text {i}", f"B{i}", f"P{i % 9}", "n", "c", 9, 0, 1) for i in range(300)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    flagged = flag_rejects(df, hot_rows=hot_rows)
    counts = {(r[0], r[1]): r[2] for r in flagged.groupBy("review_id", "rejection_reason").count().collect() if r[0] in (7, None)}
    assert counts == {
        (7, None): 1, (7, "duplicate_review_id"): 199,
        (None, "missing_required_fields"): 1, (None, "duplicate_review_id"): 49,
    }
    assert flagged.count() == len(rows)


# Reviews 1 and 4 have several links, 2 comes three times (twice the same), 3 has no link, 5 an unknown product.
REVIEWS = [
    (1, "B1", "one", "t", 5), (2, "B2", "b", "t", 4), (2, "B2", "a", "t", 4), (2, "B2", "a", "t", 4), (3, "B3", "three", None, 1),
    (4, None, "four", "t", 3), (5, "B1", "five", "t", 9), (None, "B1", "six", "t", 2), (None, None, "seven", "t", 2),
]
LINKS = [("p2", 1), ("p1", 1), ("p3", 1), ("p1", 2), ("p2", 2), ("gone", 4), ("p1", 4), ("p1", 4), ("gone", 5), ("p1", None)]


@pytest.fixture(scope="module")
def linked(spark):
    make = spark.createDataFrame
    return {
        "review": make(REVIEWS, "review_id bigint, buyer_id string, r_desc string, title string, rating int").repartition(3),
        "product_reviews": make(LINKS, "p_id string, review_id bigint").repartition(2),
        "product": make([(f"p{i}", f"name {i}", i) for i in (1, 2, 3)], "p_id string, p_name string, category_id int"),
        "category": make([(1, "Books"), (2, "Toys")], "category_id int, name string"),
        "review_images": make([(1, "z"), (1, "y"), (2, "x")], "review_id bigint, review_img string"),
        "orders": make([(7, "B1"), (8, "B1")], "order_id bigint, buyer_id string"),
    }


@pytest.mark.parametrize("hot_rows", [None, 2, 1])
def test_first_row_of_each_joined_review(linked, hot_rows):
    key = lambda row: [(v is not None, v if v is not None else "") for v in row]
    expected = []
    for id_ in {r[0] for r in REVIEWS}:
        mine = [(p if p != "gone" else None) for p, r in LINKS if r == id_ and id_ is not None] or [None]
        rows = sorted(([p, b, n, t, d] for r, b, d, t, n in REVIEWS if r == id_ for p in mine), key=key)
        expected += [(id_, *row, i == 0) for i, row in enumerate(rows)]
    found = join_and_flag(linked, hot_rows=hot_rows).collect()
    columns = ("review_id", "p_id", "buyer_id", "rating", "title", "description")
    found = [(*(r[c] for c in columns), r["rejection_reason"] != "duplicate_review_id") for r in found]
    assert sorted(found, key=key) == sorted(expected, key=key)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_are_not_sorted_for_the_joins(spark, linked, tmp_path):
    joined = _plan(join_and_flag(linked))
    assert "ShuffledHashJoin [review_id" in joined and "SortMergeJoin [review_id" not in joined
    # Only repeated ids and rows without an id are put in order with their texts.
    firsts = [line for line in joined.splitlines() if "row_number" in line and "Window [" in line]
    assert len(firsts) == 3 and sum("rating" in line for line in firsts) == 2
    classes = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0)], "review_id bigint, category_review string, confidence_score double")
    topics = with_precomputed(join_reviews(linked), classes)
    assert "SortMergeJoin [review_id" not in _plan(topics)
    assert topics.where("review_id = 1").count() == 6 and topics.count() == join_reviews(linked).count() + 3
    staged, counts = stage_flagged(join_and_flag(linked), str(tmp_path / "flagged"))
    # Folders by verdict would take a sort of each task's texts.
    assert not list((tmp_path / "flagged").glob("verdict=*"))
    assert counts["clean"] == staged.where("verdict = 'clean'").count() and counts["rejected"] == staged.where("verdict = 'rejected'").count()
