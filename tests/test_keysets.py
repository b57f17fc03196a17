"""Key sets as bitmaps against plain sets."""

import random

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import keysets

ODD = ["007", "-0", "+5", " 5", "5 ", "5", "-5", "1e3", "", "9223372036854775808", "9223372036854775807", "-9223372036854775808", "X1", "Ｘ", "0", "00"]


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(8)
    number = lambda: draw.choice([None, draw.randint(-200, 200), draw.randint(0, 10**12), draw.choice([2**63 - 1, -(2**63), 0, 63, 64, -1, -64])])
    text = lambda: draw.choice([None, str(draw.randint(0, 300)), draw.choice(ODD)])
    child = [(number(), text(), draw.choice([None, draw.randint(-9, 9)]), draw.choice(["a", "b", None])) for _ in range(900)]
    parent = [(draw.choice(child)[0] if draw.random() < 0.7 else number(), text(), draw.randint(-9, 5)) for _ in range(300)]
    return {
        "child": spark.createDataFrame(child, "n long, t string, s short, g string").repartition(5),
        "parent": spark.createDataFrame(parent, "n long, t string, s int").repartition(3),
    }


def _values(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize("count_rows", [True, False])
def test_references(tables, count_rows):
    pairs = [("child", "n", "parent", "n"), ("child", "t", "parent", "t"), ("child", "s", "parent", "s"), ("parent", "t", "child", "t"), ("child", "n", "parent", "t")]
    found = {r["pair"]: r for r in keysets.references(tables, pairs, count_rows).collect()}
    for i, (table, column, parent, parent_column) in enumerate(pairs):
        # Keys are equal if they are spelled alike.
        uses = [str(v) for v in _values(tables[table], column) if v is not None]
        known = {str(v) for v in _values(tables[parent], parent_column) if v is not None}
        want = (len(set(uses)), len(set(uses) - known), sum(u not in known for u in uses))
        assert (found[i]["keys"], found[i]["orphan_keys"]) == want[:2]
        assert not count_rows or found[i]["orphan_rows"] == want[2]


def test_references_of_empty_tables(tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    pairs = [("child", "n", "parent", "n"), ("child", "t", "parent", "t")]
    assert sorted(map(tuple, keysets.references(empty, pairs).collect())) == [(0, 0, 0, 0), (1, 0, 0, 0)]
    half = {"child": tables["child"], "parent": empty["parent"]}
    found = keysets.references(half, pairs[:1]).first()
    numbers = [v for v in _values(tables["child"], "n") if v is not None]
    assert tuple(found) == (0, len(set(numbers)), len(set(numbers)), len(numbers))


def test_distinct_counts(tables):
    child = tables["child"]
    found = keysets.distinct_counts(child, ["n", "t", "s"]).first()
    assert tuple(found) == tuple(len({v for v in _values(child, c) if v is not None}) for c in "nts")
    for row in keysets.distinct_counts(child, ["t", "n"], "g").collect():
        mine = child.where(F.col("g").eqNullSafe(F.lit(row["g"])))
        assert (row["t"], row["n"]) == tuple(len({v for v in _values(mine, c) if v is not None}) for c in "tn")
    assert tuple(keysets.distinct_counts(child.limit(0), ["n", "t"]).first()) == (0, 0)


def test_dense_keys_travel_as_words(spark):
    rows = keysets.entries({"t": spark.range(64_000)}, {"t": [(0, "id")]})
    assert keysets.key_sets(rows).count() == 1000
