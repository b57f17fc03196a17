"""Bucketed tables, pages and the trigram index give the rows of plain scans, and read less."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewloom.operators import serve
from reviewloom.sources import layout


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(6)
    names = ["Ring of Gold", "gold ring", "RINGING bell", "épée d'Or", "漢字 ring", "x", "", None, "straße", "İstanbul ring"]
    data = [(draw.choice([None, "hot", "hot", f"k{i % 40}"]), i, draw.choice(names)) for i in range(600)]
    return spark.createDataFrame(data, "k string, n long, name string").repartition(5)


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def plan(df):
    return df._jdf.queryExecution().toString()


def pruned(spark, lookup):
    """The plan of a look-up. Spark names the buckets read only if the scan keeps their order; it leaves out the others in any case."""
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        return plan(lookup())
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_bucketed_lookups(spark, rows):
    table = layout.store_bucketed(rows, "t", ["k"], ["n"], buckets=8)
    for value in ("hot", "k7", "none"):
        assert same(table.lookup(value), serve.lookup(rows, k=value))
    assert "SelectedBucketsCount: 1 out of 8" in pruned(spark, lambda: table.lookup("k7"))
    wanted = spark.createDataFrame([("k1",), ("k2",), ("k2",), ("none",), (None,)], "k string")
    assert same(table.lookup_many(wanted), rows.join(wanted.distinct(), "k", "left_semi"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = table.lookup_many(wanted)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The keys are shuffled, the table's side is not.
    side = text[text.index("SortMergeJoin") :].split("FileScan")[0]
    assert "Exchange" not in side
    pair = layout.store_bucketed(rows, "p", ["k", "n"])
    assert same(pair.lookup("hot", 3), serve.lookup(rows, k="hot", n=3)) and "SelectedBucketsCount: 1 out of 8" in pruned(spark, lambda: pair.lookup("hot", 3))
    assert layout.store_bucketed(rows.limit(0), "e", ["k"]).lookup("a").collect() == []
    table.drop()
    assert not spark.catalog.tableExists(table.name)


@pytest.mark.parametrize("ranges", [1, 7])
def test_pages(rows, ranges):
    pages = layout.Pages(rows, ["k"], ranges)
    order = [F.col(c).asc_nulls_first() for c in ("k", "n", "name")]
    for skip, limit in ((0, 5), (0, 0), (13, 100), (590, 50), (600, 10), (0, 1000), (299, 2)):
        found = pages.page(skip, limit).collect()
        assert found == rows.orderBy(*order).offset(skip).limit(limit).collect()
    if ranges == 7:
        assert len(pages.starts) == 7
        # A page deep in the order opens the folders that hold it.
        assert len({f for f in pages.page(590, 5).inputFiles()}) < len(pages.rows.inputFiles()) or "PartitionFilters" in plan(pages.page(590, 5))
        text = plan(pages.page(590, 5))
        assert "_range" in text.split("PartitionFilters")[1].split("]")[0]
    assert layout.Pages(rows.limit(0), ["k"]).page(0, 5).collect() == []


@pytest.fixture(scope="module")
def index(rows):
    return layout.TrigramIndex(rows, "name", 3)


@pytest.mark.parametrize("text", ["ring", "RING", "ring of", "Gold", "épé", "漢字 ", "字 r", "x", "", "ri", "nothing", "STRASSE", "straße", "i̇st", "İST", "ringing bell and more"])
def test_trigram_search(rows, index, text):
    found = index.search(text)
    want = serve.search(rows, "name", text)
    assert same(found, want)
    candidates = index.candidates(text)
    if candidates is None:
        assert len(text) < 3
    else:
        # Every match is a candidate, and no row without all the trigrams is.
        total = sum(1 for r in rows.select("name").collect() if r[0] and all(g in r[0].lower() for g in {text.lower()[i : i + 3] for i in range(len(text.lower()) - 2)}))
        assert want.count() <= candidates.count() == total


@given(st.lists(st.text(alphabet="abAB é👍", max_size=9), min_size=1, max_size=12), st.text(alphabet="abAB é👍", min_size=0, max_size=5))
@settings(max_examples=6, deadline=None)
def test_any_text(spark, names, text):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert same(layout.TrigramIndex(df, "name", 2).search(text), serve.search(df, "name", text))
