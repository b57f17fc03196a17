"""Sorted runs of line hashes: their plans, their compaction, and what is left behind; archives and ranges dealt by bytes."""

import os

import pytest
from pyspark.sql import functions as F

from reviewloom.llm import line_dedup, lz_fingerprint, warc
from reviewloom.session import shared_dir


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def places(spark):
    rows = spark.range(2_000).select((F.col("id") % 300).alias("k"), F.col("id").alias("doc"))
    return rows.select(F.xxhash64("k").alias("a"), F.xxhash64(F.lit(1), "k").alias("b"), "doc", F.floor(F.col("doc") / 290).cast("int").alias("batch"))


def test_runs_are_neither_shuffled_nor_sorted_again(spark, places):
    with line_dedup._run_tables(spark) as database:
        runs = [line_dedup._sorted_run(line_dedup.new_lines(places.where(where), []), database) for where in ("batch = 0", "batch = 1 AND a > 0")]
        merge = _plan(line_dedup.compacted(spark, *runs))
        assert "SortMergeJoin" in merge and "Exchange" not in merge and "Sort " not in merge
        # Only the batch is shuffled, for its aggregate; its rows are sorted once for all runs.
        met = _plan(line_dedup.new_lines(places.where("batch = 2"), runs))
        assert met.count("SortMergeJoin") == 2 and met.count("Exchange") == 1 and met.count("Sort ") == 1


@pytest.mark.parametrize("batches", [1, 2, 3, 4, 7])
def test_owners_are_the_smallest_documents(spark, places, batches):
    with line_dedup._run_tables(spark) as database:
        runs = line_dedup.owners(places, batches, database)
        assert len(runs) == batches.bit_count()
        found = sorted(tuple(r) for run in runs for r in spark.table(run).collect())
        assert spark.sql(f"SHOW TABLES IN {database}").count() == len(runs)
        assert line_dedup._as_files(spark, runs[0]).count() == spark.table(runs[0]).count()
    want = places.where(F.col("batch") < batches).groupBy("a", "b").agg(F.min("doc").alias("owner")).collect()
    assert found == sorted(tuple(r) for r in want)


def test_runs_are_dropped(spark, places):
    docs = spark.createDataFrame([(i, f"the same long line\nline number {i} of all") for i in range(40)], "doc_id long, text string")
    folder = f"{shared_dir(spark)}/reviewloom/{spark.sparkContext.applicationId}"
    before = spark.conf.get(line_dedup._SORTED_SCANS)
    assert line_dedup.line_report(docs).agg(F.sum("n_dropped")).first()[0] == 39
    assert not [d for d in spark.catalog.listDatabases() if d.name.startswith("line_runs_")]
    assert not [n for n in os.listdir(folder) if n.startswith("line_runs_")]
    with pytest.raises(ZeroDivisionError), line_dedup._run_tables(spark):
        1 / 0
    assert spark.conf.get(line_dedup._SORTED_SCANS) == before and not [n for n in os.listdir(folder) if n.startswith("line_runs_")]


def test_batches_follow_from_bytes(spark, monkeypatch):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("x" * 100).alias("text"))
    assert len(line_dedup._batch_edges(docs, None)) == line_dedup.BATCHES - 1
    monkeypatch.setattr(line_dedup, "BATCH_BYTES", 5_000)
    assert len(line_dedup._batch_edges(docs, None)) == 19
    assert line_dedup._batch_edges(docs, 1) == [] and line_dedup._batch_edges(docs.limit(0), None) == []


def test_archives_are_dealt_by_bytes(spark, tmp_path):
    pages = spark.range(60).select(F.col("id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 40).alias("html"))
    plain = warc.write_monolithic(warc.described(pages.coalesce(1)), str(tmp_path / "plain"), archive_bytes=10_000)
    sizes = {r["archive"]: r["bytes"] for r in plain.collect()}
    assert len(sizes) > 10 and all(os.path.getsize(a) == n for a, n in sizes.items())
    assert {r["archive"]: r["bytes"] for r in warc._sized(plain.drop("bytes")).collect()} == sizes
    spread = spark.sparkContext.defaultParallelism
    assert warc._dealt(plain, ["archive"], 1 << 30).rdd.getNumPartitions() == min(len(sizes), spread)
    assert warc._dealt(plain, ["archive"], 1).rdd.getNumPartitions() == len(sizes)
    few = warc.normalise(plain, str(tmp_path / "out"))
    assert {r["archive"]: r["bytes"] for r in few.collect()} == {r["archive"]: os.path.getsize(r["archive"]) for r in few.collect()}
    assert warc.read_records(few, task_bytes=1).select("page_id").distinct().count() == 60


@pytest.mark.parametrize("slices_each", [1, 4, 1000])
def test_ranges_keep_the_order_of_ids(spark, slices_each):
    ids = sorted({-(1 << 63), 0, 1, 2, 3, 10, 500, 501, 10**6, 10**15, 10**15 + 1, (1 << 63) - 1})
    rows = spark.createDataFrame([(i,) for i in ids], "id long")
    ranged = lz_fingerprint._range_of(rows, [0, 3, 501, 10**15, (1 << 63) - 1], slices_each)
    found = [(r["coarse"], r["range"]) for r in ranged.orderBy("id").collect()]
    assert found == sorted(found) and all(r // slices_each == c for c, r in found) and {c for c, _ in found} == {0, 1, 2, 3}
