"""Published tables: whole states, failures, repeated runs."""

import pytest
from pyspark.sql import functions as F

from reviewloom.plans import jobs
from reviewloom.schemas import schema_of
from reviewloom.sources import snapshots, writers
from reviewloom.sources.snapshots import CatalogTable, CommitConflict, Snapshots, read_published


def numbers(spark, *values):
    return spark.createDataFrame([(v, f"k{v % 2}") for v in values], "v int, k string")


def values(df):
    return sorted(r["v"] for r in df.collect())


def failing(spark):
    """A write that fails after some of its rows are on disk."""
    broken = F.udf(lambda v: 1 // (900 - v), "int")
    return spark.range(1000).repartition(4).select(broken(F.col("id").cast("int")).alias("v"), F.lit("k").alias("k"))


@pytest.mark.parametrize("fmt, by", [("parquet", ()), ("json", ("k",))])
def test_states(spark, tmp_path, fmt, by):
    table = Snapshots(spark, str(tmp_path / "t"), fmt, by)
    with pytest.raises(LookupError):
        table.read()
    assert table.replace(numbers(spark, 1, 2)) == 2 and values(table.read()) == [1, 2]
    before = table.read()
    assert table.replace(numbers(spark, 3)) == 1
    # A reader that opened the old state goes on reading it.
    assert values(before) == [1, 2] and values(table.read()) == [3]
    assert values(table.read(1)) == [1, 2] and table.read().columns == ["v", "k"]
    assert values(read_published(spark, str(tmp_path / "t"))) == [3]
    table.replace(numbers(spark))
    assert table.read().collect() == [] and table.state().version == 3
    assert table.vacuum(1) == 2 and table.read().collect() == []
    with pytest.raises(LookupError):
        table.read(1)
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1 and len(list((tmp_path / "t" / "manifests").iterdir())) == 1


def test_a_failed_write_leaves_the_old_state(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"))
    table.replace(numbers(spark, 1, 2))
    with pytest.raises(Exception):
        table.replace(failing(spark))
    assert values(table.read()) == [1, 2] and table.state().version == 1
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1
    # Killed between data and manifest: nobody sees the data.
    table.write(numbers(spark, 9))
    assert values(table.read()) == [1, 2]


def test_a_repeated_run_replaces_its_rows(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"), "json", ("k",))
    table.append(numbers(spark, 1, 2), "monday")
    table.append(numbers(spark, 3), "tuesday")
    table.append(numbers(spark, 1, 2, 4), "monday")
    assert values(table.read()) == [1, 2, 3, 4]
    table.append(numbers(spark, 3), "tuesday")
    assert values(table.read()) == [1, 2, 3, 4] and values(table.read(2)) == [1, 2, 3]
    with pytest.raises(ValueError, match="columns"):
        table.append(spark.range(1).withColumn("k", F.lit("k")), "wednesday")
    assert values(table.read()) == [1, 2, 3, 4]


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    mine, other = Snapshots(spark, str(tmp_path / "t")), Snapshots(spark, str(tmp_path / "t"))
    state = mine.state()
    monkeypatch.setattr(other, "state", lambda: state)
    tokens = iter(["1" * 32, "b" * 32, "2" * 32, "a" * 32])

    class Token:
        def __init__(self):
            self.hex = next(tokens)

    monkeypatch.setattr(snapshots.uuid, "uuid4", Token)
    mine.replace(numbers(spark, 1))
    other.replace(numbers(spark, 2))  # the smaller token counts, for every reader
    assert values(mine.read()) == [2]
    tokens = iter(["3" * 32, "c" * 32])
    with pytest.raises(CommitConflict):
        other.replace(numbers(spark, 3))
    assert values(mine.read()) == [2]


def test_catalog_table(spark):
    spark.sql("DROP TABLE IF EXISTS shown")
    assert writers.replace_table(numbers(spark, 1, 2), "shown") == 2
    for v in (3, 4, 5):
        writers.replace_table(numbers(spark, v), "shown")
        assert values(spark.table("shown")) == [v] and values(spark.sql("SELECT * FROM shown")) == [v]
    with pytest.raises(Exception):
        writers.replace_table(failing(spark), "shown")
    assert values(read_published(spark, "shown")) == [5]
    with pytest.raises(ValueError, match="columns"):
        writers.replace_table(spark.range(3), "shown")
    assert values(CatalogTable(spark, "shown").read()) == [5]
    spark.sql("DROP TABLE shown")


@pytest.fixture()
def tables(spark):
    make = lambda t, rows: spark.createDataFrame(rows, schema_of(t))
    review = spark.createDataFrame([(i, "b", None if i % 3 == 0 else "text", "t", 5) for i in range(12)], "review_id long, buyer_id string, r_desc string, title string, rating int")
    empty = {t: spark.createDataFrame([], schema_of(t)) for t in ("product", "category", "product_reviews", "review_images", "orders")}
    return {**empty, "review": review, "category": make("category", [(1, "c", "d")])}


@pytest.mark.parametrize("step", ["reviews", "rejects", "metadata"])
def test_a_job_that_fails_midway(spark, tables, tmp_path, monkeypatch, step):
    target = [str(tmp_path / n) for n in ("reviews", "rejected", "runs")]
    jobs.process_tables(tables, *target, run_id="one", staging=str(tmp_path / "s1"))
    first = [read_published(spark, t).count() for t in target]
    assert first == [8, 4, 1]
    with monkeypatch.context() as patch:
        if step == "metadata":
            patch.setattr(jobs, "save_metadata", lambda *_: 1 / 0)
        else:
            plain = Snapshots.write

            def write(self, df, run_id=""):
                if self.root == target[step == "rejects"]:
                    raise OSError("disk full")
                return plain(self, df, run_id)

            patch.setattr(Snapshots, "write", write)
        with pytest.raises((OSError, ZeroDivisionError)):
            jobs.process_tables({**tables, "review": tables["review"].where("review_id < 6")}, *target, run_id="two", staging=str(tmp_path / "s2"))
    assert not (tmp_path / "s1").exists() and not (tmp_path / "s2").exists()
    if step != "metadata":
        assert [read_published(spark, t).count() for t in target] == first
    for _ in range(2):
        jobs.process_tables({**tables, "review": tables["review"].where("review_id < 6")}, *target, run_id="two")
    assert [read_published(spark, t).count() for t in target] == [4, 6, 2]
