"""A stream over several micro-batches gives what the batch job gives, and a restart adds nothing."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewloom.operators.clean import REASON, clean_rows, flag_rejects, rejected_rows
from reviewloom.sources.snapshots import Snapshots
from reviewloom.streaming import reviews as stream

SCHEMA = "review_id long, buyer_id string, title string, description string, rating int, p_id string, category string, text_length int, has_image int, has_orders int"


@pytest.fixture()
def rows():
    draw = random.Random(4)
    found = []
    for i in range(240):
        found.append((draw.choice([None, i]) if i % 9 == 0 else i, f"b{i % 7}", "t", draw.choice(["fine", "", None, "good"]) if i % 3 == 0 else f"text {i}",
                      draw.choice([1, 5, 9, None]) if i % 4 == 0 else 4, "p", draw.choice("xyz"), 4, 0, 1))
    # Copies of earlier ids with another buyer, later in the order that decides which is kept.
    found += [(i, "z", "t", "again", 3, "p", "x", 5, 0, 0) for i in range(1, 200, 11)]
    return found


def plain(df):
    return Counter(map(repr, df.select(*sorted(df.columns)).collect()))


def test_stream_equals_batch(spark, tmp_path, rows):
    folder, root = tmp_path / "in", str(tmp_path / "out")
    frame = spark.createDataFrame(rows, SCHEMA)
    cuts = [0, 90, 91, 200, len(rows)]
    for part, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        spark.createDataFrame(rows[low:high], SCHEMA).coalesce(1).write.parquet(str(folder / f"part={part}"))
    sinks = stream.Sinks.under(spark, root)
    read = lambda: stream.arriving(spark, str(folder / "part=*"), frame.schema, files_per_batch=1)

    def run():
        query = stream.clean_stream(read(), sinks, str(tmp_path / "checkpoint"))
        query.awaitTermination()
        assert query.exception() is None
        return query

    assert len([p for p in run().recentProgress if p["numInputRows"]]) >= 4
    flagged = flag_rejects(frame)

    def same():
        assert plain(sinks.clean.read()) == plain(clean_rows(flagged, fill=False))
        # The kept copy of a null id is the one that came first; which of them that is decides its message alone.
        told = lambda df: Counter((r["review_id"], r[REASON]) for r in df.collect())
        assert told(sinks.rejected.read()) == told(rejected_rows(flagged))

    same()
    before = sinks.clean.state().version
    run()
    assert sinks.clean.state().version == before
    # The last batch runs again, as after a failure between its results and the checkpoint.
    last = max(int(s.run_id.split("-")[1]) for s in sinks.seen.state().segments)
    again = spark.createDataFrame(rows[cuts[-2] :], SCHEMA)
    stream.publish_batch(again, last, sinks)
    same()
    # Redelivered rows and a new one.
    spark.createDataFrame([*rows[:50], (9999, "b", "t", "new", 5, "p", "x", 3, 0, 0)], SCHEMA).coalesce(1).write.parquet(str(folder / "part=9"))
    run()
    assert sinks.clean.read().count() == clean_rows(flagged).count() + 1
    assert sinks.rejected.read().count() == rejected_rows(flagged).count()


def test_running_counts(spark, tmp_path, rows):
    folder = tmp_path / "in"
    frame = spark.createDataFrame(rows, SCHEMA)
    target = Snapshots(spark, str(tmp_path / "counts"))
    for part in range(3):
        spark.createDataFrame(rows[part::3], SCHEMA).coalesce(1).write.parquet(str(folder / f"part={part}"))
    for _ in range(2):
        found = stream.arriving(spark, str(folder / "part=*"), frame.schema, files_per_batch=1)
        stream.running_counts(found, "category", target, str(tmp_path / "checkpoint")).awaitTermination()
        want = frame.groupBy("category").agg(F.count(F.lit(1)).alias("nb_reviews"), F.sum("rating").alias("sum_rating"), F.count("rating").alias("rated"))
        assert plain(target.read()) == plain(want)
