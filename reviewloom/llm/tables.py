"""Small helpers shared by the operators: columns, lineage cuts, batch sizes."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, share_package

#: White space of the word patterns: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage where every executor can read it again."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished plans now, not when the driver happens to collect its garbage.

    An operator of many steps calls this after large ones, whose results are stored, so that its disk holds little more than those.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` whose Python workers find this package."""
    share_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def whole_text(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``most_bytes`` of the string column, one row at least."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start = taken = 0
        for row, size in enumerate(lengths):
            if taken and taken + size > most_bytes:
                yield batch.slice(start, row - start)
                start, taken = row, 0
            taken += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)
