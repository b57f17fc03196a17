"""Tables of files that are published whole: versioned snapshots with a manifest written last.

A table is a folder with ``data/segment=<id>`` for each write and ``manifests/version=<n>`` for each published state. A manifest lists
the segments that make up the table, and with each the run that wrote it. Data are written under a new segment first; only then
is the next manifest written, a single file that Spark's commit puts in place at once. Until that moment, and after
any failure before it, readers find the state before. A run that appends again replaces its own segment, so a
repeated run adds nothing. All of it is plain reading and writing by Spark, in whatever file system the folder is.

One writer at a time is meant. Two that publish the same version at once are told apart: one of them fails.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_path

_SEGMENTS = "array<struct<segment: string, run_id: string, n_rows: bigint>>"
_MANIFEST = f"version int, token string, format string, partition_by array<string>, schema string, segments {_SEGMENTS}"


class CommitConflict(RuntimeError):
    """Another writer published the same version."""


@dataclass(frozen=True)
class Segment:
    segment: str
    run_id: str
    n_rows: int


@dataclass(frozen=True)
class State:
    """A published state; version 0 is that of a table never published."""

    version: int = 0
    fmt: str = "parquet"
    schema: T.StructType = T.StructType()
    partition_by: tuple[str, ...] = ()
    segments: tuple[Segment, ...] = ()


class Snapshots:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
        self.spark, self.root, self.fmt, self.partition_by = spark, root.rstrip("/"), fmt, tuple(partition_by)

    def _path(self, segment: str) -> str:
        return f"{self.root}/data/segment={segment}"

    def _manifests(self) -> list:
        """All manifests; of two of the same version the smaller token counts."""
        try:
            rows = self.spark.read.schema(_MANIFEST).option("recursiveFileLookup", "true").json(f"{self.root}/manifests").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        first: dict[int, object] = {}
        for row in sorted(rows, key=lambda r: r["token"]):
            first.setdefault(row["version"], row)
        return [first[v] for v in sorted(first)]

    def state(self, version: int | None = None) -> State:
        """The newest state, or that of a version which is still kept."""
        found = self._manifests()
        if version is not None:
            found = [r for r in found if r["version"] == version]
            if not found:
                raise LookupError(f"version {version} of {self.root} is not kept")
        if not found:
            return State(fmt=self.fmt, partition_by=self.partition_by)
        row = found[-1]
        segments = tuple(Segment(**s.asDict()) for s in row["segments"])
        return State(row["version"], row["format"], T.StructType.fromDDL(row["schema"]), tuple(row["partition_by"]), segments)

    def write(self, df: DataFrame, run_id: str = "") -> tuple[Segment, T.StructType]:
        """Write a segment that nobody reads yet; a failed write leaves nothing behind."""
        segment, seen = uuid.uuid4().hex, Observation()
        try:
            writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("error").format(self.fmt)
            (writer.partitionBy(*self.partition_by) if self.partition_by else writer).save(self._path(segment))
        except BaseException:
            remove_path(self.spark, self._path(segment))
            raise
        return Segment(segment, run_id, seen.get["n"]), df.schema

    def publish(self, written: tuple[Segment, T.StructType], append: bool = False) -> State:
        """Make a written segment the table, or (``append``) add it in place of what the same run wrote before."""
        segment, schema = written
        before = self.state()
        others = tuple(s for s in before.segments if s.run_id != segment.run_id) if append else ()
        if others and [(f.name, f.dataType) for f in before.schema] != [(f.name, f.dataType) for f in schema]:
            raise ValueError(f"columns of {self.root} differ from those appended")
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        state = State(before.version + 1, self.fmt, T.StructType.fromDDL(ddl), self.partition_by, (*others, segment))
        token = uuid.uuid4().hex
        row = (state.version, token, self.fmt, list(self.partition_by), ddl, [(s.segment, s.run_id, s.n_rows) for s in state.segments])
        manifest = self.spark.createDataFrame([row], _MANIFEST).coalesce(1)
        # The name holds the token: a failed attempt's empty folder is in nobody's way.
        manifest.write.mode("error").json(f"{self.root}/manifests/{state.version:09d}-{token}")
        published = [r for r in self._manifests() if r["version"] == state.version]
        if published[0]["token"] != token:
            raise CommitConflict(f"version {state.version} of {self.root} was published by another writer")
        return state

    def replace(self, df: DataFrame, run_id: str = "") -> int:
        """The rows of ``df`` become the table; returns their number, counted during the write."""
        written = self.write(df, run_id)
        self.publish(written)
        return written[0].n_rows

    def append(self, df: DataFrame, run_id: str) -> int:
        written = self.write(df, run_id)
        self.publish(written, append=True)
        return written[0].n_rows

    def read(self, version: int | None = None, without_run: str | None = None) -> DataFrame:
        """The newest state or a given one; ``without_run``: but for what this run wrote."""
        state = self.state(version)
        if not state.version:
            raise LookupError(f"{self.root} was never published")
        segments = [s for s in state.segments if without_run is None or s.run_id != without_run]
        if not segments:
            return self.spark.createDataFrame([], state.schema)
        schema = T.StructType([*state.schema.fields, T.StructField("segment", T.StringType())])
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").format(state.fmt)
        return rows.load([self._path(s.segment) for s in segments]).select(*state.schema.names)

    def vacuum(self, keep: int = 2) -> int:
        """Delete segments and manifests that only states before the last ``keep`` have; returns the number of segments.

        Readers of an older state must be done by then.
        """
        found = self._manifests()
        old, kept = found[:-keep], found[-keep:]
        held = {s["segment"] for r in kept for s in r["segments"]}
        gone = {s["segment"] for r in old for s in r["segments"]} - held
        for row in old:
            remove_path(self.spark, f"{self.root}/manifests/{row['version']:09d}-{row['token']}")
        for segment in gone:
            remove_path(self.spark, self._path(segment))
        return len(gone)


class CatalogTable:
    """A table of the catalog whose states are segments of files; publishing is one change of its location."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name = spark, name
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        self.files = Snapshots(spark, f"{folder}/published/{name}")

    def write(self, df: DataFrame, run_id: str = "") -> tuple[Segment, T.StructType]:
        if self.spark.catalog.tableExists(self.name):
            known = self.spark.table(self.name).schema
            if [(f.name, f.dataType) for f in known] != [(f.name, f.dataType) for f in df.schema]:
                raise ValueError(f"columns of {self.name} differ from those written; drop the table first")
        return self.files.write(df, run_id)

    def publish(self, written: tuple[Segment, T.StructType]) -> State:
        state = self.files.publish(written)
        path = self.files._path(written[0].segment)
        if self.spark.catalog.tableExists(self.name):
            # The location is bound as a literal; it holds no quote of ours.
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{path}'")
            self.spark.catalog.refreshTable(self.name)
        else:
            self.spark.catalog.createTable(self.name, path=path, source=self.files.fmt, schema=written[1])
        return state

    def replace(self, df: DataFrame, run_id: str = "") -> int:
        written = self.write(df, run_id)
        self.publish(written)
        return written[0].n_rows

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def vacuum(self, keep: int = 2) -> int:
        return self.files.vacuum(keep)


def published(spark: SparkSession, target: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> Snapshots | CatalogTable:
    """The table of a folder, where ``target`` is a path, or of the catalog."""
    return Snapshots(spark, target, fmt, partition_by) if "/" in target else CatalogTable(spark, target)


def read_published(spark: SparkSession, target: str) -> DataFrame:
    return published(spark, target).read()
