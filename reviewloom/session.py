"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Codec of staged tables of whole texts: some two thirds of the bytes of Spark's default.
STAGED_CODEC = "zstd"

_OWN_DIRS: dict[str, str] = {}


def build_session(app: str = "reviewloom", cpus: int | None = None, **conf: str) -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own."""
    cpus = cpus or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        # A scan of few large files still gives every core a part.
        .config("spark.sql.files.minPartitionNum", str(cpus))
        .config("spark.sql.files.openCostInBytes", "65536")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    ``spark.checkpoint.dir`` names it on a cluster. Only where it is unset (tests,
    one machine) is a folder of our own made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = tempfile.mkdtemp(prefix="reviewloom-")
    return _OWN_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, never used before."""
    return f"{shared_dir(spark)}/reviewloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, its size known, readable by every executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staging path of our own, in whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def share_package(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it; on a cluster it is installed or sent along."""
    root = str(Path(__file__).resolve().parents[1])
    known = spark.sparkContext.environment
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
