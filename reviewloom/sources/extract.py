"""Extraction to the lake, with buyer ids made anonymous on the way."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..functions.scalar import anonymise
from ..schemas import EXTRACT_TABLES, schema_of
from .readers import read_csv
from .writers import replace_table, write_lake


def anonymise_buyers(df: DataFrame, salt: str = "default_salt", null_as_text: bool = False) -> DataFrame:
    """Hash ``buyer_id`` where the table has it; a fixed salt keeps joins between tables valid."""
    if "buyer_id" not in df.columns:
        return df
    return df.withColumn("buyer_id", anonymise("buyer_id", salt, null_as_text))


def extract_table(
    df: DataFrame, table: str, root: str, prefix: str = "raw", fmt: str = "parquet", salt: str = "default_salt"
) -> str:
    return write_lake(anonymise_buyers(df, salt), f"{root.rstrip('/')}/{prefix}/{table}", fmt)


def extract_tables(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    root: str,
    tables: tuple[str, ...] = EXTRACT_TABLES,
    fmt: str = "parquet",
    salt: str = "default_salt",
) -> tuple[dict[str, str | None], DataFrame]:
    """(path per table, status rows). A table that fails does not stop the others."""
    paths: dict[str, str | None] = {}
    status = []
    for table in tables:
        error = None
        try:
            paths[table] = extract_table(read(table), table, root, fmt=fmt, salt=salt)
        except Exception as exc:  # noqa: BLE001  reported per table
            paths[table] = None
            error = str(exc) or type(exc).__name__
        status.append((table, paths[table], error))
    return paths, spark.createDataFrame(status, "table_name string, location string, error string")


def bulk_load(spark: SparkSession, files: Mapping[str, str], database: str = "default") -> list[str]:
    """Load CSV files into tables under their declared schemas; a malformed row fails the load."""
    loaded = []
    for table, path in files.items():
        replace_table(read_csv(spark, path, schema_of(table), strict=True), f"{database}.{table}")
        loaded.append(table)
    return loaded
