"""Scans: catalog tables, schema discovery, Parquet folders, CSV fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T


def register_catalog(spark: SparkSession, db: str, tables: dict[str, str],
                     fmt: str = "parquet") -> None:
    """Register files as external catalog tables ``db.name`` (no data copied)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    for name, path in tables.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{db}`.`{name}` USING {fmt} LOCATION '{path}'")


def scan_catalog(spark: SparkSession, db: str, names: list[str]) -> dict[str, DataFrame]:
    """scan_catalog: the named tables of a catalog database."""
    return {n: spark.table(f"`{db}`.`{n}`") for n in names}


def scan_inferred(spark: SparkSession, path: str, fmt: str = "csv", db: str | None = None,
                  table: str | None = None) -> DataFrame:
    """scan_inferred (crawler): read a raw folder inferring its schema (CSV
    with header + ``inferSchema``; Parquet/JSON from their own metadata) and
    optionally record it as a catalog table whose schema follows the files."""
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", True)
    df = reader.format(fmt).load(path)
    if db and table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
        spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{table}`")
        opts = "OPTIONS (header 'true', inferSchema 'true')" if fmt == "csv" else ""
        spark.sql(f"CREATE TABLE `{db}`.`{table}` USING {fmt} {opts} LOCATION '{path}'")
    return df


def _matches(spark: SparkSession, path: str) -> bool:
    """Does ``path`` (a file or folder, any file system) exist? An absent path
    is told by Spark's own error class, not by its message."""
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def scan_parquet_dir(spark: SparkSession, path: str, schema: T.StructType | None = None,
                     recurse: bool = False) -> DataFrame:
    """scan_parquet_dir: the ``*.parquet`` files under ``path`` as one frame.
    Partition folders become columns; ``recurse=True`` reads nested folders as
    plain files instead. A missing or empty folder gives an empty frame (with
    ``schema`` when given)."""
    r = spark.read.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", recurse)
    if schema is not None:
        r = r.schema(schema)
    if not _matches(spark, path):
        return spark.createDataFrame([], schema or T.StructType([]))
    try:
        return r.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # no file to infer from
            return spark.createDataFrame([], schema or T.StructType([]))
        raise


def scan_csv_fallback(spark: SparkSession, primary: str, fallback_csv: str | None = None,
                      schema: T.StructType | None = None) -> DataFrame:
    """scan_csv_fallback: the Parquet folder; only if it does not exist, and a
    ``fallback_csv`` is named, the CSV file. An existing but empty folder stays
    empty (``require_nonempty`` stops on it): stale data never takes its place."""
    if fallback_csv is None or _matches(spark, primary):
        return scan_parquet_dir(spark, primary, schema)
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(fallback_csv)


class EmptyInputError(RuntimeError):
    pass


def require_nonempty(inputs: dict[str, DataFrame]) -> None:
    """require_nonempty: raise once, naming every empty input."""
    empty = [name for name, df in inputs.items() if not df.columns or df.isEmpty()]
    if empty:
        raise EmptyInputError("empty inputs: " + ", ".join(empty))


def row_counts(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """row_counts: attach a row-count observation; the count is filled in by
    whatever action runs the frame (the write), not by a separate job."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
