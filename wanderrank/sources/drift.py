"""Raw CSV folders whose files differ: columns added, reordered or widened over time.

Headers are read per file in one job; files with equal headers are one group.
For each group one aggregate tells, per column, the narrowest type that every
value fits. Types are widened over the groups (and over the schema that the catalog
has already), and the folder is read as one frame: a column that a file lacks is
null there. No file's rows reach the driver, only headers and one row of flags per
group; work grows with the bytes, not with files x jobs.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# narrowest first; a value that fits none is text
LADDER = ["int", "bigint", "double", "date", "timestamp", "boolean"]
_WIDER = {("int", "bigint"): "bigint", ("int", "double"): "double", ("bigint", "double"): "double",
          ("date", "timestamp"): "timestamp"}


def widen(a: str | None, b: str | None) -> str | None:
    """The narrowest type that holds both (None: nothing known yet)."""
    if a is None or b is None or a == b:
        return a or b
    return _WIDER.get((a, b)) or _WIDER.get((b, a)) or "string"


def file_headers(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """(header, files with it) of the CSV files below ``path``."""
    lines = spark.read.text(path, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("seq"), "value").where("at = 0")
    first = lines.groupBy("file").agg(F.min_by("value", "seq").alias("header"))
    groups = first.groupBy("header").agg(F.array_sort(F.collect_list("file")).alias("files"))
    return [(r["header"], r["files"]) for r in groups.orderBy("header").collect()]


def _strings(spark: SparkSession, header: str, files: list[str]) -> DataFrame:
    names = next(csv.reader(io.StringIO(header)))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(files)


def _fits(v: Column, kind: str) -> Column:
    """Is the text a plain value of this type? Spark's cast also takes a time for a
    date and single letters for truth values."""
    ok = v.try_cast(kind).isNotNull()
    if kind == "date":
        ok &= ~v.rlike("[T :]")
    return ok & v.rlike("(?i)^(true|false)$") if kind == "boolean" else ok


def column_types(df: DataFrame) -> dict[str, str | None]:
    """Text columns -> the narrowest type that all their values fit (None: no value)."""
    flags = []
    for i, c in enumerate(df.columns):
        v = F.col(f"`{c}`")
        flags.append(F.count(v).alias(f"n{i}"))
        flags += [F.count(F.when(_fits(v, t), 1)).alias(f"n{i}_{t}") for t in LADDER]
    row = df.agg(*flags).first()
    out: dict[str, str | None] = {}
    for i, c in enumerate(df.columns):
        n = row[f"n{i}"]
        out[c] = None if n == 0 else next((t for t in LADDER if row[f"n{i}_{t}"] == n), "string")
    return out


def scan_drifting(spark: SparkSession, path: str, known: T.StructType | None = None) -> DataFrame:
    """All CSV files below ``path`` as one frame with widened types; ``known``: the
    schema so far, whose columns come first and are never narrowed."""
    types: dict[str, str | None] = {f.name: f.dataType.simpleString() for f in known} if known else {}
    groups = []
    for header, files in file_headers(spark, path):
        df = _strings(spark, header, files)
        for c, t in column_types(df).items():
            types[c] = widen(types.get(c), t)
        groups.append(df)
    if not groups:
        return spark.createDataFrame([], known or T.StructType([]))
    out = None
    for df in groups:
        part = df.select(*[(F.col(f"`{c}`").try_cast(t or "string") if c in df.columns else F.lit(None).cast(t or "string")).alias(c)
                           for c, t in types.items()])
        out = part if out is None else out.unionByName(part)
    return out


def crawl(spark: SparkSession, path: str, db: str, table: str) -> DataFrame:
    """Record the folder as catalog table ``db.table``: a new crawl widens the schema
    the catalog has; added columns come last."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    name = f"`{db}`.`{table}`"
    known = spark.table(name).schema if spark.catalog.tableExists(f"{db}.{table}") else None
    scan_drifting(spark, path, known).write.mode("overwrite").option("overwriteSchema", True).saveAsTable(name)
    return spark.table(name)
