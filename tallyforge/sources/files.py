"""Readers of forms, reference tables, logs and files, and writers of the results."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from . import each


def forms(spark: SparkSession, path: str, schema: T.StructType, two_levels: bool = False) -> DataFrame:
    """JSON forms (one document or array a file) with ``_path``: of all folders below, or of two levels only."""
    reader = spark.read.schema(schema).option("multiLine", True)
    if two_levels:
        found = reader.json([f"{path}/*.json", f"{path}/*/*.json"])
    else:
        found = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    return found.select("*", F.col("_metadata.file_path").alias("_path"))


def by_suffix(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """(path, length) of the files of a folder by suffix in any case. A missing folder is an error."""
    glob = "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    return each.listed(spark, path, glob, recursive=False)


def binaries(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of all files below a folder, empty ones too, packed into tasks by bytes."""
    return each.contents(each.listed(spark, path, empty=True))


def industries(spark: SparkSession, path: str) -> DataFrame:
    """(code, title) of the industry table; its header is replaced by position."""
    rows = spark.read.schema(schemas.INDUSTRY).option("header", True).option("enforceSchema", True).csv(path)
    return rows.select(F.trim("code").alias("code"), F.trim("title").alias("title")).where("code is not null")


def zip_counties(spark: SparkSession, path: str) -> DataFrame:
    """(zip, county_code, county_name, share); label and placeholder rows have no zip of 5 digits."""
    rows = spark.read.schema(schemas.ZIP_COUNTY).option("header", True).option("enforceSchema", True).csv(path)
    rows = rows.where(F.col("zcta").rlike("^[0-9]{5}$"))
    return rows.select(F.col("zcta").alias("zip"), F.col("county").alias("county_code"), F.regexp_replace("county_name", r"\s[A-Z]{2}$", "").alias("county_name"), F.col("afact").cast("double").alias("share"))


def cities(spark: SparkSession, path: str) -> DataFrame:
    """(city, state, county_name, zips), city in upper case."""
    rows = spark.read.schema(schemas.CITIES).option("header", True).option("enforceSchema", True).csv(path)
    return rows.select(F.upper(F.trim("city")).alias("city"), F.trim("state_id").alias("state"), "county_name", "zips")


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of the logs of a folder: small ones packed into tasks by bytes, large ones in splits."""
    found = each.listed(spark, path, "*.log", recursive=False)
    large = [r.path for r in found.where(F.col("length") > each.TASK_BYTES).select("path").collect()]
    got = each.lines(found.where(F.col("length") <= each.TASK_BYTES)).select(F.substring_index("path", "/", -1).alias("file"), "line")
    if large:
        rows = spark.read.text([re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in large])
        got = got.union(rows.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line")))
    return got


def write_tables(tables: DataFrame, path: str, kind: str = "parquet") -> None:
    """Contingency tables (table_name, arity, ..) in one folder for each.

    As CSV, with a header, the folders are named file=<dimensions>_contingency.csv.
    """
    if kind == "csv":
        file = F.concat(F.regexp_replace("table_name", " ", "_"), F.lit("_contingency.csv"))
        tables.withColumn("file", file).drop("table_name", "arity").write.partitionBy("file").option("header", True).csv(path)
    else:
        tables.write.partitionBy("arity", "table_name").format(kind).save(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """A histogram or a summary of few rows as one file of JSON lines."""
    summary.coalesce(1).write.json(path)


def write_forms(records: DataFrame, path: str) -> None:
    """Records as JSON lines, to a new path."""
    records.write.json(path)


def combined(tables: list[DataFrame], names: list[str]) -> DataFrame:
    """All tables in one, with table_name; names are cut to 31 characters and made unique by _n."""
    seen: dict[str, int] = {}
    out = None
    for t, name in zip(tables, names, strict=True):
        short, n = name[:31], 1
        while short in seen:
            short, n = f"{name[: 31 - len(f'_{n}')]}_{n}", n + 1
        seen[short] = 1
        t = t.withColumn("table_name", F.lit(short))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out
