"""Nested data of any shape as flat names, walked without knowing the shape beforehand.

A value is a VARIANT. Each level of nesting is one generator over the rows, so a document is opened
level by level in one pass without a shuffle; how many levels there are is one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _kind(v: Column) -> Column:
    """Whether a variant holds other values."""
    return F.coalesce(F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)<"), F.lit(False))


def depth(values: DataFrame, variant: str) -> int:
    """How deep the deepest value is nested: 0 for plain values."""
    marks = F.regexp_replace(F.to_json(variant), r'"(?:[^"\\]|\\.)*+"|[^\[\]{}]', "")
    steps = F.transform(F.split(marks, ""), lambda c: F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0))
    step = lambda a, n: F.struct((a.now + n).alias("now"), F.greatest(a.most, a.now + n).alias("most"))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    return values.agg(F.max(F.aggregate(steps, start, step, lambda a: a.most))).first()[0] or 0


def flattened(df: DataFrame, variant: str, keys: list[str]) -> DataFrame:
    """(keys.., path, value) of every plain value inside a variant: ``key.sub`` for members, ``key_i`` for elements.

    value: its text, null for a JSON null. Empty objects and arrays, and null variants, have no rows. A value
    that is plain itself has the empty path.
    """
    rows = df.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], F.lit("").alias("_path"), F.col(f"`{variant}`").alias("_v")).where("_v is not null")
    held = [f"_k{i}" for i in range(len(keys))]
    tvf = df.sparkSession.tvf
    for _ in range(depth(rows, "_v")):
        open_ = rows.withColumn("_open", _kind(F.col("_v")))
        inside = open_.lateralJoin(tvf.variant_explode_outer(F.col("_v").outer()))
        named = F.when(F.col("_path") == "", F.col("key")).otherwise(F.concat("_path", F.lit("."), "key"))
        placed = F.when(F.col("_path") == "", F.col("pos").cast("string")).otherwise(F.concat("_path", F.lit("_"), F.col("pos")))
        path = F.when(~F.col("_open"), F.col("_path")).otherwise(F.coalesce(named, placed))
        # An open value without members leaves a row without a place.
        rows = inside.where("not _open or pos is not null").select(*held, path.alias("_path"), F.when(F.col("_open"), F.col("value")).otherwise(F.col("_v")).alias("_v"))
    rows = rows.where(~_kind(F.col("_v")))
    return rows.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], F.col("_path").alias("path"), F.variant_get("_v", "$", "string").alias("value"))


def widened(flat: DataFrame, keys: list[str], paths: list[str] | None = None) -> DataFrame:
    """(keys.., a column for each path) of flat rows; null where a document lacks it.

    Name the paths: else a pass finds them, and more of them than ``spark.sql.pivotMaxValues`` are an error.
    """
    return flat.groupBy(*keys).pivot("path", paths).agg(F.first("value"))
