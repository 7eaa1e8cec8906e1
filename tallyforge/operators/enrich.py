"""Joins and bins that add dimensions to form rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas, storage


def sums_by(df: DataFrame, keys: list[str], values: dict[str, str]) -> DataFrame:
    """(keys.., a sum for each of values by its new name, n rows), null keys as a category."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(out) for out, c in values.items()], F.count("*").alias("n"))


def members(df: DataFrame, column: str, known: DataFrame, known_column: str) -> DataFrame:
    """The distinct values of a column that a reference has too."""
    return df.select(column).distinct().join(known.select(F.col(known_column).alias(column)), column, "left_semi")


def total_by(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Every row with the sum over its keys. Summed apart and joined back, so that a hot key is
    pre-aggregated."""
    sums = df.groupBy(*keys).agg(F.sum(value).alias(out))
    return df.join(sums, keys, "left")


def prefix_join(df: DataFrame, code: str, table: DataFrame, table_code: str, label: str, out: str, length: int = 2) -> DataFrame:
    """Adds the label of the code's first characters; rows without a match stay."""
    known = table.select(F.col(table_code).alias("_prefix"), F.col(label).alias(out))
    return df.withColumn("_prefix", F.substring(F.col(code).cast("string"), 1, length)).join(known, "_prefix", "left").withColumnRenamed("_prefix", f"{code}_prefix")


def name_join(df: DataFrame, code: str, names: DataFrame, name_code: str, name: str, out: str) -> DataFrame:
    """Adds the code's name, '' where unknown."""
    known = names.select(F.col(name_code).alias(code), F.col(name).alias(out)).dropDuplicates([code])
    return df.join(known, code, "left").withColumn(out, F.coalesce(F.col(out), F.lit("")))


def county_join(df: DataFrame, zip_column: str, counties: DataFrame, mode: str = "fanout", count: str | None = None) -> DataFrame:
    """Adds county_name by zip; counties: (zip, county_code, county_name, share).

    fanout: a row for each county of the zip, counts unchanged. dominant: the county with the
    largest share, ties to the smaller code. allocate: as fanout, with ``count`` times the share.
    """
    if mode not in ("fanout", "dominant", "allocate"):
        raise ValueError(mode)
    if mode == "dominant":
        best = F.min_by("county_name", F.struct((-F.col("share")).alias("s"), "county_code"))
        counties = counties.groupBy("zip").agg(best.alias("county_name"))
    got = df.join(counties.withColumnRenamed("zip", "_zip"), F.col(zip_column) == F.col("_zip"), "left").drop("_zip", "county_code")
    if mode == "allocate":
        got = got.withColumn(count, F.col(count) * F.coalesce("share", F.lit(1.0)))
    return got.drop("share")


def relevant(df: DataFrame, state: str, state_columns: list[str], zip_columns: list[str], zips: DataFrame) -> DataFrame:
    """Rows with the state in any of the columns, or any zip among zips (zip)."""
    known = zips.select(F.col("zip")).distinct()
    keep = F.lit(False)
    for i, c in enumerate(zip_columns):
        df = df.join(known.select(F.col("zip").alias(f"_z{i}")), F.col(c) == F.col(f"_z{i}"), "left")
        keep = keep | F.col(f"_z{i}").isNotNull()
    for c in state_columns:
        keep = keep | F.col(c).eqNullSafe(F.lit(state))
    return df.where(keep).drop(*[f"_z{i}" for i in range(len(zip_columns))])


def quartile_edges(df: DataFrame, value: str, buckets: int = 256) -> DataFrame:
    """One row (edges) of the five quartile edges over rows, linearly interpolated; null without rows.

    Rows are counted by value first. An approximate split of the values into buckets and the buckets'
    counts, which alone reach the driver, then tell in which buckets the edges lie; only those are sorted.
    """
    with storage.scratch(df.sparkSession):
        counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))
        counts = storage.materialised(counts, "values")
        splits = counts.agg(F.approx_percentile("v", F.array(*[F.lit(i / buckets) for i in range(1, buckets)]), F.lit(10 * buckets)).alias("s")).first()[0]
        if splits is None:
            return df.sparkSession.range(1).select(F.lit(None).cast("array<double>").alias("edges"))
        splits = sorted(set(splits))
        bucket = F.size(F.filter(F.array(*[F.lit(x) for x in splits]), lambda s: s < F.col("v")))
        counts = counts.withColumn("bucket", bucket)
        held = {r[0]: r[1] for r in counts.groupBy("bucket").agg(F.sum("n")).collect()}
        total, before, start = sum(held.values()), {}, 0
        for b in sorted(held):
            before[b], start = start, start + held[b]
        ranks = [q / 4 * (total - 1) for q in range(5)]
        wanted = sorted({r for at in ranks for r in (math.floor(at), math.ceil(at))})
        of = {r: max(b for b in before if before[b] <= r) for r in wanted}
        upto = F.sum("n").over(Window.partitionBy("bucket").orderBy("v"))
        some = counts.where(F.col("bucket").isin(*set(of.values()))).withColumn("upto", upto)
        at = dict(zip(wanted, some.agg(*[F.min(F.when((F.col("bucket") == of[r]) & (F.col("upto") > r - before[of[r]]), F.col("v"))) for r in wanted]).first(), strict=True))
        edges = [(math.ceil(x) - x) * at[math.floor(x)] + (x - math.floor(x)) * at[math.ceil(x)] if x % 1 else at[int(x)] for x in ranks]
        return df.sparkSession.range(1).select(F.array(*[F.lit(e) for e in edges]).alias("edges"))


def size_bins(df: DataFrame, value: str, out: str, labels: list[str] | None = None, duplicates: str = "raise") -> DataFrame:
    """Quartile labels over rows: bins closed on the right, the lowest edge included.

    Equal edges raise an error, or with duplicates="drop" merge (labels then go to the bins left, in
    order). Nulls get no label.
    """
    labels = labels or schemas.SIZE_LABELS
    edges = df.select(value).transform(lambda d: quartile_edges(d, value))
    if duplicates == "drop":
        edges = edges.select(F.array_distinct("edges").alias("edges"))
    else:
        equal = F.size(F.array_distinct("edges")) < F.size("edges")
        edges = edges.select(F.when(equal, F.raise_error(F.lit("quartile edges are equal")).cast("array<double>")).otherwise(F.col("edges")).alias("edges"))
    names = F.array(*[F.lit(x) for x in labels])
    at = F.size(F.filter("edges", lambda e: e < F.col(value)))
    bin_ = F.when(F.col(value).isNotNull(), F.get(names, F.greatest(at, F.lit(1)) - 1))
    # One row: a broadcast of five numbers.
    return df.crossJoin(F.broadcast(edges)).withColumn(out, bin_).drop("edges")


def zip_by_state(state: Column, inside: Column, outside: Column, home: str = "MA") -> Column:
    """The first zip if the state is the home state, else the second; a null state is elsewhere."""
    return F.when(state.eqNullSafe(F.lit(home)), inside).otherwise(outside)


def share_of(df: DataFrame, value: str, out: str, within: list[str] | None = None) -> DataFrame:
    """Percent of the total within the columns (of all rows without them); null becomes 0.

    The total of all rows is summed where they are and joined as one row.
    """
    if within:
        rows, total = df, F.sum(value).over(Window.partitionBy(*within))
    else:
        rows, total = df.crossJoin(F.broadcast(df.agg(F.sum(value).alias("_total")))), F.col("_total")
    return rows.withColumn(out, F.coalesce(100.0 * F.col(value) / F.when(total != 0, total), F.lit(0.0))).drop("_total")
