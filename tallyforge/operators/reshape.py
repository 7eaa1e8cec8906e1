"""Melt, pivot, explode and flatten."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text


def melt(df: DataFrame, ids: list[str], values: list[str], name: str, value: str) -> DataFrame:
    """One row for each of the value columns."""
    return df.unpivot(ids, values, name, value)


def appended(tables: list[DataFrame]) -> DataFrame:
    """All tables under one another by name; a column that one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def split_labels(df: DataFrame, label: str, names: list[str], separator: str) -> DataFrame:
    """The label replaced by its parts, cut from the right."""
    parts = text.split_label(F.col(label), separator, len(names))
    return df.select(*[c for c in df.columns if c != label], *[p.alias(n) for p, n in zip(parts, names, strict=True)])


def matrix_cells(df: DataFrame, ids: list[str], matrix: str) -> DataFrame:
    """(ids, r, c, value) of an array of rows."""
    rows = df.select(*ids, F.posexplode(matrix).alias("r", "_row"))
    return rows.select(*ids, "r", F.posexplode("_row").alias("c", "value"))


def named_cells(cells: DataFrame, row_names: list[str], column_names: list[str]) -> DataFrame:
    """cells with row_name and column_name; positions beyond the names are null."""
    name = lambda names, i: F.get(F.array(*[F.lit(n) for n in names]), F.col(i))
    return cells.withColumn("row_name", name(row_names, "r")).withColumn("column_name", name(column_names, "c"))


def without_totals(cells: DataFrame, rows: Column | int, last_column: int) -> DataFrame:
    """Without the last row (rows counts them) and the total column."""
    return cells.where((F.col("r") < F.lit(rows) - 1) & (F.col("c") < last_column))


def pivot_sum(df: DataFrame, rows: list[str], column: str, value: str, values: list | None = None) -> DataFrame:
    """Sums by rows and columns, 0 where there is none. Name the values: else a pass finds them."""
    got = df.groupBy(*rows).pivot(column, values).agg(F.sum(value))
    return got.na.fill(0, [c for c in got.columns if c not in rows])


def explode_zips(df: DataFrame, zips: str, out: str) -> DataFrame:
    """One row for each code in "02108 02109" or "[02108 02109]"."""
    codes = F.split(F.trim(F.regexp_replace(zips, r"[\[\]]", " ")), r"\s+")
    return df.withColumn(out, F.explode(codes)).where(F.col(out) != "")


def stack_sub_tables(cells: DataFrame, sub_tables: dict[str, tuple[str, int, int]]) -> DataFrame:
    """Cells (.., table, r, ..) of partial tables put under one another; other tables are left out."""
    table = F.create_map(*[F.lit(x) for k, (t, _, _) in sub_tables.items() for x in (k, t)])
    offset = F.create_map(*[F.lit(x) for k, (_, _, o) in sub_tables.items() for x in (k, o)])
    known = cells.where(F.col("table").isin(*sub_tables))
    return known.withColumn("r", F.col("r") + offset[F.col("table")]).withColumn("table", table[F.col("table")])


def last_flag(flags: list[str]) -> Column:
    """The name of the last true flag; null without one."""
    return F.coalesce(*[F.when(F.col(f"`{f}`"), F.lit(f)) for f in reversed(flags)])

